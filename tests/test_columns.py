import datetime
import hashlib

from pyspark.sql import functions as F

from phenolith.functions import columns as X
from phenolith.operators import observations as O
from phenolith.schema import DOCUMENT_SCHEMA

TOKENS = ["5", "4c", "4d", "4cc", "4cb", "4ca4", "4ca5", "4ca4c", "4ca4d", "4ca4dc", "4ca4d9", "4ca4d9c", "4ca4d9d",
          "4ca4d9d4", "4ca4d9d7", "4ca4d9d7c", "4ca4d9d7f"]


def document(category="Io1ftG", ident="Io1ftG-27-923908968", date="20100510", lat=43.736238, lon=-73.210352, elevation=215.0,
             realm=5, biome=4, num=7, tokens=None):
    tokens = dict(enumerate(TOKENS)) if tokens is None else tokens
    return (category, ident, date, ((lat, lon), elevation, realm, biome, num, {str(k): v for k, v in tokens.items()}, 1))


def parsed(spark, *documents):
    return O.parse_documents(spark.createDataFrame(list(documents), DOCUMENT_SCHEMA))


def test_golden_document(spark):
    row = O.valid_observations(parsed(spark, document())).select(
        "*", X.season().alias("season"), X.month_name().alias("month"), X.equality_key().alias("key"),
        X.season_region_key().alias("region"), X.month_region_key().alias("mregion"), X.eco_region().alias("eco"),
        F.col("latitude").cast("float").alias("lat32")).first()
    assert row["example_id"] == "Io1ftG-27-923908968" and row["category"] == "Io1ftG"
    assert abs(row["lat32"] - 43.73623657) < 1e-7 and abs(row["longitude"] + 73.2103500) < 1e-5
    assert row["obs_date"] == datetime.date(2010, 5, 10) and row["season"] == 1 and row["month"] == "May"
    assert row["elevation"] == 215
    assert row["key"] == "Io1ftG|||43.7362|||-73.2104|||20100510"
    assert row["region"] == "2010-1-4d" and row["mregion"] == "2010-05-4d"
    assert tuple(row["eco"]) == ("5", "4", "7")
    assert row["s2_tokens"] == TOKENS


def test_reject_reasons(spark):
    short, blank = dict(enumerate(TOKENS[:16])), dict(enumerate(TOKENS[:16] + [""]))
    shifted = dict(enumerate(TOKENS[:16])) | {17: "x"}
    bad = {
        "zero-lat": document(ident="zero-lat", lat=0.0), "zero-lon": document(ident="zero-lon", lon=0.0),
        "date": document(ident="date", date="2010051"), "feb30": document(ident="feb30", date="20100230"),
        "nodate": document(ident="nodate", date=None), "elev": document(ident="elev", elevation=None),
        "eco": document(ident="eco", biome=0), "cat": document(ident="cat", category=""),
        "short": document(ident="short", tokens=short), "blank": document(ident="blank", tokens=blank),
        "shifted": document(ident="shifted", tokens=shifted), "old": document(ident="old", date="19500101"),
        "nothing": ("u", "nothing", "20100510", None)}
    df = parsed(spark, document(ident="good"), *bad.values())
    assert [r[0] for r in O.valid_observations(df).select("example_id").collect()] == ["good"]
    reasons = {r[0]: r[1] for r in O.rejected_observations(df).collect()}
    assert reasons == {
        "zero-lat": ["latitude_empty"], "zero-lon": ["longitude_empty"], "date": ["date_length"], "feb30": ["date_unreadable"],
        "nodate": ["date_length"], "elev": ["elevation_missing"], "eco": ["eco_empty"], "cat": ["category_empty"],
        "short": ["token_count"], "blank": ["token_empty"], "shifted": ["token_empty"], "old": ["window_before_1950"],
        "nothing": ["feature_set_missing"]}


def test_tokens_as_list(spark):
    schema = "category string, example_id string, FormattedDate string, GeoFeatureSet struct<GeoPoint struct<latitude double, longitude double>, " \
        "Elevation double, EcoRealm int, EcoBiome int, EcoNum int, S2Tokens array<string>>"
    row = ("u", "x", "20100510", ((1.0, 2.0), 3.9, 1, 2, 3, TOKENS))
    out = O.parse_documents(spark.createDataFrame([row], schema), tokens_as_list=True).first()
    assert out["s2_tokens"] == TOKENS and out["elevation"] == 3


def test_seasons(spark):
    rows = spark.range(1, 13).select(X.season_of_month(F.col("id")).alias("s")).collect()
    assert [r["s"] for r in rows] == [4, 4, 1, 1, 1, 2, 2, 2, 3, 3, 3, 4]


def test_categories(spark):
    cases = ["random-12", "RANDOM-3", "protected_area-20180102", "random", "u1", "a/b", "a b", "", "random-"]
    df = spark.createDataFrame([(c,) for c in cases], "category string")
    rows = df.select("category", X.valid_category().alias("ok"), X.category_kind().alias("kind"),
                     X.category_path("category", F.lit("9")).alias("path")).collect()
    got = {r["category"]: (r["ok"], r["kind"], r["path"]) for r in rows}
    assert got["random-12"] == (True, "random", "random/9/12.tfrecords")
    assert got["RANDOM-3"][:2] == (True, "random")
    assert got["protected_area-20180102"] == (True, "protected_area", "protected_areas/20180102/9.tfrecords")
    assert got["u1"] == (True, "occurrence", "occurrences/u1/9.tfrecords")
    assert [got[c][0] for c in ("random", "a/b", "a b", "")] == [False] * 4
    assert got["random-"][2] is None


def test_random_batch(spark):
    df = spark.createDataFrame(
        [("random", "r-3-9"), ("random", "r-0-9"), ("random", "r"), ("u1", "o-7")], "category string, example_id string")
    assert [r[0] for r in df.select(X.random_batch_id()).collect()] == [3, None, None, 0]
    assert [r[0] for r in df.select(X.routing_category()).collect()] == ["random-3", None, None, "u1"]


def test_md5_percent(spark):
    ids = [f"id-{i}" for i in range(200)]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "example_id string").select(X.md5_percent("example_id")).collect()]
    assert got == [int(hashlib.md5(i.encode()).hexdigest(), 16) % 100 for i in ids]


def test_lists_and_keys(spark):
    row = spark.range(1).select(
        X.split_list(F.lit("a, b")).alias("kept"), X.split_list(F.lit("a, b"), trim=True).alias("trimmed"),
        X.source_key_parts(F.lit("ugkG3de-|-27-|-2526530")).alias("parts"), X.station_key(F.lit(1.5), F.lit(-2.25)).alias("key"),
        X.station_key(F.lit(0.0), F.lit(1.0)).alias("nokey")).first()
    assert row["kept"] == ["a", " b"] and row["trimmed"] == ["a", "b"]
    assert tuple(row["parts"]) == ("ugkG3de", "27", "2526530")
    assert row["key"] == "1.500000|-2.250000" and row["nokey"] is None


def test_survey_dates_and_areas(spark):
    dates = O.survey_dates(spark, "1998-01-05", "1998-01-18")
    assert sorted(r[0] for r in dates.collect()) == ["19980106", "19980109", "19980113", "19980116"]
    areas = O.parse_documents(spark.createDataFrame([document()], DOCUMENT_SCHEMA)).drop("category", "example_id", "date_string", "obs_date")
    rows = O.explode_area_dates(areas, "19980106,19980109").collect()
    assert {(r["category"], r["example_id"]) for r in rows} == {
        ("protected_area-19980106", TOKENS[15]), ("protected_area-19980109", TOKENS[15])}
    assert O.explode_area_dates(areas, " ").count() == 0


def test_name_usage_sources(spark):
    schema = "id string, Sources map<string, map<string, struct<Occurrences: int>>>"
    usages = spark.createDataFrame(
        [("a", {"27": {"1": (5,), "2": (0,), "3": (None,)}}), ("b", None), ("c", {"28": {"9": (1,)}})], schema)
    keys = lambda df: sorted(r["source_key"] for r in df.collect())
    assert keys(O.explode_name_usage_sources(usages)) == ["a-|-27-|-1", "c-|-28-|-9"]
    assert keys(O.explode_name_usage_sources(usages, "a,b")) == ["a-|-27-|-1"]
