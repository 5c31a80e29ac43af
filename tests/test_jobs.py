"""Sinks, saved state, the three jobs and the streaming feed."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from phenolith import adapters as A
from phenolith.operators import features as FE
from phenolith.operators import models as M
from phenolith.operators import observations as O
from phenolith.operators.serving import load_pipeline, save_pipeline
from phenolith.plans import fit as FIT
from phenolith.plans import teach as T
from phenolith.plans.enrich import run_enrich
from phenolith.sinks import catalogue as C
from phenolith.sinks import state as ST
from phenolith.sinks import writers as W
from phenolith.streaming import feeds
from tests.test_columns import TOKENS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("job"))
    parsed = A.parsed_observations(spark, SF)
    for version in ("100", "200"):
        run_enrich(parsed, A.readings(spark, SF), A.stations(spark, SF), f"{root}/rows", version)
    return root


def test_enriched_layout_and_newest_rows(spark, root):
    parts = C.parts(spark, f"{root}/rows")
    kinds = {(r["kind"], r["part_a"], r["part_b"]) for r in parts.collect()}
    assert ("random", "200", "1") in kinds and ("occurrences", "u1", "100") in kinds
    newest = FIT.newest_rows(spark, f"{root}/rows")
    assert newest.count() * 2 == parts.where("kind <> 'rejects'").agg(F.sum("rows")).first()[0] == 2 * 96
    assert newest.where("size(max_temp) <> 120").count() == 0


def test_state_round_trip(spark, root):
    rows = FIT.newest_rows(spark, f"{root}/rows").drop(*W.LAYOUT)
    FIT.run_fit(rows, root, "100")
    newest = FIT.run_fit(rows, root, "200")
    assert ST.latest_transform_state(spark, root).endswith("transformers/200") and newest.endswith("200")
    state = ST.read_transform_state(spark, newest)
    done = FE.apply_transform(rows, state)
    low, high = done.agg(F.min("elevation"), F.max("elevation")).first()
    assert (low, high) == (0.0, 1.0)
    (spark.createDataFrame([("x",)], "value string").write.text(f"{root}/transformers/300/raw_metadata"))
    with pytest.raises(ValueError):
        ST.latest_transform_state(spark, root)


def test_rows_without_the_declared_shape_are_rejects(spark, root):
    rows = FIT.newest_rows(spark, f"{root}/rows").drop(*W.LAYOUT)
    short = F.when(F.col("category") == "u1", F.slice("max_temp", 1, 100)).otherwise(F.col("max_temp"))
    path = FIT.run_fit(rows.withColumn("max_temp", short).withColumn("daylight", F.when(F.col("category") != "u2", F.col("daylight"))), root, "050")
    counts = {tuple(r["reasons"]): r["n"] for r in spark.read.parquet(f"{path}/rejects").groupBy("reasons").agg(F.count("*").alias("n")).collect()}
    assert counts == {("length_max_temp",): rows.where("category = 'u1'").count(), ("length_daylight",): rows.where("category = 'u2'").count()}


def test_every_row_is_written_or_rejected(spark, tmp_path):
    """Ids that are repeated or null, and rows too early, too far away, or without a folder."""
    parsed = A.parsed_observations(spark, SF)
    first = O.valid_observations(parsed).where("category = 'u1'").orderBy("example_id").first()
    row = spark.createDataFrame([first], parsed.schema)
    odd = row.withColumn("example_id", F.lit(None).cast("string")).unionByName(row.withColumn("example_id", F.lit("twice"))).unionByName(
        row.withColumns({"example_id": F.lit("twice"), "latitude": F.lit(-70.0)})).unionByName(row.withColumns({"example_id": F.lit("twice"), "category": F.lit("a b")})).unionByName(
        row.withColumns({"example_id": F.lit("early"), "obs_date": F.lit("1990-01-01").cast("date")})).unionByName(row.withColumn("category", F.lit(None).cast("string")))
    near = odd.withColumns({"latitude": F.when(F.col("latitude") != -70, F.lit(25.1)).otherwise(F.col("latitude")), "longitude": F.lit(-109.9)})
    stations = spark.createDataFrame([("1", "1", 25.1, -109.9)], "usaf string, wban string, lat double, lon double")
    readings = spark.range(200).select(F.date_sub(F.lit(first["obs_date"]), F.col("id").cast("int")).alias("d")).selectExpr(
        "'1' as stn", "'1' as wban", "date_format(d, 'yyyy') as year", "date_format(d, 'MM') as mo", "date_format(d, 'dd') as da", "50D as temp", "40D as min", "60D as max", "0D as prcp")
    done = run_enrich(near, readings, stations, str(tmp_path / "rows"), "1")
    assert done.rows_in == near.count() == 6 and done.written + done.rejected == 6
    from phenolith.plans.enrich import PUBLISHED_SCHEMA

    written = C.read_version(spark, str(tmp_path / "rows"), PUBLISHED_SCHEMA, "1").collect()
    rejects = C.read_version(spark, str(tmp_path / "rows"), PUBLISHED_SCHEMA, "1", rejects=True).collect()
    reasons = sorted((r["example_id"] or "", tuple(r["reasons"])) for r in rejects)
    ids = sorted(r["example_id"] or "" for r in written)
    assert len(written) == done.written and ids.count("twice") == ids.count("") == 1
    assert reasons == [("early", ("no_complete_station",)), ("o-1", ("category_empty",)), ("twice", ("category_unroutable",)), ("twice", ("no_complete_station",))]


def test_a_failed_attempt_is_never_seen(spark, tmp_path):
    root, schema = str(tmp_path / "rows"), "id bigint"
    rows = lambda n, version: spark.range(n).selectExpr("id", "'occurrences' as kind", "concat('u', id % 2) as part_a", f"'{version}' as part_b")
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("id bigint")
    assert C.read_newest(spark, root, schema).count() == 0
    for n, version in ((4, "1"), (6, "2")):
        attempt = C.new_attempt(version)
        C.stage(rows(n, version), root, attempt)
        C.publish(spark, root, attempt, schema)
    broken = C.new_attempt("3")
    with pytest.raises(Exception):  # noqa: B017
        C.stage(rows(100, "3").withColumn("id", F.expr("if(id > 50, raise_error('lost'), id)")), root, broken)
    unpublished = C.new_attempt("2")
    C.stage(rows(50, "2"), root, unpublished)  # whole, but the job ends before it is published
    assert C.read_newest(spark, root, schema).count() == 6 and C.published(spark, root).keys() == {"1", "2"}
    again = C.new_attempt("2")
    C.stage(rows(8, "2").where("part_a = 'u0'"), root, again)  # the retry has other rows: nothing of the first attempt is mixed in
    C.publish(spark, root, again, schema)
    newest = {(r["part_a"], r["part_b"], r["id"]) for r in C.read_newest(spark, root, schema).collect()}
    assert newest == {("u0", "2", i) for i in (0, 2, 4, 6)} | {("u1", "1", i) for i in (1, 3)}


def test_older_versions_are_not_opened(spark, tmp_path):
    from pyspark.sql.types import StructType

    root, schema = str(tmp_path / "rows"), StructType.fromDDL("id bigint")
    for version in ("1", "2"):
        attempt = C.new_attempt(version)
        C.stage(spark.range(3).selectExpr("id", "'random' as kind", f"'{version}' as part_a", "'7' as part_b"), root, attempt)
        C.publish(spark, root, attempt, schema)
    old = C.published(spark, root)["1"]
    for file in (tmp_path / "rows" / f"attempt={old}").rglob("*.parquet"):
        file.write_bytes(b"broken")
    assert C.read_newest(spark, root, schema).count() == 3


def test_teach_save_and_score(spark, root):
    rows = FIT.newest_rows(spark, f"{root}/rows").drop(*W.LAYOUT)
    state = FE.fit(rows)
    model, metrics = T.teach(rows, state, rounds=2, multiplier=1, pct=0.2, hidden=(6,), epochs=6)
    assert all(0 <= m["auc"] <= 1 and m["average_loss"] > 0 for m in metrics) and model.state.step > 0
    inputs = M.model_input(FE.apply_transform(rows, state, keep=("example_id",)), state, label=False)
    scores = {r["example_id"]: r["score"] for r in M.score_observations(model, inputs).collect()}
    assert len(scores) == rows.count() and all(0 < s < 1 for s in scores.values())
    path = save_pipeline(state, model, root, "u1", "1")
    loaded = load_pipeline(save_pipeline(state, model, root, "u1", "1"))  # a version saved again replaces itself
    assert path.endswith("models/u1/1")
    again = {r["example_id"]: r["score"] for r in loaded.transform(rows.drop("category")).collect()}
    assert again == scores
    assert loaded.stages[1].model.state.step == model.state.step and loaded.stages[1].model.history == model.history


def test_scores_of_a_new_session_and_of_a_stream(spark, root, tmp_path):
    """The saved pipeline scores in a session of its own, and rows that arrive as files; a restarted stream goes on where it ended."""
    rows = FIT.newest_rows(spark, f"{root}/rows").drop(*W.LAYOUT)
    state = FE.fit(rows)
    model, _ = T.teach(rows, state, multiplier=1, pct=0.2, hidden=(4,), epochs=2)
    path = save_pipeline(state, model, str(tmp_path), "u1", "9")
    want = {r["example_id"]: r["score"] for r in load_pipeline(path).transform(rows).collect()}
    program = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from phenolith.session import local_session\nfrom phenolith.operators.serving import load_pipeline\n"
        "spark = local_session('2', 2, '2g')\nload_pipeline(sys.argv[2]).transform(spark.read.parquet(sys.argv[3])).select('example_id', 'score').write.parquet(sys.argv[4])")
    rows.write.parquet(str(tmp_path / "given"))
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", program, here, path, str(tmp_path / "given"), str(tmp_path / "scored")], check=True, timeout=300)
    assert {r["example_id"]: r["score"] for r in spark.read.parquet(str(tmp_path / "scored")).collect()} == want
    ids = sorted(want)
    for number, part in enumerate((ids[:40], ids[40:])):
        rows.where(F.col("example_id").isin(part)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = feeds.score_stream(feeds.enriched_stream(spark, str(tmp_path / "in")), path)
        feeds.start_score_sink(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        got = feeds.read_scores(spark, str(tmp_path / "out")).collect()
        assert {r["example_id"]: r["score"] for r in got} == {i: want[i] for i in (ids[:40] if number == 0 else ids)} and len(got) == len(set(r["example_id"] for r in got))


def test_split_is_gzip_and_replaced(spark, tmp_path):
    df = spark.range(10).select("id", F.when(F.col("id") < 3, "eval").otherwise("train").alias("split"))
    W.write_split(df, str(tmp_path / "s"))
    W.write_split(df, str(tmp_path / "s"))
    assert {r["split"]: r["n"] for r in spark.read.parquet(str(tmp_path / "s")).groupBy("split").agg(F.count("*").alias("n")).collect()} == {"eval": 3, "train": 7}
    assert list((tmp_path / "s").glob("split=eval/*.gz.parquet"))


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    feature = {"GeoPoint": {"latitude": 40.5, "longitude": -80.5}, "Elevation": 10, "EcoRealm": 1, "EcoBiome": 2, "EcoNum": 3,
               "S2Tokens": {str(i): t for i, t in enumerate(TOKENS)}}
    lines = [{"category": "u1", "example_id": f"x{i}", "FormattedDate": "20170101", "GeoFeatureSet": feature} for i in range(5)]
    lines.append({"category": "u1", "example_id": "bad", "FormattedDate": "2017", "GeoFeatureSet": feature})
    (source / "a.json").write_text("\n".join(json.dumps(x) for x in lines))
    stream = feeds.observation_stream(feeds.document_stream(spark, str(source)))
    feeds.start_category_sink(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "1").awaitTermination()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 5 and set(O.OBSERVATION_COLUMNS) <= set(back.columns)


def test_readings_never_pass_for_a_small_table(spark, tmp_path):
    """Their estimated size grows with stations times days, before and after the suppliers are known to be few: no join sends them all through the driver."""
    spark.range(1, 301).selectExpr("id as s_suppkey").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.createDataFrame([("1995-01-01 00:00:00",), ("1996-12-31 00:00:00",)], "d string").selectExpr("cast(d as timestamp) as o_orderdate").write.parquet(
        str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(7, "R", 50.0, "1995-03-04 00:00:00")], "l_suppkey long, l_returnflag string, l_quantity double, d string").selectExpr(
        "l_suppkey", "l_returnflag", "l_quantity", "cast(d as timestamp) as l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    readings = A.readings(spark, str(tmp_path))
    rows = 300 * (A.CALENDAR_LEAD + 731) - 1
    assert readings.count() == rows
    assert readings.where("stn = '7' and year = '1995' and mo = '03'").count() == 30
    assert int(str(readings._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= 8 * rows


def test_weather_is_scanned_for_all_observations(spark, tmp_path):
    """Also the months that only observations of other categories and ids reach."""
    from phenolith.queries import load

    spark.range(1, 4).selectExpr("id as s_suppkey").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.createDataFrame([(6, "1995-01-05 00:00:00"), (8, "1996-12-20 00:00:00")], "o_orderkey long, d string").selectExpr(
        "o_orderkey", "1L as o_custkey", "'O' as o_orderstatus", "cast(d as timestamp) as o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([], "l_suppkey long, l_returnflag string, l_quantity double, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    months = {(r["year"], r["mo"]): r["n"] for r in load()["scan_daily_weather"].run(spark, str(tmp_path)).collect()}
    assert len(months) == 6 + 24 and months["1996", "07"] == 3 * 31 and months["1996", "12"] == 3 * 20


def test_tasks_of_observations_do_not_grow_with_the_table(spark, tmp_path):
    """More orders make more tasks, not longer ones."""
    spark.range(1, 850_001).selectExpr("id as o_orderkey", "id % 50 as o_custkey", "'O' as o_orderstatus", "timestamp'1995-01-05' as o_orderdate").coalesce(1).write.parquet(
        str(tmp_path / "orders.parquet"))
    sizes = [r["n"] for r in A.parsed_observations(spark, str(tmp_path)).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 850_000 and max(sizes) < 110_000
