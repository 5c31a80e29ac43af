import hashlib
import random

import pytest
from pyspark.sql import functions as F

from phenolith.operators import experiments as E
from phenolith.operators import features as FE
from phenolith.operators import grouping as G
from phenolith.operators import numbering as N
from phenolith.operators import sampling as SP
from phenolith.sources import listings as L
from phenolith.sources import scans as S


# --- quotas and splits ---------------------------------------------------------------------------


@pytest.mark.parametrize("multiplier,pct,want", [(5, 0.05, (51, 10, 959, 192)), (1, 0.1, (20, 20, 182, 182))])
def test_golden_quotas(spark, multiplier, pct, want):
    q = SP.split_quotas(202, multiplier, pct)
    assert (q.eval_random, q.eval_occurrence, q.train_random, q.train_occurrence) == want
    row = SP.split_quota_columns(spark.createDataFrame([(202,)], "occurrences long"), multiplier, pct).first()
    assert (row["eval_random"], row["eval_occurrence"], row["train_random"], row["train_occurrence"]) == want


@pytest.mark.parametrize("multiplier,pct,evaluation,train", [(5, 0.05, 61, 1151), (1, 0.1, 40, 364)])
def test_golden_split(spark, multiplier, pct, evaluation, train):
    rows = spark.range(202 + 3000).select(
        F.concat(F.lit("x"), "id").alias("example_id"), F.when(F.col("id") < 202, "u").otherwise("random").alias("category"))
    split = SP.train_eval_split(rows, multiplier, pct, seed=3).collect()
    parts = {p: {r["example_id"] for r in split if r["split"] == p} for p in ("eval", "train")}
    assert len(parts["eval"]) == evaluation and len(parts["train"]) == train and len(split) == evaluation + train
    assert not parts["eval"] & parts["train"]
    order = sorted((hashlib.md5(f"3|x{i}".encode()).hexdigest(), f"x{i}") for i in range(202))
    n = SP.split_quotas(202, multiplier, pct).eval_occurrence
    assert {k for _, k in order[:n]} == {i for i in parts["eval"] if int(i[1:]) < 202}


def test_split_with_copies_and_deep_search(spark, monkeypatch):
    """Copies of one id lie across the cut; buckets are split down to single digests."""
    monkeypatch.setattr(SP, "_FETCH_ROWS", 1)
    rows = spark.range(900).select(F.when(F.col("id") < 600, "hot").otherwise(F.concat(F.lit("x"), "id")).alias("example_id"), F.lit("u").alias("category"))
    for a, b in ((300, 300), (100, 750), (0, 900), (899, 1), (500, 20)):
        out = SP.split_by_hash(rows, lambda totals: {c: [("a", a), ("b", b)] for c in totals}, seed=1).collect()
        assert sum(r["split"] == "a" for r in out) == a and sum(r["split"] == "b" for r in out) == b


def test_sample_positions(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("example_id"))
    assert SP.sample_positions(rows, 0, 1).count() == 0
    assert SP.sample_positions(rows, 7, 1).distinct().count() == 7
    assert SP.sample_positions(rows, 500, 1).count() == 100
    assert SP.sample_positions(rows.limit(0), 5, 1).count() == 0


def test_sample_random_files(spark):
    files = spark.createDataFrame([(i, 100) for i in range(1, 11)], "file_no int, n long")
    assert SP.sample_random_files(files, 350, 1).count() == 4
    assert SP.sample_random_files(files, 99999, 1).count() == 10
    assert SP.sample_random_files(files, 99999, 1, include_last=False).agg(F.max("file_no")).first()[0] == 9


# --- numbering -----------------------------------------------------------------------------------


def test_number_rows(spark):
    rnd = random.Random(2)
    values = [(rnd.choice("ab"), rnd.randrange(50), i) for i in range(2000)] + [("a", 7, 5000 + i) for i in range(3000)]
    df = spark.createDataFrame(values, "g string, k int, i int").repartition(5)
    got = N.number_rows(df, ["k"], "n").collect()
    assert sorted(r["n"] for r in got) == list(range(5000))
    ordered = sorted(got, key=lambda r: r["n"])
    assert [r["k"] for r in ordered] == sorted(v[1] for v in values)
    grouped = N.number_rows(df, [F.desc("k")], "n", group="g").collect()
    for g in "ab":
        rows = sorted((r for r in grouped if r["g"] == g), key=lambda r: r["n"])
        assert [r["n"] for r in rows] == list(range(len(rows)))
        assert [r["k"] for r in rows] == sorted((r["k"] for r in rows), reverse=True)


def test_keyset_ranges(spark):
    df = spark.range(0, 8294).select((F.col("id") * 10 + 5).alias("modified_at"))
    ranges = sorted(S.keyset_batches(df, rows=488).collect(), key=lambda r: r["range_no"])
    assert len(ranges) == 17 and ranges[-1]["end_key"] == 0
    assert all(a["end_key"] == b["start_key"] for a, b in zip(ranges, ranges[1:]))
    total = sum(S.scan_key_range(df, r["start_key"], r["end_key"]).count() for r in ranges)
    assert total == 8294
    hot = df.unionByName(spark.range(1000).select(F.lit(25).cast("long").alias("modified_at")))
    again = sorted(S.keyset_batches(hot, rows=250).collect(), key=lambda r: r["start_key"])
    assert again[0]["start_key"] == 5 and again[1]["start_key"] == 25
    assert sum(S.scan_key_range(hot, r["start_key"], r["end_key"]).count() for r in again) == 9294


def test_truncate(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    assert N.truncate_per_group(df, "g", 5, ["id"]).count() == 18
    assert N.truncate_per_group(df, "g", 5, ["id"], strict=True).count() == 15


def test_redistribution_keeps_rows(spark):
    df = spark.range(400).select("id", F.expr("date_add(date'2016-01-01', cast(id as int))").alias("obs_date"))
    for out in (N.diffuse_by_month(df), N.diffuse_by_year(df), N.shuffle_rows(df, F.md5(F.col("id").cast("string")))):
        assert sorted(r["id"] for r in out.collect()) == list(range(400))


def test_dedupe_and_counts(spark):
    rows = [("b", "u", 1.00001, 2.0, "2016-01-01"), ("a", "u", 1.00002, 2.0, "2016-01-01"), ("c", "u", 1.1, 2.0, "2016-01-01")]
    df = spark.createDataFrame(rows, "example_id string, category string, latitude double, longitude double, d string").withColumn("obs_date", F.to_date("d"))
    assert sorted(r["example_id"] for r in G.dedupe_location_date(df).collect()) == ["a", "c"]
    assert tuple(G.count_per_file(df, "d", 0.5).first()) == (1, 3, 3, 2)


# --- features ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def feature_rows(spark):
    rows = [(f"e{i}", "random" if i % 2 else "u", [f"{k}-{min(i, 2)}" for k in range(17)], str(i % 3), "n", i * 10,
             *[[float(i + d) for d in range(120)]] * 5) for i in range(6)]
    return spark.createDataFrame(
        rows, "example_id string, category string, s2_tokens array<string>, eco_biome string, eco_num string, elevation long, "
        "avg_temp array<double>, max_temp array<double>, min_temp array<double>, precipitation array<double>, daylight array<double>")


def test_vocabulary(spark, feature_rows):
    vocabulary = FE.fit_vocabularies(feature_rows)
    ids = {(r["feature"], r["token"]): r["id"] for r in vocabulary.collect()}
    assert ids["s2_token_4", "4-2"] == 0 and ids["s2_token_4", "4-1"] == 1 and ids["s2_token_4", "4-0"] == 2
    assert [ids["eco_biome", t] for t in ("2", "1", "0")] == [0, 1, 2]
    assert {r["feature"]: r["max_id"] for r in FE.domain_max(vocabulary).collect()}["eco_num"] == 0


def test_apply_and_unknown_tokens(spark, feature_rows):
    state = FE.fit(feature_rows)
    fresh = feature_rows.where("example_id = 'e5'").withColumn("eco_biome", F.lit("unseen"))
    wide = FE.token_levels(fresh)
    zero = FE.lookup_vocabulary(wide, state, ["eco_biome", "s2_token_3"]).first()
    own = FE.lookup_vocabulary(wide, state, ["eco_biome", "s2_token_3"], oov="separate").first()
    assert (zero["eco_biome"], zero["s2_token_3"], own["eco_biome"]) == (0, 0, 3)
    by_column = FE._lookup_by_column(wide, state.vocabulary, ["eco_biome", "s2_token_3"], {"eco_biome": 3, "s2_token_3": 0}).first()
    assert (by_column["eco_biome"], by_column["s2_token_3"]) == (3, 0)
    row = FE.apply_transform(feature_rows, state, keep=("example_id",)).where("example_id = 'e5'").first()
    assert row["elevation"] == 1.0 and abs(row["max_temp"][119] - 1.0) < 1e-12 and "avg_temp" not in row.asDict()


def test_weather_features(spark, feature_rows):
    done = FE.weather_features(FE.apply_transform(feature_rows, FE.fit(feature_rows)))
    row = done.first()
    assert [len(row[c]) for c in ("avg_temp", "temp_difference", "precipitation", "daylight")] == [24, 24, 32, 10]
    chunk = feature_rows.select(FE.chunk_mean_slice("max_temp", 3, 0.4).alias("c")).first()["c"]
    assert chunk[0] == pytest.approx(49.0) and chunk[-1] == pytest.approx(118.0)
    assert feature_rows.select(F.size(FE.head_slice("max_temp", 48))).first()[0] == 72


def test_constant_column_scales_to_zero(spark, feature_rows):
    same = feature_rows.withColumn("elevation", F.lit(5).cast("long"))
    scaler = FE.fit_minmax(same).first().asDict()
    assert {r["elevation"] for r in FE.scale_to_0_1(same, scaler).collect()} == {0.0}


def test_experiment_grid(spark):
    grid = E.experiment_grid(spark).orderBy("experiment_id").collect()
    assert len(grid) == 18
    assert [(r["days"], r["days_removed"], r["slice_index"], r["shape"]) for r in grid[:3]] == [(1, 0, 0, 120), (1, 24, 24, 96), (1, 48, 48, 72)]
    assert (grid[17]["days"], grid[17]["slice_index"], grid[17]["shape"]) == (6, 8, 12)


# --- listings ------------------------------------------------------------------------------------


def test_listings(spark):
    paths = ["occurrences/ab/1.tfrecords", "occurrences/ab/2.tfrecords", "occurrences/abc/3.tfrecords", "protected_areas/20180101/5.tfrecords",
             "random/1/1.tfrecords", "random/2/1.tfrecords", "random/2/2.tfrecords", "random/2/4.tfrecords", "occurrences/ab/", "stray"]
    listing = spark.createDataFrame([(p,) for p in paths], "path string")
    assert sorted(r[0] for r in L.latest_example_files(listing).collect()) == [
        "occurrences/ab/2.tfrecords", "occurrences/abc/3.tfrecords", "protected_areas/20180101/5.tfrecords",
        "random/2/1.tfrecords", "random/2/2.tfrecords", "random/2/4.tfrecords"]
    assert L.latest_occurrence_file(listing, "ab", exact=False).first()[0] == "occurrences/abc/3.tfrecords"
    assert L.latest_occurrence_file(listing, "ab", exact=True).first()[0] == "occurrences/ab/2.tfrecords"
    assert L.latest_occurrence_file(listing, "zz").count() == 0
    assert sorted(r["file_no"] for r in L.latest_random_dir(listing, until_gap=True).collect()) == [1, 2]
    assert L.latest_version(listing, "/random/") == "random/2"
    with pytest.raises(ValueError):
        L.latest_version(listing, "models")
