"""What is dear to derive is derived once: later steps read what was written."""

import datetime
from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from phenolith.operators import features as FE
from phenolith.operators import sampling as SP
from phenolith.operators import weather as W
from phenolith.queries import load, output
from phenolith.queries import weather as QW
from phenolith.schema import WEATHER_COLUMNS


@pytest.fixture
def folder(spark, tmp_path):
    day = datetime.datetime(1996, 5, 1)
    orders = [(i, i % 40 + 1, "P" if i % 3 == 0 else "F", day + datetime.timedelta(days=i % 50)) for i in range(1, 300)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(i,) for i in range(1, 30)], "p_partkey long").write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def derived(df) -> bool:
    return any("orders.parquet" in f or "part.parquet" in f for f in df.inputFiles())


def kept(monkeypatch, module, name, at=0):
    seen, old = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *a, **b: (seen.append(a[at]), old(*a, **b))[1])
    return seen


def test_random_rows_are_derived_once(spark, folder, monkeypatch):
    seen = kept(monkeypatch, SP, "split_by_file")
    load()["split_by_file"].run(spark, folder).count()
    assert len(seen) == 1 and seen[0].count() > 0 and not derived(seen[0])


def test_both_versions_read_the_same_written_rows(spark, folder, monkeypatch):
    seen = kept(monkeypatch, output.C, "stage")
    load()["union_file_sets"].run(spark, folder).count()
    assert len(seen) == 2 and not any(derived(x) for x in seen)


@pytest.mark.parametrize("name", ["nearest_complete_station", "nearest_station_group_box", "nearest_complete_window", "unmatched_observations"])
def test_observations_and_requests_are_written_before_the_search(spark, folder, monkeypatch, name):
    days = spark.range(400).select(
        F.lit("30.000000|-100.000000").alias("station_key"), F.expr("date_add(date '1995-09-01', cast(id as int))").alias("day"),
        *[F.lit(1.0).alias(c) for c in WEATHER_COLUMNS])
    monkeypatch.setattr(QW, "_days", lambda *a, **b: days)
    given, asked = kept(monkeypatch, W, "nearest_complete_station"), kept(monkeypatch, W, "_fitting_levels")
    load()[name].run(spark, folder).count()
    assert not derived(given[0]) and not any("observations-" in f for f in asked[0].inputFiles())


def test_a_series_is_computed_once_for_all_its_chunks(spark):
    rows = spark.createDataFrame([([float(i) for i in range(12)],), (None,)], "a array<double>")
    means = rows.withColumn("s", F.transform("a", lambda x: x * 2 + 1)).select(FE.chunk_mean_slice("s", 3, 0.25, 12).alias("m"))
    assert "slice(transform" not in means._jdf.queryExecution().optimizedPlan().toString()
    assert [r["m"] for r in means.collect()][0] == [9.0, 15.0, 21.0]


def test_chunk_means_of_odd_series_are_those_of_a_loop(spark):
    series = [
        None, [], [1.5] * 7, [0.1 * k for k in range(120)], [None if k in (50, 119) else 0.3 * k for k in range(120)], [0.7 * k for k in range(130)], [float("inf")] * 119]
    given = spark.createDataFrame(list(enumerate(series)), "i int, s array<double>")
    for days, share in ((3, 0.4), (12, None), (7, None)):
        chunks, first = FE.chunk_count(days, share)
        got = given.select("i", FE.chunk_mean_slice("s", days, share).alias("c"))
        assert "ArrowEvalPython" in got._jdf.queryExecution().toString()  # no lambda a chunk and day
        for i, c in got.collect():
            parts = [None if series[i] is None else series[i][k * days : (k + 1) * days] for k in range(first, chunks)]
            assert c == [None if p is None or None in p else reduce(add, p, 0.0) / days for p in parts]
    counts = given.selectExpr("i", "transform(s, x -> CAST(x AS INT)) AS s").where("i = 3")
    assert counts.select(FE.chunk_mean_slice("s", 12).alias("c")).first()["c"] == [sum(int(0.1 * k) for k in range(12 * j, 12 * j + 12)) / 12 for j in range(10)]


def test_numbers_are_scaled_after_the_lookup(spark):
    """Rows that are shuffled for the lookup go as they were read."""
    from phenolith.schema import SCALED_COLUMNS

    rows = spark.createDataFrame(
        [("e", "u1", ["t"] * 17, "1", "2", 5, *[[1.0, 3.0]] * 4)],
        "example_id string, category string, s2_tokens array<string>, eco_biome string, eco_num string, elevation long, max_temp array<double>, min_temp array<double>, "
        "precipitation array<double>, daylight array<double>")
    done = FE.apply_transform(rows, FE.fit(rows), keep=("example_id",))
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("lambdafunction") < plan.index("Join LeftOuter")
    got = done.first()
    assert got["max_temp"] == [0.0, 1.0] and got["elevation"] == 0.0 and got["s2_token_3"] == 0 and set(SCALED_COLUMNS) < set(done.columns)
