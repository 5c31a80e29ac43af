"""Tables that grow with the input meet by shuffles: none is sent whole through the driver, however small its files make it look."""

import datetime

import pytest
from pyspark.sql import functions as F

from phenolith import adapters as A
from phenolith.functions import geo
from phenolith.operators import features as FE
from phenolith.operators import weather as W
from phenolith.queries import feature, load
from phenolith.schema import VOCABULARY_COLUMNS, WEATHER_COLUMNS


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def searched(spark):
    days = spark.range(400).select(
        F.lit("30.000000|-100.000000").alias("station_key"), F.expr("date_add(date '1995-09-01', cast(id as int))").alias("day"), *[F.lit(1.0).alias(c) for c in WEATHER_COLUMNS])
    rows = [(f"e{i}", 30.0 + i % 5 / 10, -100.0, datetime.date(1996, 5, 1) + datetime.timedelta(days=i % 50)) for i in range(60)]
    return spark.createDataFrame(rows, "example_id string, latitude double, longitude double, obs_date date"), days


@pytest.mark.parametrize("options", [{}, {"inner_rings": ((5.0, 0.1),)}])
def test_search_for_stations_is_joined_by_shuffles(searched, monkeypatch, options):
    pairs, nearest = [], W._nearest
    monkeypatch.setattr(W, "_nearest", lambda p, *a: (pairs.append(p), nearest(p, *a))[1])
    matched = W.match_stations(*searched, **options)
    assert matched.count() == 60 and len(pairs) == (2 if options else 3)
    for df in (matched, *pairs):
        joins = [line for line in plan(df).splitlines() if "Join" in line and "LeftSemi" not in line]
        assert joins and all("SortMergeJoin" in line for line in joins), joins


def test_matches_are_read_not_searched_again(searched):
    """Neither the matches nor the blocks of their windows hold the search, whose exchanges the driver would plan and run for both."""
    done = W.nearest_complete_window(*searched)
    assert "end_month" not in plan(done) and done.count() == 60
    joins = [line for line in plan(done).splitlines() if "Join" in line]
    assert joins and all("SortMergeJoin" in line for line in joins), joins


def test_cells_of_levels_are_not_broadcast(searched, monkeypatch):
    levels, fitting = [], W._fitting_levels
    monkeypatch.setattr(W, "_fitting_levels", lambda *a: (levels.append(fitting(*a)), levels[-1])[1])
    pairs, nearest = [], W._nearest
    monkeypatch.setattr(W, "_nearest", lambda p, *a: (pairs.append(p), nearest(p, *a))[1])
    assert W.match_stations(*searched).count() == 60
    assert all("Broadcast" not in plan(df) for df in (*levels, *pairs))


def test_cells_are_no_constants_of_the_plan(spark):
    """All columns of a fine grid as a constant would go into every plan and task that the driver makes."""
    columns, size = 4 * 360 * 256, 0.25 / 256
    places = spark.createDataFrame([(30.0, -100.0), (89.9999, 10.0), (None, 10.0), (89.9999, None), (30.0, None)], "lat double, lon double")
    reach = places.select("lat", "lon", geo.reachable_cells("lat", "lon", 25.0 / 256, size).alias("cells"))
    tree = reach._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" in tree and "UnsafeArrayData" not in tree
    cells = {(r["lat"], r["lon"]): r["cells"] for r in reach.withColumn("cells", F.size(F.array_distinct("cells.cell_x"))).collect()}
    assert cells[89.9999, 10.0] == cells[89.9999, None] == columns
    assert 2 <= cells[30.0, -100.0] <= 5 and {cells[None, 10.0], cells[30.0, None]} <= {None, -1}


def test_very_many_stations_are_not_broadcast(spark, monkeypatch):
    stations = spark.range(5).selectExpr("cast(id as string) as usaf", "'1' as wban", "30.0D + id as lat", "-100.0D as lon")
    readings = spark.range(50).selectExpr("cast(id % 7 as string) as stn", "'1' as wban", "cast(id as double) as max")
    assert W.join_weather_stations(readings, stations).count() == 36
    monkeypatch.setattr(W, "SENT_STATIONS", 4)
    joined = W.join_weather_stations(readings, stations)
    assert "SortMergeJoin" in plan(joined) and "Broadcast" not in plan(joined) and joined.count() == 36


def test_readings_are_not_shuffled_for_their_gaps(spark, tmp_path):
    """Also with a supplier that comes twice, one without key, and shipments without supplier or day or repeated."""
    at = {name: str(tmp_path / f"{name}.parquet") for name in ("supplier", "orders", "lineitem")}
    spark.createDataFrame([(1,), (2,), (2,), (None,)], "s_suppkey long").write.parquet(at["supplier"])
    spark.sql("select timestamp'1996-01-01' as o_orderdate union all select timestamp'1996-03-31'").write.parquet(at["orders"])
    shipped = [(2, "R", 50.0, "1996-02-03"), (2, "R", 50.0, "1996-02-03"), (2, "R", 51.0, "1996-02-29"), (2, "R", 49.0, "1996-02-04"), (2, "A", 50.0, "1996-02-05"),
               (None, "R", 50.0, "1996-02-06"), (1, "R", 50.0, None), (9, "R", 50.0, "1996-02-07")]
    spark.createDataFrame(shipped, "l_suppkey long, l_returnflag string, l_quantity double, d string").selectExpr(
        "l_suppkey", "l_returnflag", "l_quantity", "cast(d as timestamp) as l_shipdate").write.parquet(at["lineitem"])
    readings = A.readings(spark, str(tmp_path))
    february = readings.where("year = '1996' and mo = '02'").groupBy("stn").agg(F.count("*").alias("n"), F.collect_set("da").alias("days")).collect()
    assert {r["stn"]: r["n"] for r in february} == {"1": 29, "2": 2 * 27, None: 29}
    assert all({"03", "29"} & {*r["days"]} == set() for r in february if r["stn"] == "2")
    assert "LeftAnti" not in plan(readings)
    # The product of suppliers and days is the last that moves anything.
    assert "Exchange" not in plan(readings).split("BroadcastNestedLoopJoin")[0].split("CartesianProduct")[0]


def rows_with_places(spark):
    tokens = F.array(*[F.concat(F.lit(f"{k}_"), (F.col("id") % (k + 1)).cast("string")) for k in range(17)])
    series = [F.array(F.col("id").cast("double"), F.lit(1.0)).alias(c) for c in ("min_temp", "max_temp", "precipitation")]
    return spark.range(40).select(
        F.concat(F.lit("e"), "id").alias("example_id"), F.lit("u").alias("category"), tokens.alias("s2_tokens"), F.lit("1").alias("eco_biome"), F.lit("2").alias("eco_num"),
        F.col("id").alias("elevation"), *series, F.array(F.col("id"), F.lit(1).cast("long")).alias("daylight"))


def test_places_in_long_form_are_not_broadcast(spark):
    rows = rows_with_places(spark)
    done = FE.lookup_vocabulary(FE.token_levels(rows).select("example_id", *VOCABULARY_COLUMNS), FE.fit(rows), VOCABULARY_COLUMNS)
    assert "SortMergeJoin [feature" in plan(done) and done.count() == 40


def test_lookup_by_joins_reads_a_written_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(feature, "enriched", lambda s, d: rows_with_places(s))
    seen, old = [], FE._lookup_by_column
    monkeypatch.setattr(FE, "_lookup_by_column", lambda df, v, *a: (seen.append(v), old(df, v, *a))[1])
    assert load()["lookup_vocabulary_by_join"].run(spark, "").count() == 40
    assert seen[0].inputFiles() and all("vocabulary-" in f for f in seen[0].inputFiles())
