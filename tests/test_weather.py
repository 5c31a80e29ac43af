import datetime
import random

import pytest
from pyspark.sql import functions as F

from phenolith.functions.sun import with_daylight
from phenolith.operators import weather as W
from phenolith.schema import WEATHER_COLUMNS
from tests.test_geo import km

DAY0 = datetime.date(2016, 1, 1)


def day(n):
    return DAY0 + datetime.timedelta(days=n)


@pytest.fixture(scope="module")
def fixture(spark):
    """Stations with random gaps around a few points; two share a position."""
    rnd = random.Random(11)
    stations = [(str(i), str(i % 3), round(40 + rnd.uniform(-0.7, 0.7), 3), round(-80 + rnd.uniform(-0.9, 0.9), 3)) for i in range(12)]
    stations.append(("90", "0", stations[0][2], stations[0][3]))
    readings = []
    for i, (stn, wban, *_) in enumerate(stations):
        gaps = {rnd.randrange(500) for _ in range(i % 4)} if i < 12 else set(range(0, 500, 2))
        for n in range(500):
            if n in gaps:
                continue
            d = day(n)
            readings.append((stn, wban, f"{d:%Y}", f"{d:%m}", f"{d:%d}", 50.0 + i + n / 1000, 40.0 + i, 60.0 + i + n / 1000, i / 10))
    points = [(f"e{i}", "u", round(40 + rnd.uniform(-0.9, 0.9), 2), round(-80 + rnd.uniform(-1.2, 1.2), 2), day(rnd.randrange(60, 520))) for i in range(80)]
    s = spark.createDataFrame(stations, "usaf string, wban string, lat double, lon double")
    r = spark.createDataFrame(readings, "stn string, wban string, year string, mo string, da string, temp double, min double, max double, prcp double")
    tokens = ",".join(f"'t{k}'" for k in range(17))
    o = spark.createDataFrame(points, "example_id string, category string, latitude double, longitude double, obs_date date").withColumn(
        "s2_tokens", F.expr(f"array({tokens})"))
    table = {}
    for stn, wban, y, m, d, temp, low, high, prcp in sorted(readings, key=lambda x: (x[0], x[1])):
        lat, lon = next((a, b) for u, w, a, b in stations if u == stn and w == wban)
        table.setdefault((f"{lat:.6f}|{lon:.6f}"), {})[datetime.date(int(y), int(m), int(d))] = (temp, high, low, prcp)
    return s, r, o, table, points


def brute(table, points):
    want = {}
    for ident, _, lat, lon, date in points:
        end = date - datetime.timedelta(days=3)
        days = [end - datetime.timedelta(days=119 - k) for k in range(120)]
        near = sorted((round(km(lat, lon, *map(float, key.split("|"))), 6), key) for key in table)
        for distance, key in near:
            if distance <= 100 and all(d in table[key] for d in days):
                want[ident] = (key, [table[key][d] for d in days])
                break
    return want


def test_nearest_complete_window(spark, fixture):
    s, r, o, table, points = fixture
    days = W.station_days(W.join_weather_stations(r, s))
    got = {x["example_id"]: x for x in W.nearest_complete_window(o, days).collect()}
    want = brute(table, points)
    assert 10 < len(want) < len(points) and set(got) == set(want)
    for ident, (key, values) in want.items():
        row = got[ident]
        assert row["station_key"] == key
        assert list(zip(row["avg_temp"], row["max_temp"], row["min_temp"], row["precipitation"])) == values
        assert all(len(row[c]) == 120 for c in WEATHER_COLUMNS) and all(30000 < x < 60000 for x in row["daylight"])
        assert all(a > b for a, b in zip(row["max_temp"], row["min_temp"]))
    missing = {x["example_id"] for x in W.unmatched_observations(o, days).collect()}
    assert missing == {p[0] for p in points} - set(want)


def test_same_result_with_other_partitions_and_joins(spark, fixture):
    s, r, o, *_ = fixture
    days = W.station_days(W.join_weather_stations(r, s), daylight=False)
    pick = lambda **k: sorted((x["example_id"], x["station_key"]) for x in W.match_stations(o, days, **k).collect())
    first = pick()
    assert pick(inner_rings=()) == first and pick(inner_rings=((5.0, 0.1), (40.0, 0.5)), cell=2.0) == first
    saved = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert pick() == first
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_completeness_and_runs(spark):
    present = [n for n in range(300) if n != 130]
    df = spark.createDataFrame([("a", day(n)) for n in present], "station_key string, day date")
    counts = {r["day"]: r["days_present"] for r in W.window_completeness(df).collect()}
    for n in present:
        assert counts[day(n)] == sum(1 for m in present if n - 119 <= m <= n)
    runs = sorted((r[1], r[2]) for r in W.gap_free_runs(df).collect())
    assert runs == [(day(119), day(129)), (day(250), day(299))]


def test_sentinels_and_merge(spark):
    stations = spark.createDataFrame([("1", "0", 40.0, -80.0), ("2", "0", 40.0, -80.0)], "usaf string, wban string, lat double, lon double")
    readings = spark.createDataFrame(
        [("1", "0", "2016", "01", "01", 1.0, 1.0, 1.0, 0.1), ("2", "0", "2016", "01", "01", 2.0, 2.0, 2.0, 0.2),
         ("1", "0", "2016", "01", "02", 3.0, 3.0, 9999.9, 0.1), ("1", "0", "2016", "01", "03", 4.0, 4.0, 4.0, 99.99)],
        "stn string, wban string, year string, mo string, da string, temp double, min double, max double, prcp double")
    joined = W.join_weather_stations(readings, stations)
    plain = {r["day"].day: r["avg_temp"] for r in W.station_days(joined, daylight=False).collect()}
    assert plain == {1: 2.0, 2: 3.0, 3: 4.0}
    strict = {r["day"].day: r["avg_temp"] for r in W.station_days(joined, null_sentinels=True, daylight=False).collect()}
    assert strict == {1: 2.0}


def test_daylight(spark):
    rows = [("equator", 0.1, 10.0, "2018-03-20"), ("summer", 45.0, 10.0, "2018-06-21"), ("winter", 45.0, 10.0, "2018-12-21"),
            ("bright", 62.0, 20.0, "2018-06-21"), ("polar", 75.0, 20.0, "2018-12-21"), ("dusk", 68.5, 20.0, "2018-12-21"),
            ("west", 45.0, -170.0, "2018-06-21")]
    df = spark.createDataFrame(rows, "name string, lat double, lon double, d string").withColumn("day", F.to_date("d"))
    got = {r["name"]: r["daylight"] for r in with_daylight(df).collect()}
    assert abs(got["equator"] - 43600) < 120
    assert abs(got["summer"] - 56220) < 300 and abs(got["winter"] - 31550) < 300
    assert abs(got["west"] - got["summer"]) <= 1
    assert got["bright"] == 86400 and got["polar"] == 86400 and got["dusk"] is None
    plain = {r["name"]: r["daylight"] for r in with_daylight(df, civil_rule=False).collect()}
    assert 60000 < plain["bright"] < 80000 and plain["polar"] is None


def test_year_month_plan(spark):
    df = spark.createDataFrame([(datetime.date(2017, 4, 6),), (datetime.date(2017, 4, 8),)], "obs_date date")
    got = {(r[0], r[1]) for r in W.year_month_plan(df).collect()}
    assert got == {(2016, 12), (2017, 1), (2017, 2), (2017, 3), (2017, 4)}


def test_a_dense_place_forms_few_pairs(spark, monkeypatch):
    """10,000 stations in one cell of a degree, half of them with a gap, and a few far away: few pairs per request, the nearest of all."""
    rnd = random.Random(5)
    places = [(round(40.2 + rnd.random() * 0.6, 6), round(-80.8 + rnd.random() * 0.6, 6)) for _ in range(10_000)] + [(41.5, -79.5), (38.0, -85.0)]
    runs = [(f"{lat:.6f}|{lon:.6f}", lat, lon, day(100), day(400) if i % 2 else day(150)) for i, (lat, lon) in enumerate(places)]
    held = spark.createDataFrame(runs, "station_key string, lat double, lon double, first_end date, last_end date")
    monkeypatch.setattr(W, "gap_free_runs", lambda days, length: held.select("station_key", "first_end", "last_end"))
    points = [(f"e{i}", round(40.1 + rnd.random() * 0.8, 4), round(-80.9 + rnd.random() * 0.8, 4), day(rnd.choice([120, 300]))) for i in range(300)]
    points += [("far", 41.9, -79.5, day(300)), ("none", 10.0, 10.0, day(300))]
    o = spark.createDataFrame(points, "example_id string, latitude double, longitude double, obs_date date")
    pairs, nearest = [], W._nearest

    def counted(joined, *more):
        pairs.append(joined.count())
        return nearest(joined, *more)

    monkeypatch.setattr(W, "_nearest", counted)
    got = {r["example_id"]: (r["station_key"], r["km"]) for r in W.match_stations(o, None).collect()}
    assert sum(pairs) < 500 * len(points)  # of 7,500 or so that the full radius would form for each
    for name, lat, lon, date in points:
        end = date - datetime.timedelta(days=3)
        near = sorted((round(km(lat, lon, a, b), 6), key) for key, a, b, first, last in runs if first <= end <= last and abs(a - lat) < 1.5)
        want = [(key, d) for d, key in near if d <= 100][:1]
        assert [got[name]] == want if want else name not in got


def test_only_needed_months_and_stations_are_read(spark):
    from phenolith.plans.enrich import needed_days, readings_of_span

    o = spark.createDataFrame([(40.0, -80.0, datetime.date(2016, 7, 1)), (40.1, -80.0, datetime.date(2018, 1, 10)), (40.1, -80.0, None)], "latitude double, longitude double, obs_date date")
    months = {(r["year"], r["month"]) for r in W.window_months(o).collect()}
    assert months == {(2016, m) for m in range(3, 8)} | {(2017, m) for m in (9, 10, 11, 12)} | {(2018, 1)}  # 122 days back from both
    days = spark.range(1200).selectExpr("date_add(date '2015-06-01', int(id)) as d", "explode(array('1', '2')) as stn").selectExpr(
        "stn", "'0' as wban", "date_format(d, 'yyyy') as year", "date_format(d, 'MM') as mo", "date_format(d, 'dd') as da", "50D as temp", "40D as min", "60D as max", "0D as prcp")
    got = {(int(r["year"]), int(r["mo"])) for r in readings_of_span(days, o).select("year", "mo").distinct().collect()}
    assert got == months
    stations = spark.createDataFrame([("1", "0", 40.3, -80.2), ("2", "0", 47.0, -80.0)], "usaf string, wban string, lat double, lon double")
    kept = needed_days(o, days, stations)
    assert {r["station_key"] for r in kept.select("station_key").distinct().collect()} == {"40.300000|-80.200000"}
    assert needed_days(o.limit(0), days, stations).count() == 0
