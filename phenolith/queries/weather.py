"""Stations, windows and daylight."""

from pyspark.sql import functions as F

from phenolith import adapters as A
from phenolith.functions import columns as X
from phenolith.operators import weather as W
from phenolith.plans.enrich import enrich
from phenolith.queries import query
from phenolith.schema import WEATHER_COLUMNS
from phenolith.session import write_once


def _joined(spark, sf):
    return W.join_weather_stations(A.readings(spark, sf), A.stations(spark, sf))


def _observed(spark, sf, *more):
    """What the search for stations reads of the observations, written once since its requests, boxes and matches each read them."""
    return write_once(A.observations(spark, sf).select("example_id", "category", "latitude", "longitude", "obs_date", *more), "observations")


def _days(spark, sf, daylight=True):
    return W.station_days(_joined(spark, sf), daylight=daylight)


@query("""SELECT stn, wban, lat, lon, count(*) AS n, sum(max)::DOUBLE AS max_sum, sum(min)::DOUBLE AS min_sum, sum(temp)::DOUBLE AS temp_sum
  FROM joined GROUP BY ALL""")
def join_weather_stations(spark, sf):
    return _joined(spark, sf).groupBy("stn", "wban", "lat", "lon").agg(
        F.count("*").alias("n"), F.sum("max").alias("max_sum"), F.sum("min").alias("min_sum"), F.sum("temp").alias("temp_sum"))


@query("""SELECT stn, year, mo, count(*) AS n, sum(max)::DOUBLE AS max_sum FROM joined
  WHERE lat BETWEEN 28 AND 34 AND lon BETWEEN -105 AND -95 AND mo IN ('01', '02', '07') GROUP BY ALL""")
def filter_station_box(spark, sf):
    boxed = W.filter_station_box(_joined(spark, sf), 28, 34, -105, -95, months=[1, 2, 7])
    return boxed.groupBy("stn", "year", "mo").agg(F.count("*").alias("n"), F.sum("max").alias("max_sum"))


@query("""SELECT DISTINCT year(d)::INTEGER AS year, month(d)::INTEGER AS month FROM (
    SELECT (SELECT min(obs_date) - 122 FROM obs) + i::INTEGER AS d
    FROM range(0, (SELECT max(obs_date) - min(obs_date) + 123 FROM obs)) AS t(i))""")
def year_month_plan(spark, sf):
    return W.year_month_plan(A.observations(spark, sf))


@query("""SELECT year, mo, count(*) AS n, sum(temp)::DOUBLE AS temp_sum, round(sum(prcp), 4) AS prcp_sum FROM joined
  WHERE year::INTEGER BETWEEN (SELECT year(min(obs_date) - 122) FROM obs) AND (SELECT year(max(obs_date)) FROM obs) GROUP BY ALL""")
def scan_daily_weather(spark, sf):
    """Only the years that the windows of all observations touch are read."""
    years = sorted({r["year"] for r in W.year_month_plan(A.observations(spark, sf)).collect()})
    readings = A.readings(spark, sf)
    needed = readings.where(readings["year"].cast("int").isin(years))
    return W.join_weather_stations(needed, A.stations(spark, sf)).groupBy("year", "mo").agg(
        F.count("*").alias("n"), F.sum("temp").alias("temp_sum"), F.round(F.sum("prcp"), 4).alias("prcp_sum"))


@query("""SELECT station_key, count(*) AS n, sum(max_temp)::DOUBLE AS max_sum, sum(min_temp)::DOUBLE AS min_sum,
    round(sum(precipitation), 4) AS prcp_sum FROM plain_days GROUP BY station_key""")
def station_days(spark, sf):
    return _days(spark, sf, daylight=False).groupBy("station_key").agg(
        F.count("*").alias("n"), F.sum("max_temp").alias("max_sum"), F.sum("min_temp").alias("min_sum"),
        F.round(F.sum("precipitation"), 4).alias("prcp_sum"))


@query("""SELECT station_key, sum(daylight)::BIGINT AS total, min(daylight) AS shortest, max(daylight) AS longest
  FROM days GROUP BY station_key""")
def daylight_seconds(spark, sf):
    return _days(spark, sf).groupBy("station_key").agg(
        F.sum("daylight").alias("total"), F.min("daylight").alias("shortest"), F.max("daylight").alias("longest"))


@query("SELECT latitude, longitude, station_key, round(km, 3) AS km FROM near")
def stations_within_radius(spark, sf):
    pairs = W.stations_within_radius(A.observations(spark, sf), A.stations(spark, sf))
    return pairs.withColumn("km", F.round("km", 3))


@query("""SELECT station_key, days_present, count(*) AS n FROM (
    SELECT station_key, count(*) OVER (PARTITION BY station_key ORDER BY day RANGE BETWEEN INTERVAL 119 DAYS PRECEDING AND CURRENT ROW) AS days_present
    FROM plain_days) GROUP BY ALL""")
def window_completeness(spark, sf):
    return W.window_completeness(_days(spark, sf, daylight=False)).groupBy("station_key", "days_present").agg(F.count("*").alias("n"))


@query("""SELECT station_key, strftime(min(end_day), '%Y%m%d') AS first_end, strftime(max(end_day), '%Y%m%d') AS last_end FROM (
    SELECT station_key, end_day, end_day - (row_number() OVER (PARTITION BY station_key ORDER BY end_day))::INTEGER AS run FROM complete)
  GROUP BY station_key, run""")
def gap_free_runs(spark, sf):
    runs = W.gap_free_runs(_days(spark, sf, daylight=False))
    return runs.select("station_key", X.date_key("first_end").alias("first_end"), X.date_key("last_end").alias("last_end"))


@query("SELECT example_id, station_key, round(km, 3) AS km FROM best")
def nearest_complete_station(spark, sf):
    matched = W.match_stations(_observed(spark, sf), _days(spark, sf, daylight=False))
    return matched.select("example_id", "station_key", F.round("km", 3).alias("km"))


PROBED = [1, 2, 60, 120]


def summarise(enriched, kept=("example_id", "category")):
    """Sum and four elements of every series: enough to pin order, content and length."""
    columns = []
    for c in WEATHER_COLUMNS:
        total = F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
        columns.append(F.round(total, 4).alias(f"{c}_sum"))
        columns += [F.round(F.try_element_at(c, F.lit(p)).cast("double"), 4).alias(f"{c}_{p}") for p in PROBED]
    return enriched.select(*kept, F.size("max_temp").alias("days"), *columns)


def summary_sql(source: str, kept: str) -> str:
    columns = []
    for c in WEATHER_COLUMNS:
        columns.append(f"round(sum({c}), 4)::DOUBLE AS {c}_sum")
        columns += [f"round(max({c}) FILTER (WHERE pos = {p - 1}), 4)::DOUBLE AS {c}_{p}" for p in PROBED]
    return f"SELECT {kept}, count(*)::INTEGER AS days, {', '.join(columns)} FROM {source} GROUP BY {kept}"


@query(summary_sql("win", "example_id, category"))
def nearest_complete_window(spark, sf):
    return summarise(W.nearest_complete_window(_observed(spark, sf), _days(spark, sf)))


@query("""SELECT category, count(*) AS n, round(avg(mean), 4) AS mean_max_temp FROM (
    SELECT category, example_id, sum(max_temp) / 120 AS mean FROM win GROUP BY ALL) GROUP BY category""")
def enrich_by_category(spark, sf):
    """The whole enrichment job up to the write, with the mean of the 120 maxima per category."""
    rows = enrich(A.parsed_observations(spark, sf), A.readings(spark, sf), A.stations(spark, sf))
    mean = F.aggregate("max_temp", F.lit(0.0), lambda a, x: a + x) / 120
    return rows.groupBy("category").agg(F.count("*").alias("n"), F.round(F.avg(mean), 4).alias("mean_max_temp"))


@query("SELECT example_id, station_key, round(km, 3) AS km FROM box_best")
def nearest_station_group_box(spark, sf):
    """With the box of the season-region group as a further filter, which loses stations of wide groups."""
    matched = W.match_stations(_observed(spark, sf, "s2_tokens"), _days(spark, sf, daylight=False), prefilter="group_box")
    return matched.select("example_id", "station_key", F.round("km", 3).alias("km"))


@query("SELECT example_id, category FROM obs WHERE example_id NOT IN (SELECT example_id FROM best)")
def unmatched_observations(spark, sf):
    return W.unmatched_observations(_observed(spark, sf), _days(spark, sf, daylight=False)).select("example_id", "category")
