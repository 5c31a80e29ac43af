"""Observations in, enriched rows by category out."""

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenolith.functions import columns as X
from phenolith.operators import observations as O
from phenolith.operators import weather as W
from phenolith.schema import ENRICHED_SCHEMA
from phenolith.session import write_once
from phenolith.sinks import catalogue as C
from phenolith.sinks.writers import with_layout

#: Rows of a published version: the enriched columns and, for rejects, the reasons.
PUBLISHED_SCHEMA = T.StructType(ENRICHED_SCHEMA.fields + [T.StructField("reasons", T.ArrayType(T.StringType()))])


def union_examples(*parts: DataFrame) -> DataFrame:
    """Bag union of parsed observation frames."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def enrich(parsed: DataFrame, readings: DataFrame, stations: DataFrame, null_sentinels: bool = False,
           **options) -> DataFrame:
    """Validate, look up the nearest complete weather history and attach it.

    The good observations feed the pruning, the requests and the join back, the station days the search for gaps and the windows:
    each is written once, so that neither the documents are parsed nor the readings shuffled twice.
    """
    good = O.filter_year(O.valid_observations(parsed)).select(*O.OBSERVATION_COLUMNS)
    good = write_once(good, "observations")
    days = needed_days(good, readings, stations, null_sentinels, options.get("radius_km", W.STATION_RADIUS_KM))
    return W.usable_daylight(W.nearest_complete_window(good, days, **options)).drop("end_day", "season_region_key")


def needed_days(observations: DataFrame, readings: DataFrame, stations: DataFrame, null_sentinels: bool = False,
                radius_km: float = W.STATION_RADIUS_KM) -> DataFrame:
    """Station days that a window of the observations may need, written once: stations that some observation can reach, months that some window touches."""
    reached = write_once(W.reachable_stations(stations, observations, radius_km), "stations")
    return write_once(W.station_days(W.join_weather_stations(readings_of_span(readings, observations), reached), null_sentinels), "station-days")


def readings_of_span(readings: DataFrame, observations: DataFrame) -> DataFrame:
    """Readings of the months that the windows touch, as literals: whole years and months are left out of the scan.

    The months are a few hundred at most; knowing them before planning is what lets the scan skip the rest.
    """
    by_year: dict[int, list[str]] = {}
    for r in W.window_months(observations).collect():
        by_year.setdefault(r["year"], []).append(f"{r['month']:02d}")
    whole = [y for y, months in by_year.items() if len(months) == 12]
    year, month = readings["year"].cast("int"), readings["mo"]
    wanted = year.isin(whole) if whole else F.lit(False)
    for y, months in sorted(by_year.items()):
        if y not in whole:
            wanted = wanted | ((year == y) & month.isin(sorted(months)))
    return readings.where(year.isin(sorted(by_year)) & wanted)


class Enriched(NamedTuple):
    """What a run has published, and its accounts."""

    attempt: str
    rows_in: int
    written: int
    rejected: int


def run_enrich(parsed: DataFrame, readings: DataFrame, stations: DataFrame, root: str, version: str, null_sentinels: bool = False, **options) -> Enriched:
    """Enrich and publish one version below ``root``; every row that isn't written is a reject with its reasons.

    Rows keep their identity by position, not by an id that may be repeated or null: each step adds to a row's reasons instead of dropping it, and one write
    splits the rows into the category layout and the rejects (kind ``rejects``, by first reason). Reasons beyond those of validation: ``year``,
    ``no_complete_station``, ``category_unroutable`` and ``no_daylight``. The counts of rows in, written and rejected are observed on the way and
    must add up, or nothing is published. A version that is run again is replaced whole.
    """
    spark = parsed.sparkSession
    judged = O.with_reasons(parsed)
    in_years = F.year("obs_date").between(F.lit(O.MINIMUM_YEAR), F.year(F.current_date()))
    late = F.when((F.size("reasons") == 0) & ~F.coalesce(in_years, F.lit(False)), F.array(F.lit("year"))).otherwise(F.col("reasons"))
    source = Observation("parsed")
    rows = write_once(judged.observe(source, F.count("*").alias("n")).withColumn("reasons", late).select(*O.OBSERVATION_COLUMNS, "reasons"), "judged")
    good = rows.where(F.size("reasons") == 0).drop("reasons")
    days = needed_days(good, readings, stations, null_sentinels, options.get("radius_km", W.STATION_RADIUS_KM))
    best = W.nearest_complete_station(good, days, **options)
    matched = W.match_stations(good, days, how="left", best=best, **options)
    filled = W.attach_windows(matched, days, options.get("length", W.WEATHER_DAYS), how="left", best=best).withColumn("routing_category", X.routing_category())
    usable = X.valid_category("routing_category") & X.category_path("routing_category", F.lit(version)).isNotNull()
    flags = [
        (F.col("station_key").isNull(), "no_complete_station"), (~F.coalesce(usable, F.lit(False)), "category_unroutable"),
        (F.col("station_key").isNotNull() & F.coalesce(F.array_contains("daylight", 0), F.lit(True)), "no_daylight")]
    done = filled.withColumn("reasons", F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in flags])))
    bad = rows.where(F.size("reasons") > 0).withColumn("routing_category", F.lit(None).cast("string"))
    columns = [f.name for f in PUBLISHED_SCHEMA.fields]
    every = with_layout(done.select(*columns, "routing_category").unionByName(bad, allowMissingColumns=True), version)
    every = every.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in PUBLISHED_SCHEMA.fields})  # what readers declare
    rejected = F.size("reasons") > 0
    every = every.withColumns({
        "kind": F.when(rejected, F.lit(C.REJECTED)).otherwise(F.col("kind")), "part_a": F.when(rejected, F.element_at("reasons", 1)).otherwise(F.col("part_a")),
        "part_b": F.when(rejected, F.lit(version)).otherwise(F.col("part_b"))}).select(*columns, "kind", "part_a", "part_b")
    attempt, counts = C.new_attempt(version), Observation("split")
    C.stage(every.observe(counts, F.count_if(~rejected).alias("written"), F.count_if(rejected).alias("rejected")), root, attempt)
    result = Enriched(attempt, source.get["n"], counts.get["written"], counts.get["rejected"])
    if result.written + result.rejected != result.rows_in:
        raise RuntimeError(f"rows got lost or doubled: {result}")
    C.publish(spark, root, attempt, PUBLISHED_SCHEMA)
    return result
