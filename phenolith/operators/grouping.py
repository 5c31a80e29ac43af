"""Counts, extents and duplicates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.functions import columns as X
from phenolith.functions import geo


def group_extent(df: DataFrame, key: str) -> DataFrame:
    """Rows, bounding coordinates and date range per group; combined before the shuffle."""
    return df.groupBy(key).agg(
        F.count("*").alias("n"),
        F.min("latitude").alias("south"),
        F.max("latitude").alias("north"),
        F.min("longitude").alias("west"),
        F.max("longitude").alias("east"),
        F.min("obs_date").alias("earliest"),
        F.max("obs_date").alias("latest"),
    )


def geodesic_box(extents: DataFrame, extend_km: float = 0.0) -> DataFrame:
    """Replace bounding coordinates by the geodesic box around them.

    The radius is half the ellipsoidal distance between the south-west and north-east corners. The centre
    lies that far from the south-west corner at a bearing of 45 degrees; the edges lie the
    (extended) radius away from the centre in the four main directions.
    """
    others = [c for c in extents.columns if c not in ("south", "north", "west", "east")]
    half = extents.withColumn("_half", geo.ellipsoid_distance("south", "west", "north", "east") / 2)
    placed = half.withColumns({
        "_center": geo.ellipsoid_destination("south", "west", 45.0, "_half"),
        "radius_km": F.col("_half") + extend_km})
    edge = lambda bearing: geo.ellipsoid_destination("_center.lat", "_center.lon", bearing, "radius_km")
    return placed.select(
        *others, F.col("_center.lat").alias("center_lat"), F.col("_center.lon").alias("center_lon"), "radius_km",
        edge(0.0)["lat"].alias("box_north"), edge(180.0)["lat"].alias("box_south"),
        edge(90.0)["lon"].alias("box_east"), edge(270.0)["lon"].alias("box_west"))


def dedupe_location_date(df: DataFrame) -> DataFrame:
    """One row per category, position to four decimals and date: the one with the smallest id.

    An aggregation, not a ranking: copies are folded in each task before anything is shuffled.
    """
    first = df.groupBy(X.equality_key().alias("equality_key")).agg(
        F.min_by(F.struct(*df.columns), "example_id").alias("row"))
    return first.select("row.*")


def count_by(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def count_summary(df: DataFrame, key: str) -> DataFrame:
    """Total rows and distinct keys, from the counts per key."""
    return count_by(df, key).agg(F.sum("n").alias("total"), F.count("*").alias("distinct_keys"))


def count_per_file(df: DataFrame, file: str, pct: float) -> DataFrame:
    """Files, rows, whole rows per file and the eval quota per file."""
    totals = count_by(df, file).agg(F.count("*").alias("files"), F.sum("n").alias("total"))
    per_file = F.floor(F.col("total") / F.nullif("files", F.lit(0)))
    return totals.select(
        "files", "total", per_file.alias("per_file"),
        F.round(per_file * F.lit(pct)).cast("long").alias("eval_per_file"))


def first_id(df: DataFrame) -> DataFrame:
    return df.agg(F.min("example_id").alias("first_id"))
