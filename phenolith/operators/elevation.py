"""Filling missing elevations from a lookup of nearly equal positions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.functions import columns as X

TOLERANCE_DEGREES = 1e-5


def fill_elevation(df: DataFrame, lookup: DataFrame, tolerance: float = TOLERANCE_DEGREES) -> DataFrame:
    """Take a missing elevation from the first lookup row at the same place; drop rows still without.

    ``lookup`` has ``position, latitude, longitude, elevation``; first means smallest position. Both sides
    are reduced to distinct coordinates before they meet, and cells of two tolerances make the match an equi-join.
    """
    size = 2 * tolerance
    cell = lambda c: F.floor(F.col(c) / size)
    wanted = df.where(F.col("elevation").isNull()).select("latitude", "longitude").distinct()
    known = lookup.groupBy(F.col("latitude").alias("lat2"), F.col("longitude").alias("lon2")).agg(
        F.min("position").alias("position"), F.min_by("elevation", "position").alias("found"))
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    known = (
        known.withColumn("dy", F.explode(around)).withColumn("dx", F.explode(around))
        .select("lat2", "lon2", "position", "found",
                (cell("lat2") + F.col("dy")).alias("cy"), (cell("lon2") + F.col("dx")).alias("cx")))
    near = X.is_close("latitude", "lat2", abs_tol=tolerance) & X.is_close("longitude", "lon2", abs_tol=tolerance)
    first = (
        wanted.withColumns({"cy": cell("latitude"), "cx": cell("longitude")})
        .join(known, ["cy", "cx"]).where(near)
        .groupBy("latitude", "longitude").agg(F.min_by("found", "position").alias("found")))
    # Only rows without an elevation are joined; the others pass as they are.
    kind = df.schema["elevation"].dataType
    filled = df.where(F.col("elevation").isNull()).drop("elevation").join(first, ["latitude", "longitude"])
    found = filled.withColumn("elevation", F.col("found").cast("long").cast(kind)).where(F.col("elevation").isNotNull())
    return df.where(F.col("elevation").isNotNull()).unionByName(found.select(*df.columns))
