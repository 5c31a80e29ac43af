"""Versions of categorised rows that appear whole or not at all.

An attempt to write a version has a folder of its own, ``<root>/attempt=<id>/kind=.../part_a=.../part_b=...``, and a table of its parts with their
row counts under ``<root>/_parts/<id>``. The attempt counts once that table is complete, which is the last thing written: a job that fails
in between leaves nothing that a reader sees, and of several complete attempts at a version only the latest counts.
"""

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenolith.sinks.writers import LAYOUT
from phenolith.sources.listings import children

PARTS_FOLDER, REJECTED = "_parts", "rejects"
_PARTS = "kind string, part_a string, part_b string, rows bigint"


def new_attempt(version: str) -> str:
    """An identifier that names its version and sorts by time."""
    if "~" in version or "/" in version:
        raise ValueError(f"unusable version {version}")
    return f"{version}~{time.time_ns():020d}~{uuid.uuid4().hex[:8]}"


def stage(df: DataFrame, root: str, attempt: str) -> str:
    """Write rows that have the columns of the layout to the attempt's folder; few files per part, a part with very many rows in several."""
    folder = f"{root}/attempt={attempt}"
    df.hint("rebalance", *LAYOUT).write.mode("overwrite").partitionBy(*LAYOUT).parquet(folder)
    return folder


def publish(spark, root: str, attempt: str, schema: T.StructType) -> None:
    """Count the parts of a staged attempt and make it the one that counts for its version."""
    staged = spark.read.schema(_with_layout(schema)).parquet(f"{root}/attempt={attempt}")
    staged.groupBy(*LAYOUT).agg(F.count("*").alias("rows")).write.mode("overwrite").parquet(f"{root}/{PARTS_FOLDER}/{attempt}")


def _with_layout(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in LAYOUT] + [T.StructField(c, T.StringType()) for c in LAYOUT])


def published(spark, root: str) -> dict[str, str]:
    """The attempt that counts, by version. A listing of one folder with an entry per attempt."""
    out: dict[str, str] = {}
    for attempt in children(spark, f"{root}/{PARTS_FOLDER}"):  # sorted: by version, then by time
        if "_SUCCESS" in children(spark, f"{root}/{PARTS_FOLDER}/{attempt}"):
            out[attempt.split("~")[0]] = attempt
    return out


def parts(spark, root: str) -> DataFrame:
    """``kind, part_a, part_b, rows, owner, version, attempt`` of every part of every published version."""
    out = None
    for version, attempt in published(spark, root).items():
        own = spark.read.schema(_PARTS).parquet(f"{root}/{PARTS_FOLDER}/{attempt}").withColumns({"version": F.lit(version), "attempt": F.lit(attempt)})
        out = own if out is None else out.unionByName(own)
    if out is None:
        out = spark.createDataFrame([], _PARTS + ", version string, attempt string")
    return out.withColumn("owner", F.when(F.col("kind") == "random", F.lit("")).otherwise(F.col("part_a")))


def newest_parts(parts: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """The parts of the newest version of every owner; all random parts have one owner, rejects none."""
    wanted = parts.where(F.col("kind").isin(kinds) if kinds else F.col("kind") != REJECTED)
    newest = wanted.groupBy("kind", "owner").agg(F.max("version").alias("version"))
    return wanted.join(newest, ["kind", "owner", "version"], "left_semi").select(*parts.columns)


def read_parts(spark, root: str, schema: T.StructType, chosen: DataFrame) -> DataFrame:
    """The rows of the chosen parts under a declared schema.

    Attempts without a chosen part are never opened: the others, at most one per version, are literals of the scan. Within them the
    join on the partition columns leaves out the parts that weren't chosen.
    """
    attempts = sorted(r["attempt"] for r in chosen.select("attempt").distinct().collect())
    full = T.StructType(_with_layout(schema).fields + [T.StructField("attempt", T.StringType())])
    if not attempts:
        return spark.createDataFrame([], full).drop("attempt")
    rows = spark.read.schema(full).option("basePath", root).parquet(*[f"{root}/attempt={a}" for a in attempts])
    return rows.where(F.col("attempt").isin(attempts)).join(chosen.select("attempt", *LAYOUT), ["attempt", *LAYOUT], "left_semi").drop("attempt")


def read_newest(spark, root: str, schema: T.StructType, kinds: list[str] | None = None) -> DataFrame:
    """Rows of the newest version of every owner, of all kinds unless some are named."""
    return read_parts(spark, root, schema, newest_parts(parts(spark, root), kinds))


def read_version(spark, root: str, schema: T.StructType, version: str, rejects: bool = False) -> DataFrame:
    """Rows of one published version, or its rejects."""
    own = parts(spark, root).where((F.col("version") == version) & ((F.col("kind") == REJECTED) == F.lit(rejects)))
    return read_parts(spark, root, schema, own)
