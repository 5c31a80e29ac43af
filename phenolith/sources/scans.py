"""Reading occurrences, random points and areas by source or key range."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.operators.numbering import keyset_ranges
from phenolith.schema import KEY_RANGE_ROWS, RANDOM_CATEGORY


def scan_occurrences_by_source(occurrences: DataFrame, sources: DataFrame) -> DataFrame:
    """Occurrences of the requested sources, with the requesting usage as category.

    One join for all sources; an occurrence wanted by two usages comes out twice.
    """
    wanted = sources.select("usage_id", "source_type", "target_id")
    kept = [c for c in occurrences.columns if c != "category"]
    return occurrences.join(wanted, ["source_type", "target_id"]).select(
        *kept, F.col("usage_id").alias("category"))


def scan_key_range(df: DataFrame, start: int, end: int, key: str = "modified_at") -> DataFrame:
    """Rows with the key in ``[start, end)``; an end of 0 is open. The bounds reach the scan."""
    df = df.where(F.col(key) >= start)
    return df.where(F.col(key) < end) if end != 0 else df


def scan_random_range(random: DataFrame, start: int, end: int, key: str = "modified_at") -> DataFrame:
    return scan_key_range(random, start, end, key).withColumn("category", F.lit(RANDOM_CATEGORY))


def order_by_modified(df: DataFrame, key: str = "modified_at") -> DataFrame:
    """Rows by ranges of the paging key, sorted within each range."""
    return df.repartitionByRange(key).sortWithinPartitions(key)


def keyset_batches(df: DataFrame, key: str = "modified_at", rows: int = KEY_RANGE_ROWS) -> DataFrame:
    """The key ranges that a reader pages through, 250 rows each."""
    return keyset_ranges(df, key, rows)


def read_examples(spark, schema, *paths: str) -> DataFrame:
    """Enriched rows of some files under a declared schema; nothing is inferred."""
    return spark.read.schema(schema).parquet(*paths)


def read_daily_weather(spark, path: str, years: list[int]) -> DataFrame:
    """Readings of the needed years from a table partitioned by year."""
    return spark.read.parquet(path).where(F.col("year").cast("int").isin(years))
