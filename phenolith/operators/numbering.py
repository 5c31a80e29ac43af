"""Numbering rows over a whole table without one task seeing all of them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenolith.functions.columns import _col
from phenolith.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within a partition in its low 33 bits


def number_rows(df: DataFrame, order: list[Column | str], name: str = "number", group: str | None = None) -> DataFrame:
    """Number rows 0.. in ``order``, over the table or within each value of ``group``.

    Range partitioning spreads the rows; a random last sort key lets it cut through copies of one
    key, so no value can fill a task by itself. The sorted rows are written once, after which partition and
    position are fixed, and a number is the position plus the count of rows in earlier partitions. The
    offsets have one row per partition and, with ``group``, one per partition and group in it. Null is a group like others.
    """
    keys = ([F.col(group)] if group else []) + [_col(o) for o in order]
    columns = df.columns
    salt = F.rand(17).alias("_salt")
    ranged = df.select(*columns, salt).repartitionByRange(*keys, "_salt").sortWithinPartitions(*keys, "_salt")
    fixed = cut_lineage(ranged.drop("_salt"))
    placed = fixed.withColumn("_id", F.monotonically_increasing_id()).withColumns({
        "_part": F.shiftright("_id", _ROW_BITS).cast("int"),
        "_row": F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
    })
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.join(F.broadcast(offsets), "_part").withColumn("_global", F.col("_row") + F.col("_offset"))
    if group is None:
        return numbered.select(*columns, F.col("_global").alias(name))
    # A group lies in some partitions in a row; rows look their group's start up by partition and group, so that a hot group stays cut.
    held = numbered.withColumn("_group", F.struct(F.col(group).alias("g")))  # in a struct null groups are equal
    pieces = held.groupBy("_part", "_group").agg(F.min("_global").alias("_first"))
    starts = pieces.groupBy("_group").agg(F.min("_first").alias("_start"))
    placed = pieces.join(starts, "_group").select("_part", "_group", "_start")
    return held.join(placed, ["_part", "_group"]).select(*columns, (F.col("_global") - F.col("_start")).alias(name))


def keyset_ranges(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Consecutive ``[start_key, end_key)`` ranges of ``rows`` rows in key order; the last end is 0.

    Works on the count per key, so copies of one key are one row. A key that fills several ranges starts
    only one.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    numbered = number_rows(counts, [key], "_pos")
    totals = running_totals(numbered, "_pos", ["_n"]).withColumnRenamed("_n_before", "_before")
    # Multiples of ``rows`` among the positions of a key: the first and the last range that it starts.
    lowest = F.floor((F.col("_before") + (rows - 1)) / rows)
    highest = F.floor((F.col("_before") + F.col("_n") - 1) / rows)
    begins = totals.select(F.col(key).alias("start_key"), lowest.alias("range_no"), highest.alias("_high"))
    begins = cut_lineage(begins.where(F.col("range_no") <= F.col("_high")))
    following = begins.select((F.col("range_no") - 1).alias("_high"), F.col("start_key").alias("end_key"))
    return begins.join(following, "_high", "left").select(
        "range_no", "start_key", F.coalesce("end_key", F.lit(0)).alias("end_key"))


def running_totals(numbered: DataFrame, position: str, amounts: list[str], block: int = 100_000) -> DataFrame:
    """Add ``<amount>_before``: the sum of each amount over all earlier positions, block by block.

    The blocks' own sums, one row per ``block`` positions, are added up in one task.
    """
    blocked = numbered.withColumn("_block", F.floor(F.col(position) / block))
    sums = blocked.groupBy("_block").agg(*[F.sum(a).alias(f"_s_{a}") for a in amounts])
    before_block = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_block", *[F.coalesce(F.sum(f"_s_{a}").over(before_block), F.lit(0)).alias(f"_o_{a}") for a in amounts])
    before_row = Window.partitionBy("_block").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    within = blocked.withColumns({f"_r_{a}": F.coalesce(F.sum(a).over(before_row), F.lit(0)) for a in amounts})
    joined = within.join(offsets, "_block")
    return joined.select(*numbered.columns, *[(F.col(f"_r_{a}") + F.col(f"_o_{a}")).alias(f"{a}_before") for a in amounts])


def in_batches(df: DataFrame, n: int, order: list[Column | str]) -> DataFrame:
    """Add the number of the consecutive chunk of ``n`` rows that a row falls in."""
    return number_rows(df, order, "_number").withColumn(
        "batch", F.floor(F.col("_number") / n)).drop("_number")


def truncate_per_group(df: DataFrame, group: str, total: int, order: list[str], strict: bool = False) -> DataFrame:
    """The first rows of each group: ``total + 1`` of them, or ``total`` when ``strict``.

    Up to the engine's threshold for group limits each task keeps that many rows of a group before the shuffle. Beyond it the
    rows are numbered by range partitions, which cut a hot group; both ways give the same rows.
    """
    keep = total + (0 if strict else 1)
    if keep > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        return number_rows(df, order, "_rank", group).where(F.col("_rank") < keep).drop("_rank")
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= keep).drop("_rank")


def shuffle_rows(df: DataFrame, order_key: Column) -> DataFrame:
    """Rows in an order that depends only on a hash key: spread by ranges of it, sorted within."""
    return (
        df.withColumn("_order", order_key).repartitionByRange("_order").sortWithinPartitions("_order").drop("_order")
    )


def diffuse(df: DataFrame, by: Column) -> DataFrame:
    """Redistribute rows by a derived value, content unchanged.

    The rebalance hint gives partitions of the advised size: a value with very many rows is cut.
    """
    return df.withColumn("_by", by).hint("rebalance", "_by").drop("_by")


def diffuse_by_month(df: DataFrame, day: str = "obs_date") -> DataFrame:
    return diffuse(df, F.month(day))


def diffuse_by_year(df: DataFrame, day: str = "obs_date") -> DataFrame:
    return diffuse(df, F.year(day))
