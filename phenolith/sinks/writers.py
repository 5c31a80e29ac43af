"""Writing enriched rows, splits and reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.functions import columns as X
from phenolith.sources.listings import children

LAYOUT = ["kind", "part_a", "part_b"]

# Folder names of the three kinds.
KIND_FOLDERS = {"random": "random", "protected_area": "protected_areas", "occurrence": "occurrences"}


def with_layout(df: DataFrame, version: str, category: str = "routing_category") -> DataFrame:
    """Add the three path parts of the category layout."""
    kind, ident = X.category_kind(category), X.category_id(category)
    folder = F.coalesce(*[F.when(kind == k, F.lit(f)) for k, f in KIND_FOLDERS.items()])
    return df.withColumns({
        "kind": folder,
        "part_a": F.when(kind == "random", F.lit(version)).when(kind == "protected_area", ident).otherwise(F.col(category)),
        "part_b": F.when(kind == "random", ident).otherwise(F.lit(version)),
    })


def _routed(df: DataFrame, version: str) -> DataFrame:
    """``df`` with the category that routes it and whether that names a folder."""
    routed = df.withColumn("routing_category", X.routing_category())
    usable = X.valid_category("routing_category") & X.category_path("routing_category", F.lit(version)).isNotNull()
    return routed.withColumn("routable", F.coalesce(usable, F.lit(False)))


def write_by_category(df: DataFrame, root: str, version: str) -> None:
    """One folder per category and version. Writing a version again replaces its folders, so a retried job doubles nothing.

    Rows that name no folder aren't written; ``unroutable`` gives them. Rebalancing on the path gives few files
    per folder and cuts a folder with very many rows in several.
    """
    laid = with_layout(_routed(df, version).where("routable"), version).drop("routing_category", "routable")
    laid.hint("rebalance", *LAYOUT).write.partitionBy(*LAYOUT).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


def unroutable(df: DataFrame, version: str) -> DataFrame:
    """The rows that ``write_by_category`` can't write: an unusable category or a random row without batch number."""
    return _routed(df, version).where(~F.col("routable")).select(*df.columns)


def read_by_category(spark, root: str) -> DataFrame:
    return spark.read.option("basePath", root).parquet(root)


def write_split(df: DataFrame, root: str) -> None:
    """Eval and train in gzip files, replacing an earlier split."""
    df.write.partitionBy("split").mode("overwrite").option("compression", "gzip").parquet(root)


def write_shuffled(df: DataFrame, root: str, seed) -> None:
    """Split parts in a random order of rows."""
    from phenolith.operators.numbering import shuffle_rows

    write_split(shuffle_rows(df, X.seeded_md5(seed)), root)


def write_experiment_tsv(report: DataFrame, path: str) -> None:
    report.write.option("sep", "\t").option("quote", "").mode("overwrite").csv(path)


def write_counts(df: DataFrame, path: str) -> None:
    """Row counts of the split parts as text."""
    df.groupBy("split").agg(F.count("*").alias("n")).write.mode("overwrite").csv(path)


def newest_version(spark, root: str, parent: str) -> str:
    """Newest child of a folder under a root, from a listing of that folder alone."""
    versions = children(spark, f"{root}/{parent}")
    if not versions:
        raise ValueError(f"no version below {parent}")
    return f"{parent}/{max(versions)}"
