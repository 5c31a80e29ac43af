"""Choosing the newest version among listed files.

A listing is a table with ``path``; it can come from a folder, or from any table that names files.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenolith.functions.columns import _col


def list_files(spark, root: str) -> DataFrame:
    """Paths below a folder relative to it; the content column is never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    # The listing gives URIs such as file:/a/b; the root may have been given without a scheme.
    bare = root.split(":", 1)[-1].rstrip("/")
    return files.select(F.substring_index("path", bare + "/", -1).alias("path"))


def children(spark, folder: str) -> list[str]:
    """Names directly below a folder, without listing what lies deeper; none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []


def directory(path="path") -> Column:
    p = _col(path)
    return F.regexp_extract(p, "^(.*)/[^/]*$", 1)


def base_name(path="path") -> Column:
    return F.substring_index(_col(path), "/", -1)


def _entries(listing: DataFrame) -> DataFrame:
    split = listing.select("path", directory().alias("dir"), base_name().alias("name"))
    return split.where((F.col("dir") != "") & (F.col("name") != ""))


def latest_example_files(listing: DataFrame) -> DataFrame:
    """Newest file of every occurrence and protected-area folder, all files of the newest random folder."""
    files = _entries(listing)
    versioned = files.where(F.col("path").startswith("occurrences/") | F.col("path").startswith("protected_areas/"))
    newest = versioned.groupBy("dir").agg(F.max("name").alias("name"))
    random = files.where(F.col("path").startswith("random/"))
    folder = random.agg(F.max("dir").alias("dir")).select("dir")
    return newest.select("dir", "name").unionByName(
        random.join(folder, "dir", "left_semi").select("dir", "name")
    ).select(F.concat_ws("/", "dir", "name").alias("path"))


def latest_version(listing: DataFrame, parent: str) -> str:
    """Newest child below a parent path; an error when there is none."""
    parent = parent.strip("/")
    below = listing.where(F.col("path").startswith(parent + "/"))
    child = F.substring_index(F.substring("path", len(parent) + 2, 1 << 20), "/", 1)
    newest = below.agg(F.max(child).alias("child")).first()["child"]
    if newest is None:
        raise ValueError(f"no version below {parent}")
    return f"{parent}/{newest}"


def latest_per_parent(listing: DataFrame) -> DataFrame:
    """Newest child of every first-level folder: ``latest_version`` for all parents at once."""
    parts = F.split("path", "/")
    return listing.where(F.size(parts) > 1).groupBy(F.element_at(parts, 1).alias("parent")).agg(
        F.max(F.element_at(parts, 2)).alias("version"))


def latest_occurrence_file(listing: DataFrame, usage: str, exact: bool = True) -> DataFrame:
    """The path with the newest base name below ``occurrences/<usage>``.

    With ``exact=False`` the usage is a prefix, so a longer usage name matches too.
    """
    prefix = f"occurrences/{usage}" + ("/" if exact else "")
    return listing.where(F.col("path").startswith(prefix)).agg(
        F.max(F.struct(base_name().alias("name"), F.col("path"))).alias("m")
    ).where(F.col("m").isNotNull()).select("m.path")


def latest_occurrence_files(listing: DataFrame) -> DataFrame:
    """The newest file of every usage in one pass."""
    usage = F.try_element_at(F.split("path", "/"), F.lit(2))
    return listing.where(F.col("path").startswith("occurrences/")).groupBy(usage.alias("usage_id")).agg(
        F.max(F.struct(base_name().alias("name"), F.col("path"))).alias("m")
    ).select("usage_id", "m.path")


def latest_random_dir(listing: DataFrame, until_gap: bool = False) -> DataFrame:
    """Numbered files of the newest random version; ``until_gap`` leaves out those after the first missing number.

    The number equals its rank exactly until the first gap.
    """
    parts = F.split("path", "/")
    random = listing.where(F.col("path").startswith("random/") & (F.size(parts) == 3)).select(
        "path", F.element_at(parts, 2).alias("version"),
        F.element_at(F.split(F.element_at(parts, 3), "\\."), 1).try_cast("int").alias("file_no"))
    newest = random.agg(F.max("version").alias("version"))
    files = random.join(newest, "version", "left_semi").where(F.col("file_no") >= 1)
    if not until_gap:
        return files.select("version", "file_no", "path")
    rank = F.dense_rank().over(Window.partitionBy("version").orderBy("file_no"))  # one version, file names only
    return files.withColumn("_rank", rank).where(F.col("_rank") == F.col("file_no")).select("version", "file_no", "path")
