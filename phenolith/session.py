"""Session for our own tests and bench, and the shared folder used to cut lineage."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("phenolith")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without the setting; it then gets a temporary folder, as in tests.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    current = sc.getCheckpointDir()
    if current:
        return current
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="phenolith-")
    sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there.

    Used where one result feeds several later branches that must see the same rows in the same
    partitions, or where computing it twice costs more than one write. The files outlive executors.
    """
    folder = shared_folder(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table that is written and read back."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For results that several branches read with different columns: each branch scans only its own.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that grows with the input: shuffled and sorted, never sent whole through the driver.

    Without the hint Catalyst judges a written table by its compressed files and an exploded one by its rows before that; both can be
    many times smaller than what a broadcast then brings to the driver.
    """
    return df.hint("merge")
