"""Parsing, transforming and scoring rows as files arrive.

Every step is the batch function itself: none keeps state, so they hold for an unbounded frame as they are.
"""

from pyspark.sql import DataFrame

from phenolith.operators import observations as O
from phenolith.operators.serving import load_pipeline
from phenolith.schema import DOCUMENT_SCHEMA, ENRICHED_SCHEMA
from phenolith.sinks.writers import write_by_category


def document_stream(spark, path: str, files_per_trigger: int = 100) -> DataFrame:
    """New documents of a folder of JSON lines."""
    return (
        spark.readStream.schema(DOCUMENT_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(path))


def observation_stream(documents: DataFrame) -> DataFrame:
    return O.valid_observations(O.parse_documents(documents)).select(*O.OBSERVATION_COLUMNS)


def start_category_sink(rows: DataFrame, root: str, checkpoint: str, version: str):
    """Append each micro-batch to the category layout; a replayed batch replaces its own folder."""
    def write(batch: DataFrame, number: int) -> None:
        write_by_category(batch, f"{root}/batch={number}", version)

    return (
        rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())


def enriched_stream(spark, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Enriched rows of a folder of Parquet files."""
    return spark.readStream.schema(ENRICHED_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def score_stream(rows: DataFrame, pipeline: str) -> DataFrame:
    """Rows with their score by a saved pipeline: the vocabulary is a static table that each micro-batch is joined with, everything else a column function."""
    return load_pipeline(pipeline).transform(rows).select("example_id", "score")


def start_score_sink(rows: DataFrame, root: str, checkpoint: str):
    """Write each micro-batch to a folder of its own number; a batch that is replayed after a failure replaces its folder, so no row is scored twice."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={number}")

    return (
        rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())


def read_scores(spark, root: str) -> DataFrame:
    return spark.read.parquet(root).select("example_id", "score")
