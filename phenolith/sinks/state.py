"""Persisting what was fitted, by version."""

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.operators.features import FittedTransform, fit_minmax, fit_vocabularies, fitted
from phenolith.sinks.writers import newest_version
from phenolith.sources.listings import children

# The three parts a saved state must have.
STATE_PARTS = ["raw_metadata", "transformed_metadata", "transform_fn"]
STATE_ROOT = "transformers"


def write_transform_state(raw: DataFrame, root: str, version: str | None = None) -> str:
    """Fit on ``raw`` and write schema, vocabulary and scaler under ``transformers/<version>``."""
    spark = raw.sparkSession
    path = f"{root}/{STATE_ROOT}/{version or str(int(time.time()))}"
    schema_text = spark.createDataFrame([(raw.schema.json(),)], "value string")
    schema_text.coalesce(1).write.mode("overwrite").text(f"{path}/raw_metadata")
    vocabulary = fit_vocabularies(raw)
    vocabulary.write.mode("overwrite").parquet(f"{path}/transform_fn/vocab")
    fit_minmax(raw).write.mode("overwrite").parquet(f"{path}/transform_fn/scaler")
    saved = spark.read.parquet(f"{path}/transform_fn/vocab")
    saved.groupBy("feature").agg(F.max("id").alias("max_id")).write.mode("overwrite").parquet(f"{path}/transformed_metadata")
    return path


def latest_transform_state(spark, root: str) -> str:
    """Path of the newest saved state; an error when one of its parts is missing."""
    version = newest_version(spark, root, STATE_ROOT)
    parts = children(spark, f"{root}/{version}")
    for part in STATE_PARTS:
        if part not in parts:
            raise ValueError(f"{version} has no {part}")
    return f"{root}/{version}"


def read_transform_state(spark, path: str) -> FittedTransform:
    return fitted(spark.read.parquet(f"{path}/transform_fn/vocab"), spark.read.parquet(f"{path}/transform_fn/scaler"))
