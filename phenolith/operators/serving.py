"""One saved pipeline from enriched rows to scores: what the transform has fitted, and the network."""

import io

import numpy as np
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.operators import features as FE
from phenolith.operators import models as M
from phenolith.operators import network as N
from phenolith.schema import SCALED_COLUMNS, VOCABULARY_COLUMNS, WEATHER_COLUMNS


class _Writer(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:  # noqa: N802  the name that the base class calls
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata=self.stage.metadata())
        self.stage.save_data(path)


class _Reader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind.load_data(self.sparkSession, path, metadata)
        stage._resetUid(metadata["uid"])
        return stage


class _Stage(Transformer, MLWritable, MLReadable):
    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class TransformStage(_Stage):
    """Enriched rows to rows with ``dense`` and ``ids``; columns that the transform doesn't read are kept."""

    def __init__(self, state: FE.FittedTransform):
        super().__init__()
        self.state = state

    def _transform(self, df: DataFrame) -> DataFrame:
        own = {*VOCABULARY_COLUMNS, *SCALED_COLUMNS, *WEATHER_COLUMNS, "s2_tokens", "dense", "ids", *FE.CHUNKED_FEATURES, "temp_difference"}
        keep = tuple(c for c in df.columns if c not in own)
        given = df if "category" in df.columns else df.withColumn("category", F.lit(None).cast("string"))
        ready = M.model_input(FE.apply_transform(given, self.state, keep=keep), self.state, label=False)
        return ready.select(*keep, "dense", "ids")

    def metadata(self) -> dict:
        return {"scaler": self.state.scaler, "sizes": self.state.sizes}

    def save_data(self, path: str) -> None:
        self.state.vocabulary.select("feature", "token", "n", "id").write.parquet(f"{path}/vocabulary")

    @classmethod
    def load_data(cls, spark, path: str, metadata: dict) -> "TransformStage":
        return cls(FE.FittedTransform(spark.read.parquet(f"{path}/vocabulary"), metadata["scaler"], metadata["sizes"]))


class NetworkStage(_Stage):
    """Adds ``score`` to rows with ``dense`` and ``ids``, which go; the optimiser is kept, so that a loaded network can be trained on."""

    def __init__(self, model: N.Trained):
        super().__init__()
        self.model = model

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("score", F.get(M.score_columns([self.model]), F.lit(0))).drop("dense", "ids")

    def metadata(self) -> dict:
        shape = self.model.network.shape
        return {"name": self.model.network.name, "dense": shape.dense, "tables": shape.tables, "hidden": shape.hidden, "step": self.model.state.step, "history": self.model.history}

    def save_data(self, path: str) -> None:
        state = self.model.state
        arrays = [self.model.mean, self.model.scale, *state.weights, *state.first, *state.second]
        rows = []
        for place, array in enumerate(arrays):
            buffer = io.BytesIO()
            np.save(buffer, array)
            rows.append((place, buffer.getvalue()))
        from pyspark.sql import SparkSession

        SparkSession.active().createDataFrame(rows, "place int, value binary").write.parquet(f"{path}/weights")

    @classmethod
    def load_data(cls, spark, path: str, metadata: dict) -> "NetworkStage":
        rows = spark.read.parquet(f"{path}/weights").orderBy("place").collect()  # the arrays of one network
        arrays = [np.load(io.BytesIO(bytes(r["value"]))) for r in rows]
        shape = N.Shape(metadata["dense"], tuple((n, w) for n, w in metadata["tables"]), tuple(metadata["hidden"]))
        k = len(shape.arrays())
        state = N.State(arrays[2 : 2 + k], arrays[2 + k : 2 + 2 * k], arrays[2 + 2 * k :], metadata["step"])
        return cls(N.Trained(N.Network(metadata["name"], shape), arrays[0], arrays[1], state, metadata["history"]))


def save_pipeline(state: FE.FittedTransform, model: N.Trained, root: str, usage: str, version: str) -> str:
    """Vocabulary, scaler and network as one pipeline under ``models/<usage>/<version>``, replacing one of the same version."""
    path = f"{root}/models/{usage}/{version}"
    PipelineModel([TransformStage(state), NetworkStage(model)]).write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
