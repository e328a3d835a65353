"""Shared parts of the estimators: parameters, persistence of array state, Arrow helpers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import (DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class HasFeatures(Params):
    """The vector column a model reads."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)

    def getFeaturesCol(self) -> str:
        return self.getOrDefault("featuresCol")


class HasSeed(Params):
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)


def feature_matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix, without a copy per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def as_array(column: str) -> Column:
    return vector_to_array(F.col(column))


def feature_width(df: DataFrame, column: str) -> int:
    row = df.select(as_array(column).alias("v")).first()
    if row is None:
        raise ValueError("no rows to fit on")
    return len(row["v"])


def sum_arrays(parts: DataFrame, column: str) -> np.ndarray:
    """Sum of one array per partition, added up on the executors."""
    return parts.agg(Summarizer.sum(array_to_vector(F.col(column))).alias("t")).first()["t"].toArray()


class _ArrayWriter(MLWriter):
    def __init__(self, instance: ArrayModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        rows = [(name, list(a.shape), a.astype("float64").ravel().tolist(), str(a.dtype))
                for name, a in self.instance.state.items()]
        schema = "name string, shape array<int>, data array<double>, dtype string"
        self.sparkSession.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/arrays")


class _ArrayReader(MLReader):
    def __init__(self, cls: type[ArrayModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ArrayModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = self.sparkSession.read.parquet(f"{path}/arrays").collect()
        state = {r["name"]: np.array(r["data"]).reshape(r["shape"]).astype(r["dtype"]) for r in rows}
        model = self.cls(state)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class ArrayModel(Model, MLWritable, MLReadable):
    """A model whose fitted state is a few small named arrays, saved as a parquet table next
    to its parameters. Their size depends on the model's settings, not on the data."""

    def __init__(self, state: dict[str, np.ndarray] | None = None):
        super().__init__()
        self.state = state or {}

    def write(self) -> MLWriter:
        return _ArrayWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ArrayReader(cls)

