"""Isolation forest with distributed sampling, building and scoring."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.models.base import ArrayModel, HasFeatures, HasSeed, as_array, feature_matrix
from flowguard.taxonomy import FOREST_TREES, SEED

SAMPLE_ROWS = 256
EULER_GAMMA = 0.5772156649015329


def average_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary search tree of n rows."""
    n = np.asarray(n, dtype="float64")
    big = np.maximum(n, 3.0)
    value = 2.0 * (np.log(big - 1.0) + EULER_GAMMA) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, value, np.where(n == 2, 1.0, 0.0))


class _ForestParams(HasFeatures, HasSeed):
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    sampleRows = Param(Params._dummy(), "sampleRows", "rows per tree", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "unique column that makes the row draw repeatable",
                  TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "score column", TypeConverters.toString)

    def _defaults(self) -> None:
        self._setDefault(featuresCol="features", trees=FOREST_TREES, sampleRows=SAMPLE_ROWS, idCol="",
                         seed=SEED, outputCol="isolation_score")


class IsolationForest(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Every tree is grown from its own sample of ``sampleRows`` rows (all rows of a smaller table).

    A row has a hash for every tree, and a tree takes the rows of the least hashes: exactly
    ``sampleRows``, none twice, and the same ones however the rows are partitioned. Only rows below a
    cut that leaves a few more are shuffled, trees x sampleRows x 1.5 or so whatever the table's size;
    should a tree get too few, which is next to impossible, the cut is doubled. Trees are built in
    parallel, one group per tree. Without ``idCol`` a row is known by its values, its partition and
    its number among equal rows of a batch; the forest then depends on the partitions, but not on a
    task that is run again.
    """

    @keyword_only
    def __init__(self, *, featuresCol="features", trees=FOREST_TREES, sampleRows=SAMPLE_ROWS, idCol="",
                 seed=SEED, outputCol="isolation_score"):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> IsolationForestModel:
        trees, rows, seed = (self.getOrDefault(p) for p in ("trees", "sampleRows", "seed"))
        n = df.count()
        if n == 0:
            raise ValueError("no rows to fit on")
        rows = min(rows, n)
        depth = max(1, math.ceil(math.log2(max(rows, 2))))
        # A fixed number of partitions: the sample is small but building is not, and adaptive
        # execution would merge it into one task.
        slots = min(trees, df.sparkSession.sparkContext.defaultParallelism)
        cut = (rows + 8 * math.sqrt(rows) + 16) / n
        while True:
            drawn = self._draw(df, cut, trees, seed).repartition(slots, "tree")
            built = drawn.groupBy("tree").applyInPandas(
                _tree_builder(rows, depth, seed), "tree int, n int, feature array<int>, cut array<double>, path array<double>")
            found = sorted(built.collect(), key=lambda r: r["tree"])
            if cut >= 1 or len(found) == trees and all(r["n"] == rows for r in found):
                break
            cut *= 2
        state = {"feature": np.array([r["feature"] for r in found], dtype="int32"),
                 "cut": np.array([r["cut"] for r in found]),
                 "path": np.array([r["path"] for r in found]),
                 "rows": np.array([rows])}
        return self._copyValues(IsolationForestModel(state))

    def _draw(self, df: DataFrame, cut: float, trees: int, seed: int) -> DataFrame:
        """Rows (tree, x, place): for each tree those whose hash is among the lowest ``cut`` of all
        hashes; ``place`` has the order of the hashes."""
        id_col = self.getOrDefault("idCol")
        x = as_array(self.getFeaturesCol())
        identity = F.xxhash64(F.col(id_col)) if id_col else F.xxhash64(x, F.spark_partition_id())
        limit = np.uint64(min(int(cut * 2.0 ** 64), (1 << 64) - 1))
        salts = _mixed(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(int(ODD) * (2 * seed + 1) % (1 << 64)))

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
                if not id_col:
                    ids = ids + _copy_number(ids) * ODD
                ids = _mixed(ids)
                for start in range(0, len(ids), 4096):
                    place = _mixed(ids[start:start + 4096, None] ^ salts)
                    row, tree = np.nonzero(place <= limit)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tree.astype(np.int32)), batch.column(0).take(pa.array(row + start)),
                         pa.array((place[row, tree] >> np.uint64(1)).astype(np.int64))], ["tree", "x", "_id"])

        return df.select(x.alias("x"), identity.alias("id")).mapInArrow(pick, "tree int, x array<double>, _id long")


ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _copy_number(ids: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for the copies of a number."""
    order = np.argsort(ids, kind="stable")
    fresh = np.append(True, ids[order][1:] != ids[order][:-1])[:len(ids)]
    place = np.arange(len(ids)) - np.maximum.accumulate(np.where(fresh, np.arange(len(ids)), 0))
    out = np.empty(len(ids), np.uint64)
    out[order] = place.astype(np.uint64)
    return out


class IsolationForestModel(ArrayModel, _ForestParams):
    """Adds 2^(-mean path / expected path): near 1 is isolated quickly, 0.5 is average."""

    def __init__(self, state: dict[str, np.ndarray] | None = None):
        super().__init__(state)
        self._defaults()

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.state)

        @F.arrow_udf("double")
        def isolation(x: pa.Array) -> pa.Array:
            return pa.array(forest_scores(shared.value, feature_matrix(x)))

        return df.withColumn(self.getOrDefault("outputCol"), isolation(as_array(self.getFeaturesCol())))


def forest_scores(state: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Walk all rows of a batch down each tree, one level at a time.

    Trees are full binary heaps: node i has the children 2i+1 and 2i+2, and a leaf reached
    early passes its rows on to the left, so every row takes the same number of steps.
    """
    n, width = x.shape
    flat, base = np.ascontiguousarray(x).ravel(), np.arange(n, dtype="int64") * width
    inner = state["feature"].shape[1]
    depth = int(math.log2(inner + 1))
    total = np.zeros(n)
    for feature, cut, path in zip(state["feature"], state["cut"], state["path"]):
        node = np.zeros(n, dtype="int64")
        for _ in range(depth):
            right = flat.take(base + feature.take(node)) >= cut.take(node)
            node = 2 * node + 1 + right
        total += path.take(node - inner)
    mean = total / len(state["path"])
    norm = float(average_path(state["rows"][0]))
    return np.power(2.0, -mean / norm) if norm > 0 else np.full(n, 0.5)


def _tree_builder(rows: int, depth: int, seed: int):
    inner = 2 ** depth - 1

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        group = group.nsmallest(rows, "_id", keep="first")
        x = np.stack(group["x"].to_numpy())
        rng = np.random.default_rng([seed, tree])
        feature, cut = np.zeros(inner, dtype="int32"), np.full(inner, np.inf)
        path = np.zeros(inner + 1)
        waiting = [(0, 0, np.arange(len(x)))]
        while waiting:
            node, level, members = waiting.pop()
            part = x[members]
            low, high = part.min(axis=0), part.max(axis=0)
            able = np.flatnonzero(high > low)
            if level == depth or len(members) <= 1 or not len(able):
                while node < inner:
                    node = 2 * node + 1
                path[node - inner] = level + average_path(len(members))
                continue
            f = rng.choice(able)
            # In (low, high], also after rounding: both sides get at least one row.
            at = max(high[f] - rng.random() * (high[f] - low[f]), np.nextafter(low[f], high[f]))
            feature[node], cut[node] = f, at
            goes_right = part[:, f] >= at
            waiting.append((2 * node + 1, level + 1, members[~goes_right]))
            waiting.append((2 * node + 2, level + 1, members[goes_right]))
        return pd.DataFrame({"tree": [tree], "n": [len(x)], "feature": [feature], "cut": [cut], "path": [path]})

    return build
