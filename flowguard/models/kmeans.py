"""K-means with restarts and the distance to the nearest centre."""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.models.base import ArrayModel, HasFeatures, HasSeed, as_array, feature_matrix, sum_arrays
from flowguard.taxonomy import KMEANS_K, KMEANS_RESTARTS, SEED

log = logging.getLogger(__name__)

# Rounds in which points far from the centres so far are drawn as candidates for a start.
ROUNDS = 4
ODD = np.uint64(0x9E3779B97F4A7C15)


class _KMeansParams(HasFeatures, HasSeed):
    k = Param(Params._dummy(), "k", "number of clusters", TypeConverters.toInt)
    restarts = Param(Params._dummy(), "restarts", "starts from different seeds; the best is kept",
                     TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "passes over the data", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "squared movement of all centres that counts as settled, as a share of the mean variance", TypeConverters.toFloat)
    idCol = Param(Params._dummy(), "idCol", "unique column that rows draw by", TypeConverters.toString)
    clusterCol = Param(Params._dummy(), "clusterCol", "cluster column", TypeConverters.toString)
    distanceCol = Param(Params._dummy(), "distanceCol", "distance column", TypeConverters.toString)

    def _defaults(self) -> None:
        self._setDefault(featuresCol="features", k=KMEANS_K, restarts=KMEANS_RESTARTS, maxIter=300, tol=1e-4,
                         seed=SEED, clusterCol="cluster", distanceCol="kmeans_distance", idCol="")


class NearestCentre(Estimator, _KMeansParams, DefaultParamsReadable, DefaultParamsWritable):
    """The best of several k-means starts.

    ``ml.clustering.KMeans`` would read the data restarts x iterations times. Here all
    starts move together: one pass gives every partition's sums for all of them, which are
    added up to one vector. Starts come from all rows by distance-weighted oversampling in a
    few passes that all starts share. Equal rows are first brought together to one vector and
    its count, which weighs in every draw and sum; draws depend on a row's values, not on its
    place, so they are the same however the rows are partitioned. A start that has settled leaves later
    passes; one that has not after ``maxIter`` passes is reported in the log.
    """

    @keyword_only
    def __init__(self, *, featuresCol="features", k=KMEANS_K, restarts=KMEANS_RESTARTS, maxIter=300, tol=1e-4,
                 seed=SEED, clusterCol="cluster", distanceCol="kmeans_distance", idCol=""):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> NearestCentreModel:
        k, restarts, seed = (self.getOrDefault(p) for p in ("k", "restarts", "seed"))
        x, id_col = as_array(self.getFeaturesCol()).alias("x"), self.getOrDefault("idCol")
        if id_col:
            rows = df.select(x, F.lit(1.0).alias("n"), F.xxhash64(id_col).alias("id"))
        else:
            rows = df.groupBy(x).agg(F.count(F.lit(1)).cast("double").alias("n")).withColumn("id", F.xxhash64("x"))
        rows = rows.persist()
        try:
            n = rows.agg(F.sum("n")).first()[0]
            if not n:
                raise ValueError("no rows to fit on")
            starts = _starts(rows, k, max(1, restarts), seed)
            spread = _mean_variance(rows, n)
            centres = self._settle(rows, starts, self.getOrDefault("tol") * spread)
        finally:
            rows.unpersist()
        return self._copyValues(NearestCentreModel({"centres": centres}))

    def _settle(self, rows: DataFrame, starts: list[np.ndarray], tol: float) -> np.ndarray:
        """Move all starts until settled; the centres of the lowest cost (the first start on
        a tie)."""
        moving = dict(enumerate(starts))
        done: dict[int, tuple[float, np.ndarray]] = {}
        for last in [False] * self.getOrDefault("maxIter") + [True]:
            names = list(moving)
            results = _pass(rows, np.stack([moving[i] for i in names]))
            for i, (sums, counts, cost) in zip(names, results):
                moved, shift = _moved(moving[i], sums, counts)
                if last or shift <= tol:
                    if shift > tol:
                        log.warning("start %d has not settled: its centres still move by %g", i, shift)
                    done[i] = (cost, moving.pop(i))
                else:
                    moving[i] = moved
            if not moving:
                break
        return min(done.items(), key=lambda item: (item[1][0], item[0]))[1][1]


def _counted(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of a batch and the number of rows that are equal to each."""
    return feature_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)


def _draws(batch: pa.RecordBatch, seed: int, start: int, turn: int) -> np.ndarray:
    """A number in [0, 1) per row that depends on its id alone."""
    h = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64) + np.uint64(seed * int(ODD) % (1 << 64))
    for salt in (start + 1, turn + 1):
        h = (h ^ (h >> np.uint64(29))) * np.uint64((int(ODD) + 2 * salt) % (1 << 64))
        h ^= h >> np.uint64(32)
    return h.astype(np.float64) / 2.0 ** 64


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x ** 2).sum(axis=1)[:, None] - 2.0 * (x @ centres.T) + (centres ** 2).sum(axis=1), 0.0)


def _starts(rows: DataFrame, k: int, starts: int, seed: int) -> list[np.ndarray]:
    """Starting centres: for each start a first row, then rounds that take every row with a
    chance in proportion to its count and its squared distance from the candidates so far (about
    2 k a round), and at last k-means++ over the candidates, weighted by the rows nearest to each."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, n = _counted(batch)
                # The least of n draws, so every row has the same chance to be the first.
                u = [-np.expm1(np.log1p(-_draws(batch, seed, i, 0)) / n) for i in range(starts)]
                yield _rows_out(range(starts), [x[d.argmin()] for d in u], [d.min() for d in u])

    found = rows.mapInArrow(first, "s int, x array<double>, u double").groupBy("s").agg(F.min_by("x", "u").alias("x")).collect()
    chosen = {r["s"]: np.array([r["x"]]) for r in found}
    for turn in range(1, ROUNDS + 1):
        cost = _nearest_sums(rows, chosen, weights=False)

        def far(batches: Iterator[pa.RecordBatch], chosen=chosen, cost=cost, turn=turn) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, n = _counted(batch) if batch.num_rows else (np.zeros((0, 1)), np.zeros(0))
                for i in range(starts):
                    if len(x) and cost[i] > 0:
                        away = n * _squares(x, chosen[i]).min(axis=1)
                        picked = np.unique(x[_draws(batch, seed, i, turn) * cost[i] < 2 * k * away], axis=0)
                        yield _rows_out([i] * len(picked), picked, [0.0] * len(picked))

        for r in rows.mapInArrow(far, "s int, x array<double>, u double").select("s", "x").distinct().collect():
            chosen[r["s"]] = np.vstack([chosen[r["s"]], r["x"]])
        chosen = {i: np.unique(c, axis=0) for i, c in chosen.items()}
    sizes = np.split(_nearest_sums(rows, chosen, weights=True), np.cumsum([len(chosen[i]) for i in range(starts)])[:-1])
    return [_spread_centres(chosen[i], sizes[i], k, np.random.default_rng([seed, i])) for i in range(starts)]


def _rows_out(names, x, u) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(names), pa.int32()), pa.array([list(map(float, v)) for v in x], pa.list_(pa.float64())),
                                       pa.array([float(v) for v in u], pa.float64())], ["s", "x", "u"])


def _nearest_sums(rows: DataFrame, chosen: dict[int, np.ndarray], weights: bool) -> np.ndarray:
    """Per start the summed squared distance to the nearest candidate, or per candidate of each
    start the number of rows nearest to it."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x, n = _counted(batch)
                parts = []
                for i in range(len(chosen)):
                    squares = _squares(x, chosen[i])
                    parts.append(np.bincount(squares.argmin(axis=1), weights=n, minlength=len(chosen[i])) if weights
                                 else [n @ squares.min(axis=1)])
                part = np.concatenate(parts)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["part"])

    return sum_arrays(rows.mapInArrow(partial, "part array<double>"), "part")


def _mean_variance(rows: DataFrame, n: float) -> float:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, counts = _counted(batch)
                sums = np.concatenate([counts @ x, counts @ x ** 2]).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64()))], ["part"])

    mean, square = np.split(sum_arrays(rows.mapInArrow(partial, "part array<double>"), "part") / n, 2)
    return float(np.maximum(square - mean ** 2, 0.0).mean())


def _spread_centres(points: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ over weighted points: each next centre by weight times squared distance."""
    chosen = [points[rng.choice(len(points), p=weight / weight.sum())]]
    nearest = ((points - chosen[0]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        mass = nearest * weight
        pick = rng.choice(len(points), p=mass / mass.sum()) if mass.sum() > 0 else rng.integers(len(points))
        chosen.append(points[pick])
        nearest = np.minimum(nearest, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _moved(centres: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Means of the clusters (an empty one keeps its centre) and the squared movement of all."""
    moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1.0)[:, None], centres)
    return moved, float(((moved - centres) ** 2).sum())


def _pass(rows: DataFrame, centres: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Sums, counts and cost of every start (starts, k, width) from one pass."""
    starts, k, width = centres.shape
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, total = shared.value, None
        for batch in batches:
            if batch.num_rows:
                part = _partial_sums(common, *_counted(batch))
                total = part if total is None else total + part
        if total is not None:
            flat = pa.array([total.ravel().tolist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([flat], ["part"])

    parts = rows.mapInArrow(partial, "part array<double>")
    total = sum_arrays(parts, "part")
    shared.unpersist()
    table = total.reshape(starts, k, width + 2)
    return [(t[:, :width], t[:, width], float(t[:, width + 1].sum())) for t in table]


def _partial_sums(centres: np.ndarray, x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per start and cluster: sum of its rows, their number, their summed squared distance."""
    starts, k, width = centres.shape
    out = np.zeros((starts, k, width + 2))
    square = (x ** 2).sum(axis=1)
    for i, c in enumerate(centres):
        squares = np.maximum(square[:, None] - 2.0 * (x @ c.T) + (c ** 2).sum(axis=1), 0.0)
        cluster = squares.argmin(axis=1)
        member = np.zeros((len(x), k))
        member[np.arange(len(x)), cluster] = n
        out[i, :, :width] = member.T @ x
        out[i, :, width] = member.sum(axis=0)
        out[i, :, width + 1] = member.T @ squares[np.arange(len(x)), cluster]
    return out


class NearestCentreModel(ArrayModel, _KMeansParams):
    """Adds the nearest centre's number and the Euclidean distance to it."""

    def __init__(self, state: dict[str, np.ndarray] | None = None):
        super().__init__(state)
        self._defaults()

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.state["centres"])

        @F.arrow_udf("struct<cluster:int,distance:double>")
        def nearest(x: pa.Array) -> pa.Array:
            cluster, distance = nearest_centre(shared.value, feature_matrix(x))
            return pa.StructArray.from_arrays(
                [pa.array(cluster.astype("int32")), pa.array(distance)], ["cluster", "distance"])

        found = df.withColumn("_nearest", nearest(as_array(self.getFeaturesCol())))
        return (found.withColumn(self.getOrDefault("clusterCol"), F.col("_nearest.cluster"))
                     .withColumn(self.getOrDefault("distanceCol"), F.col("_nearest.distance"))
                     .drop("_nearest"))


def nearest_centre(centres: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    squares = np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)
    cluster = squares.argmin(axis=1)
    return cluster, np.sqrt(squares[np.arange(len(x)), cluster])
