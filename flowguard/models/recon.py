"""Reconstruction error: PCA (one pass, repeatable) or a small neural network."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import PCA
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.models.base import ArrayModel, HasFeatures, HasSeed, as_array, feature_matrix, feature_width
from flowguard.models.together import Sums, fit_together
from flowguard.taxonomy import AUTOENCODER_EPOCHS, AUTOENCODER_LAYERS, SEED

#: Steps of an epoch at most: in every step the tasks wait for each other.
MAX_STEPS = 50
#: Rows that one task takes in a fit, and rows of a numpy pass.
ROWS_PER_TASK, PASS_ROWS = 20_000, 10_000


class _ReconParams(HasFeatures, HasSeed):
    method = Param(Params._dummy(), "method", "pca or mlp", TypeConverters.toString)
    components = Param(Params._dummy(), "components", "PCA components, below the width", TypeConverters.toInt)
    layers = Param(Params._dummy(), "layers", "hidden layer sizes", TypeConverters.toListInt)
    epochs = Param(Params._dummy(), "epochs", "passes over the data", TypeConverters.toInt)
    batchSize = Param(Params._dummy(), "batchSize", "rows per step", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "step size", TypeConverters.toFloat)
    idCol = Param(Params._dummy(), "idCol", "unique column that deals rows to batches", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "score column", TypeConverters.toString)

    def _defaults(self) -> None:
        self._setDefault(featuresCol="features", method="pca", components=AUTOENCODER_LAYERS[1],
                         layers=list(AUTOENCODER_LAYERS), epochs=AUTOENCODER_EPOCHS, batchSize=256,
                         stepSize=1e-3, seed=SEED, outputCol="recon_error", idCol="")


class Reconstruction(Estimator, _ReconParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a reconstruction of the feature vector through a bottleneck.

    ``pca`` keeps the leading components: one distributed pass, no randomness. ``mlp`` trains
    the dense network by Adam steps on common batches, as a single process would. A hash of
    ``idCol`` (of the values without one) deals the rows to batches, whose order changes with every
    epoch. A fit is one stage, whose tasks keep their rows in the order of the batches: in a step every
    task sends the sum of its gradients to the others, and all take the same step. The weights are the
    same however the table is partitioned. An epoch has ``MAX_STEPS`` steps at most, so on a large
    table batches are larger than ``batchSize``.
    """

    @keyword_only
    def __init__(self, *, featuresCol="features", method="pca", components=AUTOENCODER_LAYERS[1],
                 layers=None, epochs=AUTOENCODER_EPOCHS, batchSize=256, stepSize=1e-3, seed=SEED,
                 outputCol="recon_error", idCol=""):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> ReconstructionModel:
        fit = {"pca": self._fit_pca, "mlp": self._fit_mlp}[self.getOrDefault("method")]
        model = ReconstructionModel(fit(df))
        return self._copyValues(model)

    def _fit_pca(self, df: DataFrame) -> dict[str, np.ndarray]:
        column = self.getFeaturesCol()
        mean = df.agg(Summarizer.mean(F.col(column)).alias("m")).first()["m"]
        if mean is None:
            raise ValueError("no rows to fit on")
        k = max(1, min(self.getOrDefault("components"), len(mean) - 1))
        axes = PCA(k=k, inputCol=column, outputCol="_pca").fit(df).pc.toArray()
        return {"mean": mean.toArray(), "axes": axes}

    def _fit_mlp(self, df: DataFrame) -> dict[str, np.ndarray]:
        width = feature_width(df, self.getFeaturesCol())
        shapes = _layer_shapes(width, self.getOrDefault("layers"))
        weights = _initial_weights(shapes, self.getOrDefault("seed"))
        batch, rate, seed, id_col = (self.getOrDefault(p) for p in ("batchSize", "stepSize", "seed", "idCol"))
        x = as_array(self.getFeaturesCol()).alias("x")
        identity = F.xxhash64(F.col(id_col)) if id_col else F.xxhash64(as_array(self.getFeaturesCol()))
        n = df.count()
        steps = min(MAX_STEPS, -(-n // batch))
        dealt = df.select(x, identity.alias("id")).withColumn(
            "step", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(steps)).cast("int"))
        epochs = self.getOrDefault("epochs")
        weights = fit_together(dealt, n, ROWS_PER_TASK, lambda batches, sums: {
            "weights": _trained(batches, sums, weights, shapes, steps, epochs, rate, seed)})["weights"]
        flat = {}
        for i, (w, b) in enumerate(_unflatten(weights, shapes)):
            flat[f"w{i}"], flat[f"b{i}"] = w, b
        return flat


class ReconstructionModel(ArrayModel, _ReconParams):
    """Adds the mean squared reconstruction error over the features."""

    def __init__(self, state: dict[str, np.ndarray] | None = None):
        super().__init__(state)
        self._defaults()

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.state)

        @F.arrow_udf("double")
        def error(x: pa.Array) -> pa.Array:
            return pa.array(reconstruction_error(shared.value, feature_matrix(x)))

        return df.withColumn(self.getOrDefault("outputCol"), error(as_array(self.getFeaturesCol())))


def reconstruction_error(state: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Mean squared error of each row's reconstruction by fitted axes or layers."""
    if "axes" in state:
        centred = x - state["mean"]
        rebuilt = centred @ state["axes"] @ state["axes"].T
        return ((centred - rebuilt) ** 2).mean(axis=1)
    layers = [(state[f"w{i}"], state[f"b{i}"]) for i in range(len(state) // 2)]
    return ((x - _forward(x, layers)[-1]) ** 2).mean(axis=1)


# -- the dense network, per partition ------------------------------------------------------

def _layer_shapes(width: int, hidden: list[int]) -> list[tuple[int, int]]:
    sizes = [width, *hidden, width]
    return list(zip(sizes[:-1], sizes[1:]))


def _initial_weights(shapes: list[tuple[int, int]], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for n_in, n_out in shapes:
        bound = np.sqrt(6.0 / (n_in + n_out))
        parts += [rng.uniform(-bound, bound, n_in * n_out), np.zeros(n_out)]
    return np.concatenate(parts)


def _unflatten(weights: np.ndarray, shapes: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for n_in, n_out in shapes:
        w = weights[at:at + n_in * n_out].reshape(n_in, n_out)
        b = weights[at + n_in * n_out:at + n_in * n_out + n_out]
        out.append((w, b))
        at += n_in * n_out + n_out
    return out


def _forward(x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Activations of every layer: relu inside, linear at the end."""
    values = [x]
    for i, (w, b) in enumerate(layers):
        z = values[-1] @ w + b
        values.append(z if i == len(layers) - 1 else np.maximum(z, 0.0))
    return values


def _gradient(x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Gradient of half the mean squared error, in the order of the flat weights."""
    values = _forward(x, layers)
    delta = (values[-1] - x) / x.size
    parts = []
    for i in range(len(layers) - 1, -1, -1):
        w, _ = layers[i]
        parts.append(np.concatenate([(values[i].T @ delta).ravel(), delta.sum(axis=0)]))
        if i:
            delta = (delta @ w.T) * (values[i] > 0)
    return np.concatenate(parts[::-1])


def _trained(batches: Iterator[pa.RecordBatch], sums: Sums, weights: np.ndarray, shapes: list[tuple[int, int]], steps: int,
             epochs: int, rate: float, seed: int) -> np.ndarray:
    """The weights after Adam steps on batches whose gradients are added up over all tasks."""
    x, starts = _in_steps(batches, shapes[0][0], steps)
    first, second, taken = np.zeros_like(weights), np.zeros_like(weights), 0.0
    for epoch in range(epochs):
        for s in np.random.default_rng([seed, epoch]).permutation(steps).tolist():
            layers, total = _unflatten(weights, shapes), np.zeros(len(weights) + 1)
            for at in range(starts[s], starts[s + 1], PASS_ROWS):
                part = x[at:min(at + PASS_ROWS, starts[s + 1])].astype("float64", copy=False)
                total[:-1] += _gradient(part, layers) * part.size
                total[-1] += part.size
            total = sums(total)
            if not total[-1]:
                continue
            grad = total[:-1] / total[-1]
            taken += 1.0
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad * grad
            scale = np.sqrt(1.0 - 0.999 ** taken) / (1.0 - 0.9 ** taken)
            weights = weights - rate * scale * first / (np.sqrt(second) + 1e-8)
    return weights


def _in_steps(batches: Iterator[pa.RecordBatch], width: int, steps: int) -> tuple[np.ndarray, list[int]]:
    """A task's rows in the order of their steps, and where each step starts. Values that single precision holds exactly
    are kept in it."""
    parts, ids, at = [np.empty((0, width), "float32")], [np.empty(0, "int64")], [np.empty(0, "int32")]
    for b in batches:
        if b.num_rows:
            x = feature_matrix(b.column(0))
            with np.errstate(over="ignore"):
                single = x.astype("float32")
            parts.append(single if np.array_equal(single, x) else x)
            ids.append(b.column(1).to_numpy())
            at.append(b.column(2).to_numpy())
    step = np.concatenate(at)
    order = np.lexsort((np.concatenate(ids), step))
    return np.concatenate(parts)[order], np.searchsorted(step[order], np.arange(steps + 1)).tolist()
