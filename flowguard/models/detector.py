"""The first stage: an unsupervised ensemble over feature vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.functions.cleaning import reached
from flowguard.models.base import ArrayModel, HasFeatures, HasSeed, as_array, feature_matrix
from flowguard.models.iforest import IsolationForest, forest_scores
from flowguard.models.kmeans import NearestCentre, nearest_centre
from flowguard.models.recon import Reconstruction, reconstruction_error
from flowguard.operators.quantiles import exact_quantiles
from flowguard.operators.thresholds import budget_threshold
from flowguard.taxonomy import (ALERT_BUDGET, AUTOENCODER_EPOCHS, AUTOENCODER_LAYERS, FOREST_TREES,
                                KMEANS_K, KMEANS_RESTARTS, SEED)

# Component -> score column.
SCORES = {"reconstruction": "recon_error", "isolation": "isolation_score", "kmeans": "kmeans_distance"}
Z_FLOOR = 1e-9


def z_scores(columns: dict[str, Column], mean: dict[str, Column], std: dict[str, Column]) -> Column:
    """Mean of the z-scored columns."""
    parts = [(c - mean[n]) / (std[n] + F.lit(Z_FLOOR)) for n, c in columns.items()]
    return sum(parts[1:], parts[0]) / len(parts)


def score_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mean ``m0..`` and population deviation ``s0..`` of each column."""
    return df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                  *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)])


def combined_score(df: DataFrame, columns: list[str], out: str = "anomaly_score",
                   mean: list[float] | None = None, std: list[float] | None = None) -> DataFrame:
    """Add the mean of the z-scored columns.

    With given (frozen) statistics this is a map and works on a stream. Without, they are
    taken from the table itself by one aggregate, used as a scalar subquery.
    """
    if mean is None or std is None:
        stats = score_stats(df, columns).select(F.struct("*").alias("s")).scalar()
        means = {c: stats[f"m{i}"] for i, c in enumerate(columns)}
        stds = {c: stats[f"s{i}"] for i, c in enumerate(columns)}
    else:
        means = {c: F.lit(float(m)) for c, m in zip(columns, mean)}
        stds = {c: F.lit(float(s)) for c, s in zip(columns, std)}
    return df.withColumn(out, z_scores({c: F.col(c) for c in columns}, means, stds))


class _DetectorParams(HasFeatures, HasSeed):
    components = Param(Params._dummy(), "components", "which scores to use", TypeConverters.toListString)
    reconMethod = Param(Params._dummy(), "reconMethod", "pca or mlp", TypeConverters.toString)
    layers = Param(Params._dummy(), "layers", "hidden layers of the mlp", TypeConverters.toListInt)
    epochs = Param(Params._dummy(), "epochs", "passes of the mlp", TypeConverters.toInt)
    trees = Param(Params._dummy(), "trees", "isolation trees", TypeConverters.toInt)
    k = Param(Params._dummy(), "k", "clusters", TypeConverters.toInt)
    restarts = Param(Params._dummy(), "restarts", "k-means seeds", TypeConverters.toInt)
    budget = Param(Params._dummy(), "budget", "share of training rows to flag", TypeConverters.toFloat)
    stats = Param(Params._dummy(), "stats", "z-score statistics: fit (frozen) or batch", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "unique column for a repeatable draw", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "combined score column", TypeConverters.toString)
    alertCol = Param(Params._dummy(), "alertCol", "decision column", TypeConverters.toString)

    def _defaults(self) -> None:
        self._setDefault(featuresCol="features", components=list(SCORES), reconMethod="pca",
                         layers=list(AUTOENCODER_LAYERS), epochs=AUTOENCODER_EPOCHS, trees=FOREST_TREES,
                         k=KMEANS_K, restarts=KMEANS_RESTARTS, budget=ALERT_BUDGET, stats="fit", idCol="",
                         seed=SEED, outputCol="anomaly_score", alertCol="alert")


class AnomalyDetector(Estimator, _DetectorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Reconstruction error, isolation and distance to the nearest centre, averaged as
    z-scores. Labels are not used. The feature column is cached for the fit; everything
    that reaches the driver is model state of fixed size.
    """

    @keyword_only
    def __init__(self, *, featuresCol="features", components=None, reconMethod="pca", layers=None,
                 epochs=AUTOENCODER_EPOCHS, trees=FOREST_TREES, k=KMEANS_K, restarts=KMEANS_RESTARTS,
                 budget=ALERT_BUDGET, stats="fit", idCol="", seed=SEED, outputCol="anomaly_score",
                 alertCol="alert"):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        unknown = set(self.getOrDefault("components")) - set(SCORES)
        if unknown:
            raise ValueError(f"unknown component(s) {sorted(unknown)}")

    def _fit(self, df: DataFrame) -> AnomalyDetectorModel:
        get = self.getOrDefault
        features, seed, use = get("featuresCol"), get("seed"), get("components")
        columns = [features] + ([get("idCol")] if get("idCol") else [])
        data = df.select(*columns).persist()
        state: dict[str, np.ndarray] = {}
        try:
            recon = None
            if "reconstruction" in use:
                recon = Reconstruction(featuresCol=features, method=get("reconMethod"), layers=get("layers"),
                                       components=get("layers")[len(get("layers")) // 2],
                                       epochs=get("epochs"), seed=seed, idCol=get("idCol")).fit(data)
                state.update({f"recon.{n}": a for n, a in recon.state.items()})
            if "isolation" in use:
                forest = IsolationForest(featuresCol=features, trees=get("trees"), idCol=get("idCol"),
                                         seed=seed).fit(data)
                state.update({f"forest.{n}": a for n, a in forest.state.items()})
            if "kmeans" in use:
                state["centres"] = self._fit_centres(data, recon)
            model = self._copyValues(AnomalyDetectorModel(state))
            model._fit_statistics(data)
        finally:
            data.unpersist()
        return model

    def _fit_centres(self, data: DataFrame, recon) -> np.ndarray:
        get = self.getOrDefault
        column = get("featuresCol")
        kmeans = NearestCentre(featuresCol=column, k=get("k"), restarts=get("restarts"), seed=get("seed"), idCol=get("idCol"))
        if recon is None:
            return kmeans.fit(data).state["centres"]
        assembler = VectorAssembler(inputCols=[column, "recon_error"], outputCol="_augmented")
        kmeans._set(featuresCol="_augmented")
        return kmeans.fit(assembler.transform(recon.transform(data))).state["centres"]


class AnomalyDetectorModel(ArrayModel, _DetectorParams):
    """Adds every component score, the cluster, the combined score and the alert.

    All components are computed in one Arrow pass over the feature column.
    """

    def __init__(self, state: dict[str, np.ndarray] | None = None):
        super().__init__(state)
        self._defaults()

    @property
    def threshold(self) -> float:
        return float(self.state["threshold"][0])

    @property
    def score_columns(self) -> list[str]:
        return [SCORES[c] for c in self.getOrDefault("components")]

    def component_scores(self, df: DataFrame) -> DataFrame:
        """Add the component scores and, with k-means, the cluster."""
        model = {k: v for k, v in self.state.items() if "." in k or k == "centres"}
        use = list(self.getOrDefault("components"))
        shared = df.sparkSession.sparkContext.broadcast(model)
        fields = [(SCORES[c], "double") for c in use] + ([("cluster", "int")] if "kmeans" in use else [])

        @F.arrow_udf("struct<" + ",".join(f"{n}:{t}" for n, t in fields) + ">")
        def scores(x: pa.Array) -> pa.Array:
            return _component_struct(shared.value, use, feature_matrix(x))

        scored = df.withColumn("_scores", scores(as_array(self.getFeaturesCol())))
        return scored.withColumns({n: F.col(f"_scores.{n}") for n, _ in fields}).drop("_scores")

    def with_score(self, scored: DataFrame) -> DataFrame:
        """Add the combined score to a table of component scores. A single component is
        used as it is."""
        columns, out = self.score_columns, self.getOrDefault("outputCol")
        if len(columns) == 1:
            return scored.withColumn(out, F.col(columns[0]))
        if self.getOrDefault("stats") == "batch":
            return combined_score(scored, columns, out)
        return combined_score(scored, columns, out, self.state["mean"].tolist(), self.state["std"].tolist())

    def _fit_statistics(self, data: DataFrame) -> None:
        """Freeze the z-score statistics, the threshold and the clusters' tendencies."""
        scored = self.component_scores(data).drop(self.getFeaturesCol()).persist()
        try:
            columns = self.score_columns
            row = score_stats(scored, columns).first()
            self.state["mean"] = np.array([row[f"m{i}"] for i in range(len(columns))])
            self.state["std"] = np.array([row[f"s{i}"] for i in range(len(columns))])
            combined, budget = self.with_score(scored), self.getOrDefault("budget")
            wanted = {c: F.col(c) for c in (self.getOrDefault("outputCol"), "recon_error") if c in combined.columns}
            found = exact_quantiles(combined, wanted, [0.5, 1.0 - budget])
            self.state["threshold"] = np.array([found[self.getOrDefault("outputCol")][1].value])
            if "cluster" in scored.columns and "recon_error" in scored.columns:
                k = len(self.state["centres"])
                means = scored.groupBy("cluster").agg(F.avg("recon_error").alias("m")).collect()
                tendency = np.full(k, np.nan)
                for r in means:
                    tendency[r["cluster"]] = r["m"]
                self.state["tendency"] = tendency
                self.state["recon_median"] = np.array([found["recon_error"][0].value])
        finally:
            scored.unpersist()

    def set_budget(self, scored: DataFrame, budget: float) -> float:
        """Put the threshold at the 1 - budget quantile of scored training rows."""
        self.state["threshold"] = np.array([budget_threshold(scored, self.getOrDefault("outputCol"), budget)])
        return self.threshold

    def tendency(self, spark) -> DataFrame:
        """Mean reconstruction error of each cluster on the training rows, and whether it is
        above the overall median."""
        rows = [(i, float(m), bool(m > self.state["recon_median"][0]))
                for i, m in enumerate(self.state["tendency"]) if m == m]
        return spark.createDataFrame(rows, "cluster int, mean_recon_error double, anomaly_leaning boolean")

    def _transform(self, df: DataFrame) -> DataFrame:
        scored = self.with_score(self.component_scores(df))
        return scored.withColumn(self.getOrDefault("alertCol"),
                                 reached(F.col(self.getOrDefault("outputCol")), F.lit(self.threshold)))


class KeepScore(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Drops the detector's working columns, so its score can be a feature of another model."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop("features", "alert", "cluster", *SCORES.values())


def _component_struct(model: dict[str, np.ndarray], use: list[str], x: np.ndarray) -> pa.Array:
    """Component scores of one batch of rows as a struct column."""
    def part(prefix: str) -> dict[str, np.ndarray]:
        return {k[len(prefix):]: v for k, v in model.items() if k.startswith(prefix)}

    columns: dict[str, np.ndarray] = {}
    if "reconstruction" in use:
        columns["recon_error"] = reconstruction_error(part("recon."), x)
    if "isolation" in use:
        columns["isolation_score"] = forest_scores(part("forest."), x)
    if "kmeans" in use:
        space = np.column_stack([x, columns["recon_error"]]) if "recon_error" in columns else x
        cluster, distance = nearest_centre(model["centres"], space)
        columns["kmeans_distance"], columns["cluster"] = distance, cluster.astype("int32")
    order = [SCORES[c] for c in use] + (["cluster"] if "kmeans" in use else [])
    return pa.StructArray.from_arrays([pa.array(columns[n]) for n in order], order)
