"""Feature selection, cleaning, clipping, imputing and scaling with fit-once statistics."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.functions.cleaning import number
from flowguard.operators.quantiles import Quantile, exact_quantiles
from flowguard.taxonomy import CLIP_QUANTILES, ID_COLUMNS, LABEL_COLUMNS

PORT_COLUMNS = ("src_port", "dst_port")
TEXT_SHARE = 0.5


def select_features(df: DataFrame, drop: list[str]) -> list[str]:
    """Numeric columns, and text columns of which more than half reads as a number, less the
    dropped ones. Text columns cost one aggregation over all of them."""
    fields = [f for f in df.schema.fields if f.name not in drop]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    share = {}
    if texts:
        aggs = [F.avg(F.col(f"`{c}`").try_cast("double").isNotNull().cast("double")).alias(f"s{i}")
                for i, c in enumerate(texts)]
        row = df.agg(*aggs).first()
        share = {c: row[f"s{i}"] or 0.0 for i, c in enumerate(texts)}
    return [f.name for f in fields
            if isinstance(f.dataType, (T.NumericType, T.BooleanType)) or share.get(f.name, 0.0) > TEXT_SHARE]


def clipped(c: Column, lower: float | None, upper: float | None) -> Column:
    """Hold values within bounds; NULL stays NULL (``greatest``/``least`` would skip it)."""
    if lower is None or upper is None:
        return c
    return F.when(c.isNotNull(), F.greatest(F.lit(lower), F.least(F.lit(upper), c)))


class _PreprocessParams(Params):
    outputCol = Param(Params._dummy(), "outputCol", "vector column to write", TypeConverters.toString)
    clip = Param(Params._dummy(), "clip", "clip to robust quantiles before imputing", TypeConverters.toBoolean)
    clipQuantiles = Param(Params._dummy(), "clipQuantiles", "lower and upper quantile", TypeConverters.toListFloat)
    dropCols = Param(Params._dummy(), "dropCols", "columns that are no features", TypeConverters.toListString)
    inputCols = Param(Params._dummy(), "inputCols", "features; chosen from the schema when empty",
                      TypeConverters.toListString)

    def _defaults(self) -> None:
        self._setDefault(outputCol="features", clip=True, clipQuantiles=list(CLIP_QUANTILES),
                         dropCols=[*ID_COLUMNS, *LABEL_COLUMNS], inputCols=[])


class Preprocessor(Estimator, _PreprocessParams, DefaultParamsReadable, DefaultParamsWritable):
    """Clean -> clip -> impute the median -> standard-scale.

    Fitting takes the exact quantile search for all columns together and one pass for means
    and deviations. Clipping is monotone, so the median of the clipped values comes from the
    same order statistics and needs no search of its own. The deviation is the population
    form; a constant column is divided by 1. A column without any value is left out and
    named in ``dropped``.
    """

    @keyword_only
    def __init__(self, *, outputCol="features", clip=True, clipQuantiles=None, dropCols=None, inputCols=None):
        super().__init__()
        self._defaults()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**given)

    def _fit(self, df: DataFrame) -> PreprocessorModel:
        names = self.getOrDefault("inputCols") or select_features(df, self.getOrDefault("dropCols"))
        types = {f.name: f.dataType for f in df.schema.fields}
        if not names:
            raise ValueError("no feature columns")
        items = {c: number(c, types[c]) for c in names}
        clip = self.getOrDefault("clip")
        low_q, high_q = self.getOrDefault("clipQuantiles")
        found = exact_quantiles(df, items, [low_q, 0.5, high_q] if clip else [0.5])
        dropped = [c for c in names if found[c][0] is None]
        names = [c for c in names if c not in dropped]
        if not names:
            raise ValueError("every feature column is empty")

        lower, upper, median = [], [], []
        for c in names:
            low, mid, high = found[c] if clip else (None, found[c][0], None)
            lo, hi = (low.value, high.value) if clip else (float("-inf"), float("inf"))
            lower.append(float(lo))
            upper.append(float(hi))
            median.append(float(_clip_between(mid, lo, hi)))

        model = PreprocessorModel()
        self._copyValues(model)
        model._set(featureNames=names, dropped=dropped, lower=lower, upper=upper, median=median,
                   mean=[0.0] * len(names), scale=[1.0] * len(names))
        filled = model.imputed(df)
        stats = df.agg(*[F.avg(filled[c]).alias(f"m{i}") for i, c in enumerate(names)],
                       *[F.stddev_pop(filled[c]).alias(f"s{i}") for i, c in enumerate(names)]).first()
        model._set(mean=[float(stats[f"m{i}"]) for i in range(len(names))],
                   scale=[float(stats[f"s{i}"]) or 1.0 for i in range(len(names))])
        return model


def _clip_between(q: Quantile, lo: float, hi: float) -> float:
    """The quantile of the clipped values."""
    return Quantile(min(max(q.lower, lo), hi), min(max(q.upper, lo), hi), q.weight).value


class PreprocessorModel(Model, _PreprocessParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted preprocessing; applies to any table with the feature columns, batch or stream."""

    featureNames = Param(Params._dummy(), "featureNames", "features in vector order", TypeConverters.toListString)
    dropped = Param(Params._dummy(), "dropped", "features without any value", TypeConverters.toListString)
    lower = Param(Params._dummy(), "lower", "lower clip bounds", TypeConverters.toListFloat)
    upper = Param(Params._dummy(), "upper", "upper clip bounds", TypeConverters.toListFloat)
    median = Param(Params._dummy(), "median", "values for gaps", TypeConverters.toListFloat)
    mean = Param(Params._dummy(), "mean", "means after imputing", TypeConverters.toListFloat)
    scale = Param(Params._dummy(), "scale", "deviations after imputing", TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()
        self._defaults()

    @property
    def feature_names(self) -> list[str]:
        return list(self.getOrDefault("featureNames"))

    def _cleaned(self, df: DataFrame) -> dict[str, Column]:
        types = {f.name: f.dataType for f in df.schema.fields}
        missing = [c for c in self.feature_names if c not in types]
        if missing:
            raise ValueError(f"missing feature column(s) {missing}")
        return {c: number(c, types[c]) for c in self.feature_names}

    def clipped(self, df: DataFrame) -> dict[str, Column]:
        """Feature -> clipped column expression."""
        cleaned = self._cleaned(df)
        if not self.getOrDefault("clip"):
            return cleaned
        bounds = zip(self.feature_names, self.getOrDefault("lower"), self.getOrDefault("upper"))
        return {c: clipped(cleaned[c], lo, hi) for c, lo, hi in bounds}

    def imputed(self, df: DataFrame) -> dict[str, Column]:
        """Feature -> clipped and imputed column expression."""
        columns = self.clipped(df)
        return {c: F.coalesce(columns[c], F.lit(m))
                for c, m in zip(self.feature_names, self.getOrDefault("median"))}

    def scaled(self, df: DataFrame) -> dict[str, Column]:
        """Feature -> fully preprocessed column expression."""
        columns = self.imputed(df)
        stats = zip(self.feature_names, self.getOrDefault("mean"), self.getOrDefault("scale"))
        return {c: (columns[c] - F.lit(m)) / F.lit(s) for c, m, s in stats}

    def scaled_table(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """The kept columns and one named double per feature."""
        columns = self.scaled(df)
        return df.select(*keep, *[columns[c].alias(c) for c in self.feature_names])

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = self.scaled(df)
        vector = array_to_vector(F.array(*[columns[c] for c in self.feature_names]))
        return df.withColumn(self.getOrDefault("outputCol"), vector)
