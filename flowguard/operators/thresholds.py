"""Cut-offs chosen from scores. Each returns one number; only aggregates reach the driver."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.cleaning import ratio, reached
from flowguard.operators.quantiles import exact_quantiles, order_statistics
from flowguard.taxonomy import CONTAMINATION_BOUNDS, TARGET_CASCADE_RECALL, TARGET_FPR

# The cut-offs k / 20 as literals; stepping in floating point would miss 0.5.
F1_GRID = [k / 20 for k in range(1, 20)]


def alerts(df: DataFrame, score: str, threshold: float, out: str = "alert") -> DataFrame:
    """Add 1 where the score is at or above the threshold."""
    return df.withColumn(out, reached(F.col(score), F.lit(float(threshold))))


def budget_threshold(df: DataFrame, score: str, budget: float, **options) -> float:
    """The interpolated 1 - budget quantile: about that share of rows scores at or above it."""
    q = exact_quantiles(df, {"s": F.col(score)}, [1.0 - budget], **options)["s"][0]
    if q is None:
        raise ValueError("no scores")
    return q.value


def contamination(df: DataFrame, label: str = "Label") -> float:
    """Attack share of the training rows, held within fixed bounds."""
    share = df.agg(F.avg(label)).first()[0]
    low, high = CONTAMINATION_BOUNDS
    return min(max(share or 0.0, low), high)


def fpr_threshold(df: DataFrame, score: str, label: str = "Label", target: float = TARGET_FPR,
                  strict: bool = False, **options) -> float:
    """The benign score at place int((1 - target) * n).

    Alerting at or above it may pass the target by a row or by ties; ``strict`` takes the
    next benign score up instead, which cannot.
    """
    benign = F.when(F.col(label) == 0, F.col(score))
    found = order_statistics(df, {"s": benign},
                             lambda _, n: [min(int((1.0 - target) * n), n - 1)], **options)["s"]
    if not found:
        raise ValueError("no benign scores")
    cut = next(iter(found.values()))
    if not strict:
        return cut
    above = df.agg(F.min(F.when(benign > cut, benign))).first()[0]
    return above if above is not None else math.nextafter(cut, math.inf)


def f1_by_threshold(df: DataFrame, proba: str, label: str = "Label",
                    grid: list[float] | None = None) -> DataFrame:
    """Precision, recall and F1 at each cut-off, from one aggregation of counters."""
    grid = grid or F1_GRID
    y, p = F.col(label) == 1, F.col(proba)
    aggs = [F.count_if(y).alias("pos")]
    for i, t in enumerate(grid):
        aggs += [F.count_if(y & (p >= t)).alias(f"tp{i}"), F.count_if(~y & (p >= t)).alias(f"fp{i}")]
    rows = F.array(*[
        F.struct(F.lit(t).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"))
        for i, t in enumerate(grid)])
    flat = df.agg(*aggs).select("pos", F.inline(rows))
    tp, fp, pos = F.col("tp"), F.col("fp"), F.col("pos")
    return flat.select("threshold", "tp", "fp",
                       ratio(tp, tp + fp).alias("precision"), ratio(tp, pos).alias("recall"),
                       ratio(2 * tp, tp + fp + pos).alias("f1"))


def best_f1_threshold(df: DataFrame, proba: str, label: str = "Label",
                      grid: list[float] | None = None) -> DataFrame:
    """The cut-off with the largest F1, the lowest one on a tie, as one row."""
    table = f1_by_threshold(df, proba, label, grid)
    best = F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold"))).alias("b")
    return table.agg(best).select("b.threshold", "b.f1")


def tune_threshold(df: DataFrame, proba: str, label: str = "Label") -> float:
    return best_f1_threshold(df, proba, label).first()[0]


def cascade_threshold(df: DataFrame, proba: str, f1_threshold: float, label: str = "Label",
                      recall: float = TARGET_CASCADE_RECALL, **options) -> float:
    """The highest cut-off that still confirms the wanted share of validation attacks, and
    never above the F1 cut-off."""
    attack = F.when(F.col(label) == 1, F.col(proba))
    q = exact_quantiles(df, {"p": attack}, [1.0 - recall], **options)["p"][0]
    return f1_threshold if q is None else min(q.value, f1_threshold)
