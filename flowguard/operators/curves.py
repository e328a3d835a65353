"""ROC, precision-recall and AUC, exact and without a global sort in one task.

Rows are first counted per distinct score, so a score shared by a third of the table is one
row. Distinct scores are then placed in range buckets whose edges come from a sketch of
them; running sums are taken inside each bucket and shifted by the totals of the buckets
before it. Only the bucket totals (``buckets`` rows) meet in one place.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.functions.cleaning import ratio


def score_counts(df: DataFrame, label: str, score: str, digits: int | None = None) -> DataFrame:
    """Positives and negatives per distinct score, optionally of rounded scores."""
    s = F.col(score).cast("double")
    if digits is not None:
        s = F.round(s, digits)
    y = F.col(label) == 1
    return (df.where(F.col(score).isNotNull()).groupBy(s.alias("score"))
              .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))


def running_counts(counts: DataFrame, buckets: int | None = None) -> DataFrame:
    """Add running ``tp`` and ``fp`` from the highest score down, this score included, and
    the totals ``n_pos`` and ``n_neg``."""
    buckets = buckets or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probs = [i / buckets for i in range(1, buckets)] or [0.5]
    step = math.isqrt(buckets) + 1
    # The test on the counters is always true; it keeps them in this branch, so that the
    # counting shuffle is the same in all branches and is run once.
    edges = (counts.where(F.col("pos") + F.col("neg") > 0)
             .agg(F.percentile_approx("score", probs, 100 * buckets).alias("fine"))
             .select(F.struct("fine", F.filter("fine", lambda _, i: (i + 1) % step == 0).alias("coarse")))
             .scalar())
    # Through a column of its own: a subquery may not stand inside a higher-order function.
    with_edges = counts.withColumn("edges", edges)
    # Edges below the score: first among every step-th edge, then among the few in between.
    first = F.size(F.filter("edges.coarse", lambda e: e < F.col("score"))) * step
    between = F.slice("edges.fine", F.col("first") + 1, F.lit(step - 1))
    placed = with_edges.withColumn("first", first).withColumn(
        "bucket", F.col("first") + F.size(F.filter(between, lambda e: e < F.col("score")))).drop("edges", "first")
    # At most `buckets` rows: their running totals may meet in one task, and be broadcast.
    totals = placed.groupBy("bucket").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy(F.lit(1))
    offsets = totals.select(
        "bucket",
        F.coalesce(F.sum("bp").over(above), F.lit(0)).alias("p0"),
        F.coalesce(F.sum("bn").over(above), F.lit(0)).alias("n0"),
        F.sum("bp").over(all_rows).alias("n_pos"), F.sum("bn").over(all_rows).alias("n_neg"))
    inside = (Window.partitionBy("bucket").orderBy(F.desc("score"))
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = placed.select("bucket", "score", "pos", "neg", F.sum("pos").over(inside).alias("tp"),
                          F.sum("neg").over(inside).alias("fp"))
    # A left join: an inner one would push a null test of the bucket down to the raw rows.
    return local.join(F.broadcast(offsets), "bucket", "left").select(
        "score", "pos", "neg", (F.col("tp") + F.col("p0")).alias("tp"),
        (F.col("fp") + F.col("n0")).alias("fp"), "n_pos", "n_neg", "bucket")


def auc_roc(df: DataFrame, label: str, score: str, **options) -> DataFrame:
    """Area under the ROC curve as one row: the share of (positive, negative) pairs in which
    the positive scores higher, ties counting half. NULL when one class is absent."""
    digits = options.pop("digits", None)
    running = running_counts(score_counts(df, label, score, digits), **options)
    # Positives at or above a negative's score rank over it; those at the same score half.
    wins = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") * 0.5))
    row = running.agg(wins.alias("wins"), F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return row.select(F.try_divide(F.col("wins"), pairs).alias("auc_roc"))


def roc_curve(df: DataFrame, label: str, score: str, **options) -> DataFrame:
    """False and true positive rate when alerting at or above each distinct score, and the
    point (0, 0) at an infinite threshold."""
    digits = options.pop("digits", None)
    r = running_counts(score_counts(df, label, score, digits), **options)
    points = r.select(F.col("score").alias("threshold"), ratio(F.col("fp"), F.col("n_neg")).alias("fpr"),
                      ratio(F.col("tp"), F.col("n_pos")).alias("tpr"))
    return points.unionByName(_point(df, threshold=float("inf"), fpr=0.0, tpr=0.0))


def pr_curve(df: DataFrame, label: str, score: str, **options) -> DataFrame:
    """Precision and recall when alerting at or above each distinct score, and the end point
    (recall 0, precision 1), which has no threshold."""
    digits = options.pop("digits", None)
    r = running_counts(score_counts(df, label, score, digits), **options)
    points = r.select(F.col("score").alias("threshold"),
                      ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                      ratio(F.col("tp"), F.col("n_pos")).alias("recall"))
    return points.unionByName(_point(df, threshold=None, precision=1.0, recall=0.0))


def _point(df: DataFrame, **values: float | None) -> DataFrame:
    return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(k) for k, v in values.items()])


def pr_auc(df: DataFrame, label: str, score: str, **options) -> DataFrame:
    """Trapezoid area under the precision-recall points, with the end point (recall 0,
    precision 1).

    The point before a score needs no look across buckets: its counts are this score's
    running counts less its own.
    """
    digits = options.pop("digits", None)
    r = running_counts(score_counts(df, label, score, digits), **options)
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    before_tp, before_n = tp - pos, tp - pos + fp - neg
    precision = ratio(tp, tp + fp)
    before = F.when(before_n == 0, F.lit(1.0)).otherwise(ratio(before_tp, before_n))
    area = F.sum(ratio(pos, F.col("n_pos")) * (precision + before) / 2)
    return r.agg(area.alias("pr_auc"))
