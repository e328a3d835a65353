"""Counts and rates of decisions against the truth. Each is one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.functions.cleaning import ratio
from flowguard.functions.pvalues import chi2_p
from flowguard.taxonomy import TRAFFIC

METRICS = ("precision", "recall", "f1", "accuracy", "fpr", "fnr", "tp", "fp", "tn", "fn")


def confusion_counts(label: Column, pred: Column) -> list[Column]:
    y, p = label == 1, pred == 1
    return [F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
            F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp")]


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    return df.agg(*confusion_counts(F.col(label), F.col(pred)))


def binary_metrics(df: DataFrame, label: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1, accuracy, false rates and counts; a 0 denominator gives 0."""
    grouped = df.groupBy(*by) if by else df
    counts = grouped.agg(*confusion_counts(F.col(label), F.col(pred)))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(
        *(by or []),
        ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio(fp, fp + tn).alias("fpr"), ratio(fn, fn + tp).alias("fnr"),
        "tp", "fp", "tn", "fn")


def per_class_detection(df: DataFrame, pred: str, attack_type: str = "attack_type",
                        classes: tuple[str, ...] = TRAFFIC.attacks) -> DataFrame:
    """Detected, total and detection rate of each listed class; a class without rows has
    total 0 and a NULL rate. One aggregation of two counters per class, then unfolded."""
    c, p = F.col(attack_type), F.col(pred) == 1
    aggs = []
    for i, name in enumerate(classes):
        aggs += [F.count_if((c == name) & p).alias(f"d{i}"), F.count_if(c == name).alias(f"t{i}")]
    rows = F.array(*[
        F.struct(F.lit(name).alias("attack_type"), F.col(f"d{i}").alias("detected"),
                 F.col(f"t{i}").alias("total")) for i, name in enumerate(classes)])
    flat = df.agg(*aggs).select(F.inline(rows))
    rate = F.try_divide(F.col("detected").cast("double"), F.col("total").cast("double"))
    return flat.withColumn("detection_rate", rate)


def mcnemar(df: DataFrame, label: str, pred_a: str, pred_b: str) -> DataFrame:
    """Discordant counts, continuity-corrected statistic and p-value (0 and 1 when the two
    decisions are right on the same rows)."""
    a, b = F.col(pred_a) == F.col(label), F.col(pred_b) == F.col(label)
    n = df.agg(F.count_if(a & ~b).alias("discordant_a_only"),
               F.count_if(~a & b).alias("discordant_b_only"))
    n01, n10 = F.col("discordant_a_only"), F.col("discordant_b_only")
    gap = (F.abs(n01 - n10) - 1).cast("double")
    stat = n.withColumn("statistic", ratio(gap * gap, n01 + n10))
    p = F.when(n01 + n10 == 0, F.lit(1.0)).otherwise(chi2_p(F.col("statistic")))
    return stat.withColumn("p_value", p)


def cascade_summary(df: DataFrame, label: str, stage1: str, combined: str) -> DataFrame:
    """False positives before and after, their reduction in percent, and the share of rows
    the second stage has to look at."""
    y, a, b = F.col(label) == 1, F.col(stage1) == 1, F.col(combined) == 1
    n = df.agg(F.count_if(~y & a).alias("fp_stage1"), F.count_if(~y & b).alias("fp_combined"),
               F.count(F.lit(1)).alias("n_scored"), F.count_if(a).alias("n_flagged"),
               F.count_if(y == b).alias("_right"))
    fp1, fp2 = F.col("fp_stage1"), F.col("fp_combined")
    return n.select("fp_stage1", "fp_combined", "n_scored", "n_flagged",
                    (ratio(fp1 - fp2, fp1) * 100.0).alias("fp_reduction_pct"),
                    ratio(F.col("n_flagged"), F.col("n_scored")).alias("workload_fraction"),
                    ratio(F.col("_right"), F.col("n_scored")).alias("system_accuracy"))


def cluster_composition(df: DataFrame, cluster: str, attack_type: str,
                        classes: list[str] | None = None) -> DataFrame:
    """Rows and row fraction per cluster and listed class, zero-filled."""
    classes = classes or TRAFFIC.classes
    c = F.col(attack_type)
    counts = df.groupBy(F.col(cluster).alias("cluster")).agg(
        *[F.count_if(c == name).alias(f"_n{i}") for i, name in enumerate(classes)])
    total = sum((F.col(f"_n{i}") for i in range(1, len(classes))), F.col("_n0"))
    rows = F.array(*[
        F.struct(F.lit(name).alias("attack_type"), F.col(f"_n{i}").alias("n"),
                 ratio(F.col(f"_n{i}"), total).alias("fraction")) for i, name in enumerate(classes)])
    return counts.select("cluster", F.inline(rows))


def cluster_tendency(df: DataFrame, cluster: str, recon: str, overall_median: float) -> DataFrame:
    """Mean reconstruction error per cluster and whether it is above the overall median."""
    return (df.groupBy(F.col(cluster).alias("cluster"))
              .agg(F.count(F.lit(1)).alias("n"), F.avg(recon).alias("mean_recon_error"))
              .withColumn("anomaly_leaning", F.col("mean_recon_error") > overall_median))


def score_histogram(df: DataFrame, score: str, label: str = "Label", bins: int = 80) -> DataFrame:
    """Counts and densities of the scores of each truth class over equal bins between its own
    minimum and maximum; the maximum belongs to the last bin. A class that occurs has all its
    bins, empty ones with a zero."""
    y, s = F.col(label), F.col(score).cast("double")
    ends = df.agg(*[
        f(F.when(y == v, s)).alias(f"{n}{v}")
        for v in (0, 1) for n, f in (("lo", F.min), ("hi", F.max))]
        + [F.count_if((y == v) & s.isNotNull()).alias(f"n{v}") for v in (0, 1)])
    ends = ends.select(F.struct("*").alias("e")).scalar()

    def of_class(name: str) -> Column:
        return F.when(y == 1, ends[f"{name}1"]).otherwise(ends[f"{name}0"])

    flat = of_class("lo") == of_class("hi")
    low = F.when(flat, of_class("lo") - 0.5).otherwise(of_class("lo"))
    width = F.when(flat, F.lit(1.0)).otherwise(of_class("hi") - of_class("lo")) / bins
    scored = df.where(s.isNotNull() & y.isin(0, 1)).select(
        y.alias("Label"), F.least(F.floor((s - low) / width), F.lit(bins - 1)).cast("int").alias("bin"))
    counted = scored.groupBy("Label", "bin").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(2).select(F.col("id").cast(df.schema[label].dataType).alias(label)).select(
        y.alias("Label"), low.alias("_low"), width.alias("_width"), of_class("n").alias("_n")) \
        .where(F.col("_n") > 0).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    filled = every.join(counted, ["Label", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    return filled.select("Label", "bin", (F.col("_low") + F.col("bin") * F.col("_width")).alias("left_edge"),
                         "n", (F.col("n") / (F.col("_n") * F.col("_width"))).alias("density"))


def to_long(scope: str, stage: str, metrics: DataFrame) -> DataFrame:
    """A one-row table of numbers as rows (scope, stage, metric, value)."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in metrics.columns])
    return metrics.select(F.lit(scope).alias("scope"), F.lit(stage).alias("stage"), F.inline(pairs))
