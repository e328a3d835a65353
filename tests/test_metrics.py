import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.functions.pvalues import beta_inc, chi2_tail, pearson_tail
from flowguard.models.classifier import class_weight, weighted
from flowguard.operators.correlation import detection_by_bucket, flow_length_corr, within_class_corr
from flowguard.operators.curves import auc_roc, pr_auc, pr_curve, roc_curve
from flowguard.operators.metrics import (binary_metrics, cascade_summary, cluster_composition, confusion_matrix,
                                         mcnemar, per_class_detection, score_histogram, to_long)
from flowguard.operators.thresholds import (alerts, best_f1_threshold, budget_threshold, cascade_threshold,
                                            contamination, fpr_threshold, tune_threshold)
from flowguard.plans.cascade import cascade_decision, supervised_only
from flowguard.sources.sinks import nested_report, write_metrics, write_report


def counted(spark, cells, columns):
    """Rows repeated by count: cells are (values..., count)."""
    df = spark.createDataFrame(cells, columns + ", n int")
    return df.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n", "i")


def test_recorded_metrics(spark):
    df = counted(spark, [(1, 1, 1529), (0, 1, 10908), (0, 0, 49093), (1, 0, 197)], "Label int, pred int")
    m = binary_metrics(df, "Label", "pred").first()
    assert (m["tp"], m["fp"], m["tn"], m["fn"]) == (1529, 10908, 49093, 197)
    assert m["precision"] == pytest.approx(0.12293961566294122, abs=1e-15)
    assert m["recall"] == pytest.approx(0.8858632676709154, abs=1e-15)
    assert m["f1"] == pytest.approx(0.2159147073360164, abs=1e-15)
    assert m["accuracy"] == pytest.approx(0.8200949341455117, abs=1e-15)
    assert m["fpr"] == pytest.approx(0.18179697005049916, abs=1e-15)
    assert m["fnr"] == pytest.approx(0.11413673232908458, abs=1e-15)


def test_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "Label int, pred int")
    m = binary_metrics(df, "Label", "pred").first()
    assert (m["precision"], m["recall"], m["f1"], m["fnr"], m["accuracy"]) == (0.0, 0.0, 0.0, 0.0, 1.0)
    assert tuple(confusion_matrix(df, "Label", "pred").first()) == (2, 0, 0, 0)
    empty = binary_metrics(df.limit(0), "Label", "pred").first()
    assert empty["accuracy"] == 0.0


def test_recorded_mcnemar(spark):
    df = counted(spark, [(1, 1, 0, 1), (0, 1, 0, 10898), (1, 1, 1, 5)], "Label int, a int, b int")
    m = mcnemar(df, "Label", "a", "b").first()
    assert (m["discordant_a_only"], m["discordant_b_only"]) == (1, 10898)
    assert m["statistic"] == pytest.approx(10893.000825763831, abs=1e-9) and m["p_value"] == 0.0


def test_mcnemar_without_discordant_rows(spark):
    m = mcnemar(spark.createDataFrame([(1, 1, 1)], "Label int, a int, b int"), "Label", "a", "b").first()
    assert (m["statistic"], m["p_value"]) == (0.0, 1.0)


def test_p_values():
    assert chi2_tail(3.841458820694124) == pytest.approx(0.05, abs=1e-12)
    assert beta_inc(0.5, 0.5, 0.5) == pytest.approx(0.5, abs=1e-12)
    assert beta_inc(2.0, 3.0, 0.4) == pytest.approx(0.5248, abs=1e-12)
    # t with one degree of freedom is Cauchy: r of three points.
    r = 0.6
    t = r / math.sqrt(1 - r * r)
    assert pearson_tail(r, 3) == pytest.approx(1 - 2 / math.pi * math.atan(t), abs=1e-12)
    assert pearson_tail(1.0, 10) == 0.0 and pearson_tail(0.0, 10) == pytest.approx(1.0)


def test_per_class_detection(spark):
    df = counted(spark, [("XSS", 1, 214), ("XSS", 0, 156), ("Benign", 1, 3)], "attack_type string, pred int")
    rows = {r["attack_type"]: r for r in per_class_detection(df, "pred", classes=("XSS", "DNS_Spoofing")).collect()}
    assert tuple(rows["XSS"]) == ("XSS", 214, 370, 0.5783783783783784)
    assert tuple(rows["DNS_Spoofing"]) == ("DNS_Spoofing", 0, 0, None)


def pairwise_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    y = (rng.random(2_000) < 0.2).astype(int)
    s = np.round(rng.normal(size=2_000) + y, 1)
    s[:700] = 0.5
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "Label int, score double")
    return y, s, df.repartition(5).persist()


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_auc_and_curves(scored, buckets):
    y, s, df = scored
    assert auc_roc(df, "Label", "score", buckets=buckets).first()[0] == pytest.approx(pairwise_auc(y, s), abs=1e-12)
    roc = sorted(tuple(r) for r in roc_curve(df, "Label", "score", buckets=buckets).collect())
    assert roc.pop() == (np.inf, 0.0, 0.0)
    pr = [tuple(r) for r in pr_curve(df, "Label", "score", buckets=buckets).collect()]
    assert [p for p in pr if p[0] is None] == [(None, 1.0, 0.0)]
    pr = sorted(p for p in pr if p[0] is not None)
    levels = np.unique(s)
    assert [r[0] for r in roc] == levels.tolist() == [r[0] for r in pr]
    for (t, fpr, tpr), (_, precision, recall) in zip(roc, pr):
        flagged = s >= t
        assert fpr == pytest.approx(flagged[y == 0].mean()) and tpr == pytest.approx(flagged[y == 1].mean())
        assert precision == pytest.approx(y[flagged].mean()) and recall == tpr
    points = [(0.0, 1.0)] + [(recall, precision) for _, precision, recall in sorted(pr, reverse=True)]
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points[:-1], points[1:]))
    assert pr_auc(df, "Label", "score", buckets=buckets).first()[0] == pytest.approx(area, abs=1e-12)


def test_auc_edge_cases(spark):
    one = spark.createDataFrame([(0, 1.0), (0, 2.0)], "Label int, score double")
    assert auc_roc(one, "Label", "score").first()[0] is None
    same = spark.createDataFrame([(0, 1.0), (1, 1.0)], "Label int, score double")
    assert auc_roc(same, "Label", "score").first()[0] == 0.5


def test_thresholds(spark, scored):
    y, s, df = scored
    assert budget_threshold(df, "score", 0.2) == pytest.approx(np.quantile(s, 0.8))
    benign = np.sort(s[y == 0])
    assert fpr_threshold(df, "score") == benign[int(0.95 * len(benign))]
    strict = fpr_threshold(df, "score", strict=True)
    assert (benign >= strict).mean() <= 0.05 < (benign >= fpr_threshold(df, "score")).mean()
    assert contamination(df) == 0.1 and contamination(df.where("Label = 0")) == 0.005


def test_recorded_fpr_overshoot(spark):
    df = spark.range(60_001).select(F.lit(0).alias("Label"), F.col("id").cast("double").alias("s"))
    assert alerts(df, "s", fpr_threshold(df, "s")).agg(F.sum("alert")).first()[0] == 3_001
    assert alerts(df, "s", fpr_threshold(df, "s", strict=True)).agg(F.sum("alert")).first()[0] == 3_000
    flat = df.withColumn("s", F.lit(1.0))
    assert alerts(flat, "s", fpr_threshold(flat, "s", strict=True)).agg(F.sum("alert")).first()[0] == 0


def test_tuned_threshold_takes_first_maximum(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.1), (0, 0.3)], "Label int, proba double")
    assert tuple(best_f1_threshold(df, "proba").first()) == (0.35, 1.0)
    assert tune_threshold(df.where("Label = 0"), "proba") == 0.05
    assert cascade_threshold(df, "proba", 0.35) == 0.35
    assert cascade_threshold(df, "proba", 0.95) == pytest.approx(0.805)
    assert cascade_threshold(df.where("Label = 0"), "proba", 0.4) == 0.4


def test_cascade_rules(spark):
    rows = [(1, True, 0.9, 1, 1), (1, True, 0.1, 0, 0), (1, False, None, 1, 0), (0, False, None, 0, 0), (0, True, 0.9, 0, 1)]
    df = spark.createDataFrame(rows, "alert int, have_flow boolean, proba double, want int, alone int")
    out = supervised_only(cascade_decision(df, 0.5), 0.5).collect()
    assert all(r["combined"] == r["want"] and r["supervised_only"] == r["alone"] for r in out)


def test_cascade_summary(spark):
    df = counted(spark, [(0, 1, 0, 10898), (0, 1, 1, 10), (1, 1, 1, 100), (0, 0, 0, 992)], "Label int, a int, b int")
    row = cascade_summary(df, "Label", "a", "b").first()
    assert row["fp_reduction_pct"] == pytest.approx(99.9083241657499)
    assert row["workload_fraction"] == pytest.approx(11_008 / 12_000)


def test_histogram(spark, scored):
    y, s, df = scored
    rows = score_histogram(df, "score", bins=80).collect()
    for label in (0, 1):
        want, edges = np.histogram(s[y == label], bins=80)
        density, _ = np.histogram(s[y == label], bins=80, density=True)
        mine = {r["bin"]: r for r in rows if r["Label"] == label}
        assert len(mine) == 80 and sum(r["n"] for r in mine.values()) == want.sum()
        assert mine[79]["n"] >= 1 and max(mine) == 79
        assert sum(r["density"] for r in mine.values()) == pytest.approx(density.sum())
    flat = score_histogram(df.withColumn("score", F.lit(2.0)), "score", bins=4).collect()
    assert {(r["bin"], r["left_edge"]) for r in flat if r["n"]} == {(2, 2.0)} and len(flat) == 8


def test_cluster_composition(spark):
    df = counted(spark, [(0, "a", 3), (0, "b", 1), (1, "b", 2)], "c int, k string")
    rows = {(r["cluster"], r["attack_type"]): (r["n"], r["fraction"]) for r in
            cluster_composition(df, "c", "k", ["a", "b", "z"]).collect()}
    assert rows[(0, "a")] == (3, 0.75) and rows[(1, "a")] == (0, 0.0) and rows[(1, "z")] == (0, 0.0)


def test_correlations(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(1, 500, 300)
    d = (rng.random(300) < 0.3 + x / 1_000).astype(int)
    kind = np.where(np.arange(300) < 290, "a", "b")
    df = spark.createDataFrame([(int(a), float(a) * 2, int(b), str(k)) for a, b, k in zip(x, d, kind)],
                               "p int, dur double, hit int, attack_type string")
    rows = {r["measure"]: r for r in flow_length_corr(df, "p", "dur", "hit").collect()}
    assert rows["log_packets"]["r"] == pytest.approx(np.corrcoef(np.log1p(x), d)[0, 1])
    assert rows["duration"]["r"] == pytest.approx(np.corrcoef(x, d)[0, 1]) and rows["duration"]["n"] == 300
    assert 0 < rows["duration"]["p"] < 0.01
    within = {r["attack_type"]: r for r in within_class_corr(df, "p", "hit").collect()}
    assert within["b"]["r"] is None and within["b"]["p"] is None and within["a"]["r"] is not None
    constant = flow_length_corr(df.withColumn("hit", F.lit(1)), "p", "dur", "hit").collect()
    assert all(r["r"] is None and r["p"] is None for r in constant)


def test_quartiles_merge_equal_edges(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (1, 0), (1, 1), (2, 1), (5, 0), (9, 1)], "v int, d int")
    rows = [tuple(r) for r in detection_by_bucket(df, "v", "d").orderBy("bucket").collect()]
    assert rows == [(0, 1.0, 3.5, 5, 0.6), (1, 3.5, 9.0, 2, 0.5)]
    single = detection_by_bucket(df.where("v = 1"), "v", "d").collect()
    assert [tuple(r) for r in single] == [(0, 1.0, 1.0, 4, 0.5)]


def test_weights(spark):
    df = counted(spark, [(0, 30), (1, 10)], "Label int")
    assert tuple(class_weight(df).first()) == (30, 10, 3.0)
    assert tuple(class_weight(df.where("Label = 0")).first()) == (30, 0, 30.0)
    balanced = {r[0]: r[1] for r in weighted(df, balanced=True).distinct().collect()}
    assert balanced == {0: pytest.approx(40 / 60), 1: 2.0}


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (0, 1)], "Label int, pred int")
    long = to_long("s", "metrics", binary_metrics(df, "Label", "pred"))
    assert {r["metric"]: r["value"] for r in long.collect()}["precision"] == 0.5
    write_metrics(long, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == long.count()
    write_report(long, str(tmp_path / "r"))
    assert '"precision":0.5' in spark.read.text(str(tmp_path / "r")).first()[0]
    assert nested_report(long).count() == 1
