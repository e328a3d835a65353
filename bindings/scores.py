"""Metrics, curves, thresholds and the flow-length analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import (EVENT_CLASSES, EVENTS_SQL, LINE_CLASSES, SEGMENTS_SQL, UNIFY_OPTIONS, events, query,
                           rounded, segments)
from flowguard.functions.cleaning import reached
from flowguard.models.classifier import class_weight
from flowguard.models.detector import combined_score
from flowguard.operators.correlation import detection_by_bucket, flow_length_corr, within_class_corr
from flowguard.operators.curves import auc_roc, pr_auc, pr_curve, roc_curve
from flowguard.operators.flows import unify_flows
from flowguard.operators.metrics import (binary_metrics, cluster_composition, cluster_tendency,
                                         confusion_matrix, per_class_detection, score_histogram)
from flowguard.operators.quantiles import exact_quantiles
from flowguard.operators.sampling import sample_stats
from flowguard.operators.thresholds import (best_f1_threshold, budget_threshold, cascade_threshold,
                                            f1_by_threshold, fpr_threshold, tune_threshold)


def decided(spark, sf):
    """Events with a decision on value and a probability from k."""
    t = events(spark, sf)
    return t.withColumn("pred", reached(F.col("value"), F.lit(60.0))).withColumn("proba", F.col("k") / 100)


def one_number(spark, name: str, value: float):
    return spark.range(1).select(rounded(F.lit(float(value))).alias(name))


E = "WITH " + EVENTS_SQL + """,
d AS (SELECT *, CAST(value >= 60 AS INTEGER) AS pred, k / 100 AS proba FROM ev),
cm AS (SELECT count(*) FILTER ("Label" = 1 AND pred = 1) AS tp, count(*) FILTER ("Label" = 0 AND pred = 1) AS fp,
              count(*) FILTER ("Label" = 0 AND pred = 0) AS tn, count(*) FILTER ("Label" = 1 AND pred = 0) AS fn FROM d)
"""


@query("confusion_matrix", E + "SELECT tn, fp, fn, tp FROM cm")
def _confusion_matrix(spark, sf):
    return confusion_matrix(decided(spark, sf), "Label", "pred")


@query("binary_metrics", E + """
SELECT round(tp / (tp + fp), 9) AS "precision", round(tp / (tp + fn), 9) AS recall,
       round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 9) AS f1,
       round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, round(fp / (fp + tn), 9) AS fpr,
       round(fn / (fn + tp), 9) AS fnr, tp, fp, tn, fn FROM cm""")
def _binary_metrics(spark, sf):
    m = binary_metrics(decided(spark, sf), "Label", "pred")
    return m.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1", "accuracy", "fpr", "fnr")})


@query("per_attack_detection", E + """
SELECT c.attack_type, count(*) FILTER (d.pred = 1) AS detected, count(d.attack_type) AS total,
       round(count(*) FILTER (d.pred = 1) / nullif(count(d.attack_type), 0), 9) AS detection_rate
FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('scan')) c(attack_type)
LEFT JOIN d USING (attack_type) GROUP BY c.attack_type""")
def _per_attack_detection(spark, sf):
    rates = per_class_detection(decided(spark, sf), "pred", classes=(*EVENT_CLASSES.attacks, "scan"))
    return rates.withColumn("detection_rate", F.round("detection_rate", 9))


AUC_SQL = E + """,
g AS (SELECT value AS s, count(*) FILTER ("Label" = 1) AS p, count(*) FILTER ("Label" = 0) AS n FROM d GROUP BY 1),
r AS (SELECT s, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS np, sum(n) OVER () AS nn
      FROM g WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING))
"""


@query("auc_roc", AUC_SQL + "SELECT round(sum(p * ((nn - fp) + n / 2)) / (max(np) * max(nn)), 9) AS auc_roc FROM r")
def _auc_roc(spark, sf):
    return auc_roc(events(spark, sf), "Label", "value").select(F.round("auc_roc", 9).alias("auc_roc"))


@query("roc_curve", AUC_SQL + """
SELECT s + 0.0 AS threshold, round(fp / nn, 9) AS fpr, round(tp / np, 9) AS tpr FROM r
UNION ALL SELECT CAST('Infinity' AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE""")
def _roc_curve(spark, sf):
    c = roc_curve(events(spark, sf), "Label", "value")
    return c.select((F.col("threshold") + F.lit(0.0)).alias("threshold"),
                    F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


@query("pr_curve", AUC_SQL + """
SELECT s + 0.0 AS threshold, round(tp / (tp + fp), 9) AS "precision", round(tp / np, 9) AS recall FROM r
UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0::DOUBLE, 0.0::DOUBLE""")
def _pr_curve(spark, sf):
    c = pr_curve(events(spark, sf), "Label", "value")
    return c.select((F.col("threshold") + F.lit(0.0)).alias("threshold"),
                    F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@query("pr_auc", AUC_SQL + """,
pts AS (SELECT s, tp / (tp + fp) AS pr, tp / np AS re FROM r),
steps AS (SELECT pr, re, lag(pr, 1, 1.0) OVER (ORDER BY s DESC) AS pr0, lag(re, 1, 0.0) OVER (ORDER BY s DESC) AS re0
          FROM pts)
SELECT round(sum((re - re0) * (pr + pr0) / 2), 9) AS pr_auc FROM steps""")
def _pr_auc(spark, sf):
    return pr_auc(events(spark, sf), "Label", "value").select(F.round("pr_auc", 9).alias("pr_auc"))


F1_SQL = E + """,
grid AS (SELECT i / 20 AS threshold FROM range(1, 20) t(i)),
f AS (SELECT threshold, count(*) FILTER ("Label" = 1 AND proba >= threshold) AS tp,
             count(*) FILTER ("Label" = 0 AND proba >= threshold) AS fp, count(*) FILTER ("Label" = 1) AS pos
      FROM grid CROSS JOIN d GROUP BY threshold),
best AS (SELECT threshold, 2 * tp / (tp + fp + pos) AS f1 FROM f ORDER BY f1 DESC, threshold LIMIT 1)
"""


@query("f1_by_threshold", F1_SQL + "SELECT threshold, tp, fp, round(2 * tp / (tp + fp + pos), 9) AS f1 FROM f")
def _f1_by_threshold(spark, sf):
    return f1_by_threshold(decided(spark, sf), "proba").select("threshold", "tp", "fp", F.round("f1", 9).alias("f1"))


@query("tune_threshold", F1_SQL + "SELECT threshold, round(f1, 9) AS f1 FROM best")
def _tune_threshold(spark, sf):
    return best_f1_threshold(decided(spark, sf), "proba").select("threshold", F.round("f1", 9).alias("f1"))


@query("alert_budget_threshold", E + "SELECT round(quantile_cont(value, 0.8), 6) + 0.0 AS threshold FROM d")
def _alert_budget_threshold(spark, sf):
    return one_number(spark, "threshold", budget_threshold(events(spark, sf), "value", 0.2))


@query("fpr_threshold", E + """,
b AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS i, count(*) OVER () AS n FROM d WHERE "Label" = 0),
t AS (SELECT value AS threshold FROM b WHERE i = least(CAST(floor(0.95 * n) AS BIGINT), n - 1))
SELECT threshold + 0.0 AS threshold, (SELECT min(value) FROM b, t WHERE value > threshold) + 0.0 AS strict_threshold FROM t""")
def _fpr_threshold(spark, sf):
    t = events(spark, sf)
    loose, strict = fpr_threshold(t, "value"), fpr_threshold(t, "value", strict=True)
    return spark.range(1).select((F.lit(loose) + F.lit(0.0)).alias("threshold"),
                                 (F.lit(strict) + F.lit(0.0)).alias("strict_threshold"))


@query("cascade_threshold", F1_SQL + """
SELECT round(least((SELECT quantile_cont(proba, 0.05) FROM d WHERE "Label" = 1), (SELECT threshold FROM best)), 6) + 0.0
       AS threshold""")
def _cascade_threshold(spark, sf):
    t = decided(spark, sf)
    return one_number(spark, "threshold", cascade_threshold(t, "proba", tune_threshold(t, "proba")))


@query("score_histogram", E + """,
ends AS (SELECT "Label", min(value) AS lo, max(value) AS hi, count(*) AS total FROM d GROUP BY 1),
binned AS (SELECT d."Label", CAST(least(floor((value - lo) / ((hi - lo) / 80)), 79) AS INTEGER) AS bin, count(*) AS n
           FROM d JOIN ends ON ends."Label" = d."Label" GROUP BY 1, 2),
bins AS (SELECT "Label", lo, total, (hi - lo) / 80 AS w, CAST(i AS INTEGER) AS bin FROM ends, range(0, 80) t(i))
SELECT bins."Label", bins.bin, round(lo + bins.bin * w, 6) + 0.0 AS left_edge, coalesce(n, 0) AS n,
       round(coalesce(n, 0) / (total * w), 9) AS density
FROM bins LEFT JOIN binned ON binned."Label" = bins."Label" AND binned.bin = bins.bin""")
def _score_histogram(spark, sf):
    h = score_histogram(events(spark, sf), "value")
    return h.select("Label", "bin", rounded("left_edge").alias("left_edge"), "n", F.round("density", 9).alias("density"))


@query("cluster_composition", "WITH " + SEGMENTS_SQL + """
SELECT l_linenumber AS cluster, c.attack_type, count(*) FILTER (s.attack_type = c.attack_type) AS n,
       round(count(*) FILTER (s.attack_type = c.attack_type) / count(*), 9) AS fraction
FROM seg s CROSS JOIN (VALUES ('N'), ('A'), ('R')) c(attack_type) GROUP BY ALL""")
def _cluster_composition(spark, sf):
    out = cluster_composition(segments(spark, sf), "l_linenumber", "attack_type", LINE_CLASSES.classes)
    return out.withColumn("fraction", F.round("fraction", 9))


@query("cluster_tendency", "WITH " + SEGMENTS_SQL + """
SELECT l_linenumber AS cluster, count(*) AS n, round(avg(flow_duration), 4) AS mean_recon_error,
       avg(flow_duration) > (SELECT quantile_cont(flow_duration, 0.5) FROM seg) AS anomaly_leaning
FROM seg GROUP BY 1""")
def _cluster_tendency(spark, sf):
    t = segments(spark, sf)
    median = exact_quantiles(t, {"d": F.col("flow_duration")}, [0.5])["d"][0].value
    out = cluster_tendency(t, "l_linenumber", "flow_duration", median)
    return out.withColumn("mean_recon_error", F.round("mean_recon_error", 4))


@query("sample_stats", E + """
SELECT attack_type, count(*) AS n_total, CAST(sum("Label") AS BIGINT) AS n_attack, round(avg("Label"), 9) AS attack_ratio
FROM d GROUP BY GROUPING SETS ((attack_type), ())""")
def _sample_stats(spark, sf):
    return sample_stats(events(spark, sf)).withColumn("attack_ratio", F.round("attack_ratio", 9))


@query("class_weight", E + """
SELECT count(*) FILTER ("Label" = 0) AS negatives, count(*) FILTER ("Label" = 1) AS positives,
       round(count(*) FILTER ("Label" = 0) / greatest(1, count(*) FILTER ("Label" = 1)), 9) AS weight FROM d""")
def _class_weight(spark, sf):
    return class_weight(events(spark, sf)).withColumn("weight", F.round("weight", 9))


@query("combined_score", """
WITH z AS (
  SELECT event_id, (value - avg(value) OVER ()) / (stddev_pop(value) OVER () + 1e-9) AS z1,
         (u - avg(u) OVER ()) / (stddev_pop(u) OVER () + 1e-9) AS z2,
         (k - avg(k) OVER ()) / (stddev_pop(k) OVER () + 1e-9) AS z3
  FROM (SELECT event_id, value, CAST(user_id AS DOUBLE) AS u,
               TRY_CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS DOUBLE) AS k FROM events))
SELECT event_id, round((z1 + z2 + z3) / 3, 6) + 0.0 AS anomaly_score FROM z""")
def _combined_score(spark, sf):
    t = events(spark, sf).withColumn("u", F.col("user_id").cast("double"))
    scored = combined_score(t, ["value", "u", "k"])
    return scored.select("event_id", rounded("anomaly_score").alias("anomaly_score"))


# -- flow length ----------------------------------------------------------------------------

LENGTH_SQL = "WITH " + SEGMENTS_SQL + """,
atk AS (SELECT attack_type, total_packets, flow_packets_per_s AS duration, n_segments,
               CAST(pkt_len_max >= 80000 AS INTEGER) AS detected
        FROM uni JOIN (SELECT l_orderkey AS flow_id, max(l_extendedprice) AS pkt_len_max FROM lineitem GROUP BY 1)
             USING (flow_id) WHERE "Label" = 1)
"""


def attack_flows(spark, sf):
    t = segments(spark, sf).withColumn("pkt_len_max", F.col("flow_duration"))
    flows = unify_flows(t, taxonomy=LINE_CLASSES, **UNIFY_OPTIONS).where("Label = 1")
    return flows.select("attack_type", "total_packets", F.col("flow_packets_per_s").alias("duration"),
                        "n_segments", reached(F.col("pkt_len_max"), F.lit(80_000.0)).alias("detected"))


@query("flow_length_corr", LENGTH_SQL + """
SELECT 'log_packets' AS measure, round(corr(ln(1 + total_packets), detected), 6) + 0.0 AS r, count(*) AS n FROM atk
UNION ALL SELECT 'duration', round(corr(duration, detected), 6) + 0.0, count(*) FROM atk""")
def _flow_length_corr(spark, sf):
    out = flow_length_corr(attack_flows(spark, sf), "total_packets", "duration", "detected")
    return out.select("measure", rounded("r").alias("r"), "n")


@query("within_class_corr", LENGTH_SQL + """
SELECT attack_type, count(*) AS n,
       round(CASE WHEN count(*) >= 20 AND min(detected) < max(detected)
                  THEN corr(ln(1 + total_packets), detected) END, 6) + 0.0 AS r FROM atk GROUP BY attack_type""")
def _within_class_corr(spark, sf):
    out = within_class_corr(attack_flows(spark, sf), "total_packets", "detected")
    return out.select("attack_type", "n", rounded("r").alias("r"))


@query("detection_by_quartile", LENGTH_SQL + """,
e AS (SELECT quantile_cont(n_segments, 0) AS e0, quantile_cont(n_segments, 0.25) AS e1, quantile_cont(n_segments, 0.5) AS e2,
             quantile_cont(n_segments, 0.75) AS e3, quantile_cont(n_segments, 1) AS e4 FROM atk),
edges AS (SELECT DISTINCT unnest([e0, e1, e2, e3, e4]) AS edge FROM e),
bins AS (SELECT edge AS lo, lead(edge) OVER (ORDER BY edge) AS hi, row_number() OVER (ORDER BY edge) - 1 AS bucket FROM edges)
SELECT CAST(bucket AS INTEGER) AS bucket, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, count(*) AS n,
       round(avg(detected), 9) AS detection_rate
FROM atk JOIN bins ON n_segments <= hi AND (n_segments > lo OR (bucket = 0 AND n_segments >= lo))
GROUP BY ALL""")
def _detection_by_quartile(spark, sf):
    flows = attack_flows(spark, sf).select("n_segments", "detected").persist()
    out = detection_by_bucket(flows, "n_segments", "detected")
    return out.withColumn("detection_rate", F.round("detection_rate", 9))
