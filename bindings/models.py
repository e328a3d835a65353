"""Detectors, classifiers, the cascade and the end-to-end jobs."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from bindings.base import (LINE_CLASSES, ORDER_CLASSES, PACKETS_SQL, SEGMENTS_SQL, UNIFY_OPTIONS, packets, query,
                           rounded, segments)
from bindings.flows import unified
from flowguard.functions.cleaning import reached
from flowguard.models.classifier import (boosted_trees, feature_importance, fit_classifier, get_threshold,
                                         random_forest, top_features)
from flowguard.models.detector import AnomalyDetector
from flowguard.models.iforest import IsolationForest
from flowguard.models.kmeans import NearestCentre
from flowguard.models.preprocess import Preprocessor
from flowguard.models.recon import Reconstruction
from flowguard.operators.joins import lookup_flows
from flowguard.operators.metrics import cascade_summary, confusion_counts, mcnemar
from flowguard.plans.cascade import cascade_decision, supervised_only
from flowguard.plans.jobs import (JobConfig, ablation, cascade_from_saved, flow_length_analysis, flow_sample,
                                  run_detection, split_flows, train_stage1, train_stage2, unified_flows)
from flowguard.session import shared_dir
from flowguard.sources.tables import read_table
from flowguard.streaming.operators import alert_share, run_cascade, stream_scores
from flowguard.streaming.runner import stream_table

FLOW_FEATURES = ["total_packets", "flow_duration", "pkt_len_mean", "flow_packets_per_s", "n_segments"]
PACKET_FEATURES = ["packet_length", "priority", "o_custkey"]


def job_config(**changes) -> JobConfig:
    """Jobs on orders (packets) and lineitem (segments), at the default settings; sample sizes
    shrink with the benign rows there are."""
    base = dict(taxonomy=ORDER_CLASSES, packet_features=PACKET_FEATURES, flow_features=FLOW_FEATURES,
                unify_options=UNIFY_OPTIONS)
    return JobConfig(**{**base, **changes})


def job_segments(spark, sf):
    """Segments with the packets' class names: N is benign O, A and R are the attacks."""
    name = F.col("attack_type")
    renamed = F.when(name == "N", "O").when(name == "A", "F").otherwise("P")
    return segments(spark, sf).withColumn("attack_type", renamed)


JOB_UNIFY = {**UNIFY_OPTIONS, "classes": ORDER_CLASSES.classes}


def vectors(spark, sf):
    t = read_table(spark, sf, "embeddings")
    return t.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def flow_vectors(spark, sf):
    t = unified(spark, sf).select("flow_id", "Label", "attack_type", *FLOW_FEATURES)
    return Preprocessor(inputCols=FLOW_FEATURES).fit(t.persist()).transform(t)


# -- stage 1 --------------------------------------------------------------------------------

@query("recon_error")
def _recon_error(spark, sf):
    v = vectors(spark, sf)
    return Reconstruction().fit(v).transform(v).select("vec_id", "recon_error")


@query("recon_error_mlp")
def _recon_error_mlp(spark, sf):
    v = vectors(spark, sf)
    return Reconstruction(method="mlp").fit(v).transform(v).select("vec_id", "recon_error")


@query("isolation_score")
def _isolation_score(spark, sf):
    v = vectors(spark, sf)
    return IsolationForest(idCol="vec_id").fit(v).transform(v).select("vec_id", "isolation_score")


@query("kmeans_distance")
def _kmeans_distance(spark, sf):
    v = vectors(spark, sf)
    return NearestCentre(idCol="vec_id").fit(v).transform(v).select("vec_id", "kmeans_distance")


@query("cluster_assignment")
def _cluster_assignment(spark, sf):
    v = vectors(spark, sf)
    return NearestCentre(idCol="vec_id").fit(v).transform(v).groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))


@query("kmeans_checks", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_not_nearest, CAST(0 AS BIGINT) AS n_far FROM embeddings")
def _kmeans_checks(spark, sf):
    """Rows whose cluster is not the nearest centre, or whose distance is not the one to it."""
    v = vectors(spark, sf)
    model = NearestCentre(idCol="vec_id").fit(v)
    centres = F.lit(model.state["centres"].tolist())
    x = vector_to_array("features")
    gaps = F.transform(centres, lambda c: F.sqrt(F.aggregate(F.zip_with(c, x, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)))
    t = model.transform(v).withColumn("gaps", gaps)
    own = F.get("gaps", F.col("cluster"))
    return t.agg(F.count(F.lit(1)).alias("n"), F.count_if(own > F.array_min("gaps") + 1e-9).alias("n_not_nearest"),
                 F.count_if(F.abs(own - F.col("kmeans_distance")) > 1e-6).alias("n_far"))


@query("isolation_checks", """SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_null, CAST(0 AS BIGINT) AS n_outside FROM embeddings""")
def _isolation_checks(spark, sf):
    """Scores of the isolation forest lie strictly between 0 and 1."""
    s = _isolation_score(spark, sf)
    c = F.col("isolation_score")
    return s.agg(F.count(F.lit(1)).alias("n"), F.count_if(c.isNull()).alias("n_null"),
                 F.count_if((c <= 0) | (c >= 1)).alias("n_outside"))


@query("recon_checks", """SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_negative, true AS below_mean FROM embeddings""")
def _recon_checks(spark, sf):
    """Reconstruction errors are not negative and on average below those of predicting the mean."""
    v = vectors(spark, sf)
    errors = Reconstruction().fit(v).transform(v)
    mean = v.select(F.posexplode(vector_to_array("features"))).groupBy("pos").agg(F.var_pop("col").alias("v")).agg(F.avg("v")).first()[0]
    return errors.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("recon_error") < 0).alias("n_negative"),
                      (F.avg("recon_error") < 1.0001 * mean).alias("below_mean"))


def _detected(spark, sf, **options):
    v = flow_vectors(spark, sf)
    model = AnomalyDetector(idCol="flow_id", **options).fit(v)
    return model, model.transform(v)


@query("anomaly_detector")
def _anomaly_detector(spark, sf):
    return _detected(spark, sf)[1].select("flow_id", "attack_type", "anomaly_score", "alert")


@query("component_scores")
def _component_scores(spark, sf):
    return _detected(spark, sf)[1].select(
        "flow_id", "recon_error", "isolation_score", "kmeans_distance", "cluster", "anomaly_score")


@query("forest_detector")
def _forest_detector(spark, sf):
    return _detected(spark, sf, components=["isolation"])[1].select("flow_id", "anomaly_score", "alert")


@query("cluster_anomaly")
def _cluster_anomaly(spark, sf):
    return _detected(spark, sf)[0].tendency(spark)


@query("model_roundtrip", "WITH " + SEGMENTS_SQL + "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_different FROM uni")
def _model_roundtrip(spark, sf):
    """Scores of a saved and loaded model against those of the fitted one."""
    t = unified(spark, sf).select("flow_id", *FLOW_FEATURES).persist()
    prep = Preprocessor(inputCols=FLOW_FEATURES).fit(t)
    detector = AnomalyDetector(idCol="flow_id").fit(prep.transform(t))
    fitted, path = PipelineModel([prep, detector]), shared_dir(spark, "model")
    fitted.write().save(path)
    a = fitted.transform(t).select("flow_id", "anomaly_score", "alert")
    b = PipelineModel.load(path).transform(t).select(
        "flow_id", F.col("anomaly_score").alias("score"), F.col("alert").alias("loaded_alert"))
    same = (F.col("anomaly_score") == F.col("score")) & (F.col("alert") == F.col("loaded_alert"))
    return a.join(b, "flow_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(~same).alias("n_different"))


# -- stage 2 --------------------------------------------------------------------------------

@query("supervised_flow")
def _supervised_flow(spark, sf):
    v = flow_vectors(spark, sf)
    return fit_classifier(v, boosted_trees()).transform(v).select("flow_id", "Label", "proba", "decision")


@query("forest_classifier")
def _forest_classifier(spark, sf):
    v = flow_vectors(spark, sf)
    model = fit_classifier(v, random_forest(), balanced=True)
    return model.transform(v).select("flow_id", "Label", "proba", "decision")


@query("feature_importance")
def _feature_importance(spark, sf):
    model = fit_classifier(flow_vectors(spark, sf), boosted_trees())
    return feature_importance(spark, model, FLOW_FEATURES)


@query("importance_checks", "SELECT CAST(5 AS BIGINT) AS n, CAST(1 AS DOUBLE) AS total, CAST(0 AS BIGINT) AS n_negative")
def _importance_checks(spark, sf):
    """Importances of all features, which add up to 1."""
    i = _feature_importance(spark, sf)
    return i.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("importance"), 6).alias("total"),
                 F.count_if(F.col("importance") < 0).alias("n_negative"))


@query("classifier_checks", "WITH " + SEGMENTS_SQL + """
SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_outside, sum("Label") AS n_attack FROM uni""")
def _classifier_checks(spark, sf):
    """Probabilities lie in [0, 1], and the confusion cells add up to the rows and attacks."""
    t = _supervised_flow(spark, sf)
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    cells = t.agg(*confusion_counts(F.col("Label"), F.col("decision")), F.count_if(~F.col("proba").between(0, 1)).alias("n_outside"))
    return cells.select((tp + fp + tn + fn).alias("n"), "n_outside", (tp + fn).alias("n_attack"))


@query("top_features")
def _top_features(spark, sf):
    model = fit_classifier(flow_vectors(spark, sf), boosted_trees())
    return top_features(feature_importance(spark, model, FLOW_FEATURES))


@query("ablation")
def _ablation(spark, sf):
    cfg = job_config(taxonomy=LINE_CLASSES)
    split = split_flows(flow_sample(unified(spark, sf), cfg), cfg).persist()
    return ablation(split, cfg)[1]


# -- cascade --------------------------------------------------------------------------------

def looked_up(spark, sf):
    """Packets with an alert on their price, and a flow probability from the flow's tax."""
    flows = unified(spark, sf).select("flow_id", (F.col("flow_packets_per_s") * 12.5).alias("proba"))
    flagged = packets(spark, sf).withColumn("alert", reached(F.col("packet_length"), F.lit(250_000.0)))
    return supervised_only(cascade_decision(lookup_flows(flagged, flows, spread_by="packet_id"), 0.55), 0.7)


CASCADE_SQL = "WITH " + PACKETS_SQL + "," + SEGMENTS_SQL + """,
j AS (SELECT p.packet_id, p."Label", CAST(p.packet_length >= 250000 AS INTEGER) AS alert,
             u.flow_id IS NOT NULL AS have_flow, u.flow_packets_per_s * 12.5 AS proba
      FROM pkt p LEFT JOIN uni u ON u.flow_id = p.flow_id),
d AS (SELECT packet_id, "Label", alert, have_flow,
             CAST(alert = 1 AND (NOT have_flow OR proba >= 0.55) AS INTEGER) AS combined,
             CAST(have_flow AND proba >= 0.7 AS INTEGER) AS supervised_only FROM j)
"""


@query("cascade_decision", CASCADE_SQL + "SELECT packet_id, alert, have_flow, combined FROM d")
def _cascade_decision(spark, sf):
    return looked_up(spark, sf).select("packet_id", "alert", "have_flow", "combined")


@query("supervised_only", CASCADE_SQL + "SELECT packet_id, supervised_only FROM d")
def _supervised_only(spark, sf):
    return looked_up(spark, sf).select("packet_id", "supervised_only")


@query("mcnemar", CASCADE_SQL + """,
n AS (SELECT count(*) FILTER (alert = "Label" AND combined <> "Label") AS a,
             count(*) FILTER (alert <> "Label" AND combined = "Label") AS b FROM d)
SELECT a AS discordant_a_only, b AS discordant_b_only,
       round(CASE WHEN a + b = 0 THEN 0 ELSE power(abs(a - b) - 1, 2) / (a + b) END, 6) + 0.0 AS statistic FROM n""")
def _mcnemar(spark, sf):
    m = mcnemar(looked_up(spark, sf), "Label", "alert", "combined")
    return m.select("discordant_a_only", "discordant_b_only", rounded("statistic").alias("statistic"))


@query("cascade_summary", CASCADE_SQL + """
SELECT count(*) FILTER ("Label" = 0 AND alert = 1) AS fp_stage1, count(*) FILTER ("Label" = 0 AND combined = 1) AS fp_combined,
       count(*) AS n_scored, count(*) FILTER (alert = 1) AS n_flagged,
       round(100 * (count(*) FILTER ("Label" = 0 AND alert = 1) - count(*) FILTER ("Label" = 0 AND combined = 1))
             / count(*) FILTER ("Label" = 0 AND alert = 1), 6) + 0.0 AS fp_reduction_pct,
       round(avg(alert), 9) AS workload_fraction,
       round(avg(CAST(combined = "Label" AS INTEGER)), 9) AS system_accuracy FROM d""")
def _cascade_summary(spark, sf):
    s = cascade_summary(looked_up(spark, sf), "Label", "alert", "combined")
    return s.withColumns({"fp_reduction_pct": rounded("fp_reduction_pct"),
                          "workload_fraction": F.round("workload_fraction", 9),
                          "system_accuracy": F.round("system_accuracy", 9)})


# -- jobs -----------------------------------------------------------------------------------

@query("detection_report")
def _detection_report(spark, sf):
    cfg = job_config(unify_options=JOB_UNIFY)
    return run_detection(packets(spark, sf), job_segments(spark, sf), cfg).metrics


@query("flow_length_analysis")
def _flow_length_analysis(spark, sf):
    cfg = job_config(unify_options=JOB_UNIFY)
    found = flow_length_analysis(job_segments(spark, sf), cfg)
    tables = (("correlation", found.correlations), ("within_class", found.within_class), ("quartile", found.by_quartile))
    a, b, c = (t.select(F.lit(name).alias("part"), "*") for name, t in tables)
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


@query("train_stage1")
def _train_stage1(spark, sf):
    return train_stage1(packets(spark, sf), job_config(), shared_dir(spark, "stage1")).metrics


@query("train_stage2")
def _train_stage2(spark, sf):
    cfg = job_config(unify_options=JOB_UNIFY)
    return train_stage2(job_segments(spark, sf), cfg, shared_dir(spark, "stage2")).metrics


def _saved_stages(spark, sf, cfg):
    first, second = shared_dir(spark, "stage1"), shared_dir(spark, "stage2")
    train_stage1(packets(spark, sf), cfg, first)
    train_stage2(job_segments(spark, sf), cfg, second)
    return first, second


@query("cascade_from_saved")
def _cascade_from_saved(spark, sf):
    cfg = job_config(unify_options=JOB_UNIFY)
    first, second = _saved_stages(spark, sf, cfg)
    decided = cascade_from_saved(packets(spark, sf), job_segments(spark, sf), first, second, cfg)
    return decided.select("flow_id", "alert", "have_flow", "proba", "combined")


# -- streaming jobs -------------------------------------------------------------------------

def _stream_decided(spark, sf):
    """Orders arriving as packets, scored by saved stages fitted on the same tables."""
    cfg = job_config(unify_options=JOB_UNIFY)
    first, second = _saved_stages(spark, sf, cfg)
    stage1, stage2 = PipelineModel.load(first), PipelineModel.load(second)
    # Written once: a micro-batch then joins a table and does not score the flows again.
    table = shared_dir(spark, "flow-proba")
    stage2.transform(unified_flows(job_segments(spark, sf), cfg)).select("flow_id", "proba").write.parquet(table)
    flow_proba = spark.read.parquet(table)
    raw = stream_table(spark, sf, "orders.parquet")
    arriving = raw.select(
        F.col("o_orderkey").alias("flow_id"), F.col("o_orderkey").alias("packet_id"), "o_custkey",
        F.col("o_totalprice").alias("packet_length"), F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"))
    scores = stream_scores(arriving, stage1, ["packet_id", "timestamp"])
    return run_cascade(scores, flow_proba, get_threshold(stage2), spread_by="packet_id")


@query("stream_cascade")
def _stream_cascade(spark, sf):
    return _stream_decided(spark, sf).select("packet_id", "alert", "have_flow", "combined")


@query("stream_alert_share")
def _stream_alert_share(spark, sf):
    return alert_share(_stream_decided(spark, sf), "timestamp", "30 days", 0.2)
