from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from flowguard.models.classifier import get_threshold
from flowguard.plans.jobs import (JobConfig, cascade_from_saved, flow_length_analysis, packet_sample, part,
                                  run_detection, score_cascade, split_packets, train_stage1, train_stage2,
                                  unified_flows)
from flowguard.streaming.operators import alert_share, run_cascade, stream_scores
from flowguard.streaming.runner import stream_table
from flowguard.taxonomy import TRAFFIC


def value(metrics, scope, metric, stage="metrics"):
    return metrics.where(f"scope = '{scope}' AND stage = '{stage}' AND metric = '{metric}'").first()["value"]


@pytest.fixture(scope="module")
def tables(spark):
    """6,000 packets of 3,000 flows, 4 % attacks that are larger and faster; 5 % of the flows
    have no flow record."""
    kind = F.element_at(F.array(*[F.lit(c) for c in TRAFFIC.attacks]), (F.floor(F.col("n") / 25) % 5 + 1).cast("int"))
    flows = spark.range(0, 3_000, 1, 4).withColumn("n", F.col("id")).withColumn(
        "attack_type", F.when(F.col("id") % 25 == 0, kind).otherwise("Benign"))
    flows = flows.withColumn("Label", (F.col("attack_type") != "Benign").cast("int")).withColumn(
        "flow_id", F.concat(F.lit("f"), "id"))
    bump = F.col("Label") * 3
    packets = flows.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        (F.col("id") * 2 + F.col("copy")).alias("packet_id"), "flow_id", "Label", "attack_type",
        (F.randn(1) + bump).alias("packet_length"), (F.randn(2) - bump).alias("iat_ms"), F.randn(3).alias("ttl"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"))
    segments = flows.where("id % 20 <> 7").withColumn("segment_index", F.explode(F.sequence(F.lit(0), F.col("n") % 3))).select(
        "flow_id", "segment_index", "Label", "attack_type", (F.lit(10) + F.randn(4) + bump).alias("total_packets"),
        (F.lit(50) + F.randn(5) + bump).alias("flow_duration"), F.randn(6).alias("iat_mean"))
    return packets.persist(), segments.persist()


@pytest.fixture(scope="module")
def cfg():
    return JobConfig(n_benign=2_000, attack_min=60, attack_max=90, packet_features=["packet_length", "iat_ms", "ttl"],
                     flow_features=["total_packets", "flow_duration", "iat_mean", "n_segments"], classifier_trees=3,
                     forest_trees=20, restarts=1, unify_options={"classes": TRAFFIC.classes})


def test_presets():
    assert JobConfig.preset("demo").n_benign == 40_000 and JobConfig.preset("full", seed=3).attack_max == 6_200


def test_whole_run(tables, cfg):
    packets, segments = tables
    report = run_detection(packets, segments, cfg)
    m = report.metrics.persist()
    assert value(m, "packets", "n_total", "sample") == pytest.approx(2_075, abs=15)
    assert value(m, "flows", "n_unified_flows", "unified") == 2_850
    assert value(m, "stage1_only", "recall") > 0.6
    assert value(m, "two_stage", "fp") <= value(m, "stage1_only", "fp")
    assert report.decided.where("combined = 1 AND alert = 0").count() == 0
    assert report.decided.where("NOT have_flow AND combined <> alert").count() == 0
    assert report.decided.where("NOT have_flow").count() > 0
    assert {k: v.count() > 0 for k, v in report.figures.items()} == dict.fromkeys(report.figures, True)
    assert len(report.figures) == 8 and value(m, "comparison", "flow_beats_packet", "flow_vs_packet") in (0.0, 1.0)
    assert report.importance.count() >= 4 and report.cascade_model in ("with_flow_anomaly", "without_flow_anomaly")


def test_run_without_flow_anomaly(tables, cfg):
    packets, segments = tables
    report = run_detection(packets, segments, JobConfig(**{**cfg.__dict__, "flow_anomaly": False, "split_by_flow": True,
                                                           "algorithm": "forest", "components": ["isolation"]}))
    assert report.cascade_model == "without_flow_anomaly" and report.metrics.count() > 40


def test_flow_length(tables, cfg):
    out = flow_length_analysis(tables[1], cfg)
    assert out.correlations.count() == 2 and out.by_quartile.agg(F.sum("n")).first()[0] > 10


def test_queries_run_at_full_settings(spark):
    import inspect

    import __spark_entry__ as entry_points
    from bindings.models import job_config
    from flowguard.models.classifier import boosted_trees, random_forest
    cfg, full = job_config(), JobConfig()
    assert [getattr(cfg, c) == getattr(full, c) for c in ("classifier_trees", "forest_trees", "restarts")] == [True] * 3
    defaults = [{n: p.default for n, p in inspect.signature(f).parameters.items()} for f in (boosted_trees, random_forest)]
    assert defaults[0]["trees"] == full.classifier_trees == 400 and (defaults[1]["trees"], defaults[1]["depth"]) == (300, 30)
    found = entry_points.queries()["flow_length_analysis"](spark, "/root/testdata/sf0.01")
    assert {r.part: r.n_ for r in found.groupBy("part").agg(F.count("n").alias("n_")).collect()}.keys() == {
        "correlation", "within_class", "quartile"}


def test_saved_stages_and_stream(spark, tables, cfg, tmp_path):
    packets, segments = tables
    cfg = replace(cfg, classifier_trees=15)  # three trees do not separate the flows
    first, second = str(tmp_path / "s1"), str(tmp_path / "s2")
    one, two = train_stage1(packets, cfg, first), train_stage2(segments, cfg, second)
    assert value(one.metrics, "stage1", "auc_roc") > 0.8 and value(two.metrics, "stage2", "f1") > 0.8
    decided = cascade_from_saved(packets, segments, first, second, cfg, test_only=True).persist()
    assert cascade_from_saved(packets, segments, first, second, cfg).count() == packets.count()
    test = part(split_packets(packet_sample(packets, cfg), cfg), "test")
    assert decided.count() == test.count()

    stage1, stage2 = PipelineModel.load(first), PipelineModel.load(second)
    flows = unified_flows(segments, cfg)
    flagged = score_cascade(test, flows, stage1, stage2, flagged_only=True)
    assert flagged.count() == decided.where("alert = 1").count()

    folder = str(tmp_path / "in")
    test.repartition(3).write.parquet(folder)
    proba = stage2.transform(flows).select("flow_id", "proba")
    scores = stream_scores(stream_table(spark, folder, "*.parquet", files_per_trigger=1), stage1, ["packet_id", "ts"])
    streamed = run_cascade(scores, proba, get_threshold(stage2), spread_by="packet_id").persist()
    columns = ["flow_id", "alert", "have_flow", "combined"]
    assert sorted(streamed.select(columns).collect()) == sorted(decided.select(columns).collect())
    share = alert_share(streamed, "ts", "1 day", 0.2)
    assert share.agg(F.sum("n")).first()[0] == streamed.count()
