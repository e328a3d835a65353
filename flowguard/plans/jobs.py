"""End-to-end jobs: train each stage, combine them, and report."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.models.classifier import (boosted_trees, feature_importance, fit_classifier, get_threshold,
                                         random_forest, set_threshold, top_features)
from flowguard.models.detector import AnomalyDetector, AnomalyDetectorModel, KeepScore
from flowguard.models.preprocess import PORT_COLUMNS, Preprocessor, PreprocessorModel
from flowguard.operators.correlation import detection_by_bucket, flow_length_corr, within_class_corr
from flowguard.operators.curves import auc_roc, pr_auc, pr_curve, roc_curve
from flowguard.operators.flows import segment_stats, unify_flows
from flowguard.operators.joins import flagged_lookup, lookup_flows, without_test_flows
from flowguard.operators.metrics import (binary_metrics, cascade_summary, cluster_composition, mcnemar,
                                         per_class_detection, score_histogram, to_long)
from flowguard.operators.sampling import imbalanced_sample, split_by_key, stratified_split
from flowguard.operators.thresholds import (alerts, cascade_threshold, contamination, fpr_threshold,
                                            tune_threshold)
from flowguard.plans.cascade import cascade_decision, supervised_only
from flowguard.taxonomy import (ALERT_BUDGET, ATTACK_MAX, ATTACK_MIN, ID_COLUMNS, LABEL_COLUMNS, N_BENIGN,
                                PRESETS, SEED, TARGET_CASCADE_RECALL, TARGET_FPR, TEST_FRACTION, TRAFFIC,
                                Taxonomy)


@dataclass
class JobConfig:
    """Settings of the jobs. Tables carry ``flow_id``, ``Label`` and ``attack_type``;
    packets also carry the unique ``packet_id``."""

    taxonomy: Taxonomy = TRAFFIC
    packet_id: str = "packet_id"
    seed: int = SEED
    n_benign: int = N_BENIGN
    attack_min: int = ATTACK_MIN
    attack_max: int = ATTACK_MAX
    alert_budget: float = ALERT_BUDGET
    target_fpr: float = TARGET_FPR
    cascade_recall: float = TARGET_CASCADE_RECALL
    packet_features: list[str] = field(default_factory=list)
    flow_features: list[str] = field(default_factory=list)
    drop_ports: bool = False
    split_by_flow: bool = False
    algorithm: str = "boosted"
    classifier_trees: int = 400
    forest_trees: int = 200
    restarts: int = 10
    recon_method: str = "pca"
    components: list[str] | None = None
    stats: str = "fit"
    flow_anomaly: bool = True
    unify_options: dict = field(default_factory=dict)

    @classmethod
    def preset(cls, name: str, **changes) -> JobConfig:
        return cls(**{**PRESETS[name], **changes})

    def preprocessor(self, features: list[str], id_col: str) -> Preprocessor:
        drop = [*ID_COLUMNS, *LABEL_COLUMNS, id_col, "split", "label_conflict",
                *(PORT_COLUMNS if self.drop_ports else ())]
        return Preprocessor(inputCols=features, dropCols=drop)

    def detector(self, budget: float, id_col: str) -> AnomalyDetector:
        return AnomalyDetector(budget=budget, idCol=id_col, seed=self.seed, trees=self.forest_trees,
                               restarts=self.restarts, reconMethod=self.recon_method,
                               components=self.components, stats=self.stats)

    def classifier(self, features: str = "features"):
        if self.algorithm == "forest":
            return random_forest(features, self.classifier_trees, seed=self.seed), True
        return boosted_trees(features, self.classifier_trees, seed=self.seed), False


# -- prepared inputs -----------------------------------------------------------------------

def packet_sample(packets: DataFrame, cfg: JobConfig) -> DataFrame:
    return imbalanced_sample(packets, cfg.packet_id, cfg.seed, cfg.n_benign, cfg.attack_min, cfg.attack_max,
                             cfg.taxonomy)


def flow_sample(unified: DataFrame, cfg: JobConfig) -> DataFrame:
    return imbalanced_sample(unified, "flow_id", cfg.seed + 1, cfg.n_benign, cfg.attack_min, cfg.attack_max,
                             cfg.taxonomy)


def unified_flows(segments: DataFrame, cfg: JobConfig) -> DataFrame:
    return unify_flows(segments, taxonomy=cfg.taxonomy, **cfg.unify_options)


def split_packets(sample: DataFrame, cfg: JobConfig) -> DataFrame:
    """70/30, by class or so that all packets of a flow stay together."""
    parts = {"train": 1 - TEST_FRACTION, "test": TEST_FRACTION}
    if cfg.split_by_flow:
        return split_by_key(sample, parts, "flow_id", cfg.seed)
    return stratified_split(sample, parts, cfg.packet_id, cfg.seed)


def split_flows(sample: DataFrame, cfg: JobConfig) -> DataFrame:
    half = TEST_FRACTION / 2
    return stratified_split(sample, {"train": 1 - 2 * half, "val": half, "test": half}, "flow_id", cfg.seed)


def part(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name)


# -- shared steps --------------------------------------------------------------------------

def evaluation(scope: str, df: DataFrame, pred: str, score: str | None = None, curves: bool = False) -> DataFrame:
    """Long metrics of one decision, with AUC when a score is given."""
    out = to_long(scope, "metrics", binary_metrics(df, "Label", pred))
    if score:
        out = out.unionByName(to_long(scope, "metrics", auc_roc(df, "Label", score)))
    if curves and score:
        out = out.unionByName(to_long(scope, "metrics", pr_auc(df, "Label", score)))
    return out


def detection_rates(scope: str, df: DataFrame, pred: str, taxonomy: Taxonomy) -> DataFrame:
    rates = per_class_detection(df, pred, classes=taxonomy.attacks)
    pairs = F.array(*[F.struct(F.concat_ws(".", "attack_type", F.lit(c)).alias("metric"),
                               F.col(c).cast("double").alias("value"))
                      for c in ("detected", "total", "detection_rate")])
    return rates.select(F.lit(scope).alias("scope"), F.lit("per_attack").alias("stage"), F.inline(pairs))


def constant(df: DataFrame, scope: str, stage: str, **values: float) -> DataFrame:
    rows = [(scope, stage, k, None if v is None else float(v)) for k, v in values.items()]
    return df.sparkSession.createDataFrame(rows, "scope string, stage string, metric string, value double")


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# -- training jobs -------------------------------------------------------------------------

@dataclass
class Trained:
    """A fitted stage, the metrics of its test rows and those rows scored."""

    model: PipelineModel
    metrics: DataFrame
    test: DataFrame


def fit_stage1(train: DataFrame, cfg: JobConfig, budget: float | None = None, id_col: str | None = None,
               features: list[str] | None = None) -> PipelineModel:
    """Preprocessing and detector in one saveable model. Labels are used for nothing."""
    id_col = id_col or cfg.packet_id
    prep = cfg.preprocessor(cfg.packet_features if features is None else features, id_col).fit(train)
    budget = cfg.alert_budget if budget is None else budget
    return PipelineModel([prep, cfg.detector(budget, id_col).fit(prep.transform(train))])


def train_stage1(packets: DataFrame, cfg: JobConfig, path: str | None = None) -> Trained:
    """Sample -> split -> fit -> metrics, and save the model."""
    split = split_packets(packet_sample(packets, cfg), cfg).persist()
    model = fit_stage1(part(split, "train"), cfg)
    test = model.transform(part(split, "test")).drop("features").persist()
    if path:
        model.write().overwrite().save(path)
    metrics = evaluation("stage1", test, "alert", "anomaly_score").unionByName(
        detection_rates("stage1", test, "alert", cfg.taxonomy))
    return Trained(model, metrics, test)


def fit_stage2(train: DataFrame, val: DataFrame, cfg: JobConfig) -> PipelineModel:
    """Preprocessing and classifier with the F1 cut-off of the validation rows."""
    return fit_and_tune(train, val, cfg)[0]


def fit_and_tune(train: DataFrame, val: DataFrame, cfg: JobConfig) -> tuple[PipelineModel, float]:
    """The second stage and its validation F1; validation rows are scored once."""
    prep = cfg.preprocessor(cfg.flow_features, "flow_id").fit(train)
    estimator, balanced = cfg.classifier()
    model = fit_classifier(prep.transform(train), estimator, balanced=balanced)
    whole = PipelineModel([prep, *model.stages])
    scored = whole.transform(val).select("Label", "proba").persist()
    try:
        cut = tune_threshold(scored, "proba")
        f1 = binary_metrics(alerts(scored, "proba", cut, "decision"), "Label", "decision").first()["f1"]
    finally:
        scored.unpersist()
    return set_threshold(whole, cut), f1


def side_by_side(*work):
    """Results of several functions that start Spark jobs, run at the same time from threads: the
    many small jobs of a tree fit leave most of a cluster idle."""
    with ThreadPoolExecutor(len(work)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(w)) for w in work]]


def train_stage2(segments: DataFrame, cfg: JobConfig, path: str | None = None) -> Trained:
    """Unify -> sample -> three-way split -> fit -> tune -> metrics, and save the model."""
    split = split_flows(flow_sample(unified_flows(segments, cfg), cfg), cfg).persist()
    model = fit_stage2(part(split, "train"), part(split, "val"), cfg)
    test = model.transform(part(split, "test")).drop("features").persist()
    if path:
        model.write().overwrite().save(path)
    metrics = evaluation("stage2", test, "decision", "proba").unionByName(
        constant(test, "stage2", "threshold", threshold=get_threshold(model)))
    return Trained(model, metrics, test)


# -- the cascade ---------------------------------------------------------------------------

def score_cascade(packets: DataFrame, flows: DataFrame, stage1: PipelineModel, stage2: PipelineModel,
                  threshold: float | None = None, flagged_only: bool = False, anomaly: PipelineModel | None = None,
                  keep: tuple[str, ...] = (), **lookup) -> DataFrame:
    """Score packets, look up their flows, score those, decide.

    Flows are scored before the join: only those that packets (or alerts, with
    ``flagged_only``) ask for, each once, and only key and probability are joined. The join
    carries two columns instead of all features, and a flow met by many packets is not
    scored again for each.
    """
    threshold = get_threshold(stage2) if threshold is None else threshold
    columns = list(dict.fromkeys([*keep, "flow_id", "Label", "attack_type", "cluster", "anomaly_score", "alert"]))
    scored = stage1.transform(packets)
    scored = scored.select(*[c for c in columns if c in scored.columns])
    asked = scored.where("alert = 1") if flagged_only else packets
    flows = flows.join(asked.select("flow_id").distinct(), "flow_id", "left_semi")
    ready = anomaly.transform(flows) if anomaly is not None else flows
    proba = stage2.transform(ready).select("flow_id", "proba")
    joined = (flagged_lookup(scored, proba, **lookup) if flagged_only
              else lookup_flows(scored, proba, **lookup))
    return supervised_only(cascade_decision(joined, threshold), get_threshold(stage2))


def cascade_metrics(decided: DataFrame, cfg: JobConfig) -> DataFrame:
    """Both stages, the combination and their comparison."""
    filled = decided.withColumn("proba", F.coalesce("proba", F.lit(0.0)))
    return union_all([
        evaluation("stage1_only", filled, "alert", "anomaly_score"),
        evaluation("supervised_only", filled, "supervised_only", "proba"),
        evaluation("two_stage", filled, "combined"),
        detection_rates("stage1_only", filled, "alert", cfg.taxonomy),
        detection_rates("two_stage", filled, "combined", cfg.taxonomy),
        to_long("two_stage", "summary", cascade_summary(filled, "Label", "alert", "combined")),
        to_long("two_stage", "mcnemar", mcnemar(filled, "Label", "alert", "combined")),
    ])


def cascade_from_saved(packets: DataFrame, segments: DataFrame, stage1_path: str, stage2_path: str,
                       cfg: JobConfig, test_only: bool = False) -> DataFrame:
    """Load both stages, transform only, decide on all packets, or on the test rows of the
    configured sample."""
    stage1, stage2 = PipelineModel.load(stage1_path), PipelineModel.load(stage2_path)
    if test_only:
        packets = part(split_packets(packet_sample(packets, cfg), cfg), "test")
    return score_cascade(packets, unified_flows(segments, cfg), stage1, stage2)


# -- the whole run -------------------------------------------------------------------------

@dataclass
class Report:
    """Long metrics (scope, stage, metric, value), the decided packet test rows, and the
    tables behind the figures."""

    metrics: DataFrame
    decided: DataFrame
    importance: DataFrame
    figures: dict[str, DataFrame]
    stage1: PipelineModel
    stage2: PipelineModel
    cascade_model: str


def ablation(split: DataFrame, cfg: JobConfig) -> tuple[dict, DataFrame, PipelineModel]:
    """Flow classifier with and without the flow anomaly score as a feature.

    Returns the fitted variants {name: (model, validation F1)}, their test metrics, and the
    flow detector.
    """
    train, val, test = part(split, "train"), part(split, "val"), part(split, "test")
    detector = fit_stage1(train, cfg, contamination(train), "flow_id", cfg.flow_features)
    with_score = detector_feature(detector)
    augmented_cfg = cfg
    if cfg.flow_features:
        augmented_cfg = replace(cfg, flow_features=[*cfg.flow_features, "anomaly_score"])
    scored_train, scored_val = with_score.transform(train).persist(), with_score.transform(val).persist()
    try:
        base, augmented = side_by_side(lambda: fit_and_tune(train, val, cfg),
                                       lambda: fit_and_tune(scored_train, scored_val, augmented_cfg))
    finally:
        scored_train.unpersist()
        scored_val.unpersist()
    out = {"without_flow_anomaly": base, "with_flow_anomaly": augmented}
    # Every curve and count reads the scores of the test rows, not 400 trees.
    tested = detector.transform(test).select("Label", "anomaly_score", "alert").persist()
    rows = [evaluation("flow_unsupervised", tested, "alert", "anomaly_score")]
    for name, (model, f1) in out.items():
        given = with_score.transform(test) if name == "with_flow_anomaly" else test
        scored = model.transform(given).select("Label", "decision", "proba").persist()
        rows.append(evaluation(name, scored, "decision", "proba"))
        rows.append(constant(split, name, "validation", f1=f1, threshold=get_threshold(model)))
    return out, union_all(rows), with_score


def detector_feature(detector: PipelineModel) -> PipelineModel:
    """The detector as a step that only adds its score, ready to be a feature."""
    return PipelineModel([*detector.stages, KeepScore()])


def flow_against_packet(metrics: DataFrame) -> DataFrame:
    """Whether the detector separates flows better than packets: AUC of one less the other
    (NULL when there was no flow detector)."""
    def auc(scope: str):
        return F.max(F.when((F.col("scope") == scope) & (F.col("metric") == "auc_roc"), F.col("value")))

    return to_long("comparison", "flow_vs_packet", metrics.agg(
        (auc("flow_unsupervised") - auc("stage1_only")).alias("auc_difference"),
        (auc("flow_unsupervised") > auc("stage1_only")).cast("int").alias("flow_beats_packet")))


def figure_tables(decided: DataFrame, flow_scored: DataFrame, cfg: JobConfig) -> dict[str, DataFrame]:
    """The data of every figure, computed when asked for."""
    out = {
        "roc_packets": roc_curve(decided, "Label", "anomaly_score"),
        "pr_packets": pr_curve(decided, "Label", "anomaly_score"),
        "roc_flows": roc_curve(flow_scored, "Label", "proba"),
        "pr_flows": pr_curve(flow_scored, "Label", "proba"),
        "score_histogram": score_histogram(decided, "anomaly_score"),
        "detection_stage1": per_class_detection(decided, "alert", classes=cfg.taxonomy.attacks),
        "detection_two_stage": per_class_detection(decided, "combined", classes=cfg.taxonomy.attacks),
    }
    if "cluster" in decided.columns:
        out["clusters"] = cluster_composition(decided, "cluster", "attack_type", cfg.taxonomy.classes)
    return out


def run_detection(packets: DataFrame, segments: DataFrame, cfg: JobConfig) -> Report:
    """The full two-stage run.

    Four tables are cached because several fits read them: the packet split, the unified
    flows, the flow split and the decided test rows. The leakage guard comes before the flow
    sample, so the sample keeps its exact counts, and the variant for the cascade is chosen
    on validation F1.
    """
    pkt = split_packets(packet_sample(packets, cfg), cfg).persist()
    test = part(pkt, "test")
    stage1 = fit_stage1(part(pkt, "train"), cfg)

    unified = unified_flows(segments, cfg).persist()
    guarded = without_test_flows(unified, test)
    flows = split_flows(flow_sample(guarded, cfg), cfg).persist()
    flow_test = part(flows, "test")
    if cfg.flow_anomaly:
        variants, flow_metrics, with_score = ablation(flows, cfg)
        chosen = max(variants, key=lambda n: (variants[n][1], n == "with_flow_anomaly"))
        stage2 = variants[chosen][0]
        anomaly = with_score if chosen == "with_flow_anomaly" else None
    else:
        stage2 = fit_stage2(part(flows, "train"), part(flows, "val"), cfg)
        chosen, anomaly = "without_flow_anomaly", None
        flow_metrics = evaluation(chosen, stage2.transform(flow_test), "decision", "proba")

    val = part(flows, "val")
    confirm = cascade_threshold(stage2.transform(anomaly.transform(val) if anomaly else val), "proba",
                                get_threshold(stage2), recall=cfg.cascade_recall)
    decided = score_cascade(test, unified, stage1, stage2, confirm, anomaly=anomaly, keep=(cfg.packet_id,),
                            spread_by=cfg.packet_id).persist()

    flow_scored = stage2.transform(anomaly.transform(flow_test) if anomaly else flow_test).drop("features").persist()
    fpr_cut = fpr_threshold(decided, "anomaly_score", target=cfg.target_fpr)
    at_fpr = alerts(decided, "anomaly_score", fpr_cut, "fpr_alert")
    names = next(s for s in stage2.stages if isinstance(s, PreprocessorModel)).feature_names
    detector = next(s for s in stage1.stages if isinstance(s, AnomalyDetectorModel))
    sample = pkt.agg(F.count(F.lit(1)).alias("n_total"), F.sum("Label").alias("n_attack"),
                     F.avg("Label").alias("attack_ratio"))
    metrics = union_all([
        to_long("packets", "sample", sample),
        to_long("flows", "unified", segment_stats(unified)),
        constant(pkt, "stage1_only", "threshold", threshold=detector.threshold, fpr_threshold=fpr_cut,
                 alert_budget=cfg.alert_budget),
        evaluation("stage1_at_fpr", at_fpr, "fpr_alert", "anomaly_score"),
        flow_metrics,
        constant(pkt, "two_stage", "threshold", confirm=confirm, f1=get_threshold(stage2),
                 target_recall=cfg.cascade_recall),
        cascade_metrics(decided, cfg),
    ]).persist()
    metrics = metrics.unionByName(flow_against_packet(metrics))
    importance = top_features(feature_importance(pkt.sparkSession, stage2, names))
    return Report(metrics, decided, importance, figure_tables(decided, flow_scored, cfg), stage1, stage2, chosen)


@dataclass
class FlowLength:
    correlations: DataFrame
    within_class: DataFrame
    by_quartile: DataFrame


def flow_length_analysis(segments: DataFrame, cfg: JobConfig, packets: str = "total_packets",
                         duration: str = "flow_duration") -> FlowLength:
    """Is a longer flow detected more easily? A flow detector at the contamination rate, and
    how its hits among attack flows go with their length."""
    sample = flow_sample(unified_flows(segments, cfg), cfg)
    split = stratified_split(sample, {"train": 0.6, "test": 0.4}, "flow_id", cfg.seed).persist()
    train = part(split, "train")
    detector = fit_stage1(train, cfg, contamination(train), "flow_id", cfg.flow_features)
    attacks = detector.transform(part(split, "test")).where("Label = 1") \
                      .select("attack_type", packets, duration, "alert").persist()
    return FlowLength(flow_length_corr(attacks, packets, duration, "alert"),
                      within_class_corr(attacks, packets, "alert"),
                      detection_by_bucket(attacks, packets, "alert"))
