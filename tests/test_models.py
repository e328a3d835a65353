import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from flowguard.models.classifier import (boosted_trees, feature_importance, fit_classifier, get_threshold,
                                         random_forest, set_threshold, top_features)
from flowguard.models.detector import AnomalyDetector, combined_score
from flowguard.models.iforest import IsolationForest, average_path
from flowguard.models.kmeans import NearestCentre, nearest_centre
from flowguard.models.preprocess import Preprocessor, PreprocessorModel, select_features
from flowguard.models.recon import (Reconstruction, _forward, _gradient, _initial_weights, _layer_shapes,
                                    _unflatten)


@pytest.fixture(scope="module")
def raw(spark):
    rng = np.random.default_rng(8)
    n = 2_000
    a, b, c = rng.lognormal(size=n), rng.normal(size=n), rng.integers(0, 3, n).astype(float)
    rows = [(i, f"id{i}", float(a[i]), float("inf") if i % 50 == 0 else float(b[i]), None if i % 3 == 0 else str(c[i]),
             "text", None, 4.0, int(i % 2), "x") for i in range(n)]
    return spark.createDataFrame(rows, "row_id int, flow_id string, a double, b double, c string, note string, "
                                       "none double, flat double, Label int, attack_type string").repartition(4).persist()


def numpy_preprocess(values, clip=True):
    x = np.array([np.nan if v is None else float(v) for v in values])
    x[~np.isfinite(x)] = np.nan
    if clip:
        lo, hi = np.nanquantile(x, [0.01, 0.99])
        x = np.clip(x, lo, hi)
    x = np.where(np.isnan(x), np.nanmedian(x), x)
    return (x - x.mean()) / (x.std() or 1.0)


@pytest.mark.parametrize("clip", [True, False])
def test_preprocessor_matches_numpy(raw, clip):
    model = Preprocessor(clip=clip, dropCols=["row_id", "flow_id", "Label", "attack_type"]).fit(raw)
    assert model.feature_names == ["a", "b", "c", "flat"] and model.getOrDefault("dropped") == ["none"]
    rows = raw.orderBy("row_id").collect()
    got = model.transform(raw).orderBy("row_id").select("features").collect()
    matrix = np.array([r[0].toArray() for r in got])
    for j, name in enumerate(model.feature_names):
        assert matrix[:, j] == pytest.approx(numpy_preprocess([r[name] for r in rows], clip), abs=1e-9)
    assert np.isfinite(matrix).all() and (matrix[:, 3] == 0).all()


def test_preprocessor_saves_and_guards(raw, tmp_path):
    model = Preprocessor(dropCols=["row_id", "flow_id", "Label", "attack_type"]).fit(raw)
    model.write().overwrite().save(str(tmp_path / "p"))
    again = PreprocessorModel.load(str(tmp_path / "p"))
    assert again.transform(raw).select("features").exceptAll(model.transform(raw).select("features")).count() == 0
    with pytest.raises(ValueError):
        model.transform(raw.drop("a"))
    assert "c" in select_features(raw, []) and "note" not in select_features(raw, [])
    one = raw.limit(1).withColumn("a", F.lit(None).cast("double"))
    assert np.isfinite(model.transform(one).first()["features"].toArray()).all()


@pytest.fixture(scope="module")
def planted(spark):
    """2,000 rows in 3 groups on a plane in 6 dimensions, the last 40 far off it."""
    rng = np.random.default_rng(1)
    basis = rng.normal(size=(2, 6))
    centres = np.array([[0, 0], [4, 0], [0, 4]])
    x = (centres[rng.integers(0, 3, 2_000)] + rng.normal(scale=0.4, size=(2_000, 2))) @ basis
    x += rng.normal(scale=0.05, size=x.shape)
    x[-40:] += rng.normal(scale=6, size=(40, 6))
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    df = spark.createDataFrame([(i, r.tolist(), int(i >= 1_960)) for i, r in enumerate(x)],
                               "id int, x array<double>, Label int").repartition(4)
    return x, df.withColumn("features", array_to_vector("x")).drop("x").persist()


def column(df, name):
    return np.array([r[0] for r in df.orderBy("id").select(name).collect()])


def test_pca_error_matches_numpy(planted):
    x, df = planted
    got = column(Reconstruction(components=2).fit(df).transform(df), "recon_error")
    centred = x - x.mean(axis=0)
    axes = np.linalg.svd(centred, full_matrices=False)[2][:2]
    assert got == pytest.approx(((centred - centred @ axes.T @ axes) ** 2).mean(axis=1), abs=1e-9)


def test_network_gradient_is_exact():
    rng = np.random.default_rng(0)
    shapes = _layer_shapes(4, [5, 3, 5])
    w, x = _initial_weights(shapes, 1), rng.normal(size=(20, 4))

    def loss(v):
        return 0.5 * ((x - _forward(x, _unflatten(v, shapes))[-1]) ** 2).mean()

    grad, step = _gradient(x, _unflatten(w, shapes)), 1e-6
    for i in rng.choice(len(w), 25, replace=False):
        up, down = w.copy(), w.copy()
        up[i] += step
        down[i] -= step
        assert grad[i] == pytest.approx((loss(up) - loss(down)) / (2 * step), abs=1e-7)


def test_network_learns(planted):
    _, df = planted
    few = Reconstruction(method="mlp", layers=[16, 3, 16], epochs=1).fit(df).transform(df)
    more = Reconstruction(method="mlp", layers=[16, 3, 16], epochs=15, stepSize=5e-3).fit(df).transform(df)
    normal = "Label = 0"
    assert more.where(normal).agg(F.avg("recon_error")).first()[0] < 0.5 * few.where(normal).agg(F.avg("recon_error")).first()[0]


def test_average_path():
    harmonic = sum(1 / i for i in range(1, 256))
    assert average_path([0, 1, 2, 256])[:3].tolist() == [0.0, 0.0, 1.0]
    assert average_path(256) == pytest.approx(2 * harmonic - 2 * 255 / 256, abs=0.01)


def walk(state, tree, row):
    """Path length of one row by plain recursion."""
    node, inner = 0, state["feature"].shape[1]
    while node < inner:
        node = 2 * node + (2 if row[state["feature"][tree, node]] >= state["cut"][tree, node] else 1)
    return state["path"][tree, node - inner]


def test_forest_scores_match_a_plain_walk(planted):
    x, df = planted
    model = IsolationForest(trees=30, idCol="id", seed=3).fit(df)
    assert model.state["feature"].shape[0] == 30
    got = column(model.transform(df), "isolation_score")
    for i in (0, 5, 1_999):
        mean = np.mean([walk(model.state, t, x[i]) for t in range(30)])
        assert got[i] == pytest.approx(2 ** (-mean / float(average_path(256))))
    assert got[-40:].mean() > np.quantile(got[:-40], 0.95)
    again = IsolationForest(trees=30, idCol="id", seed=3).fit(df.repartition(3))
    assert column(again.transform(df), "isolation_score") == pytest.approx(got)


def test_every_tree_has_its_own_exact_sample(spark):
    """The rows of the least hashes, whatever the partitions and the order inside them."""
    n, trees, rows = 5_000, 12, 64
    base = spark.range(n).select("id", array_to_vector(F.array(F.sin("id"), F.cos(F.col("id") * 3))).alias("features"))
    forests = [IsolationForest(trees=trees, sampleRows=rows, idCol="id").fit(base.repartition(p)).state for p in (1, 7)]
    for name in forests[0]:
        assert np.array_equal(forests[0][name], forests[1][name])
    est = IsolationForest(trees=trees, sampleRows=rows, idCol="id")
    drawn = est._draw(base, 1.0, trees, 42).groupBy("tree").agg(F.count("*").alias("n"), F.countDistinct("_id").alias("d")).collect()
    assert {(r["n"], r["d"]) for r in drawn} == {(n, n)} and len(drawn) == trees
    # Copies of one vector count as rows of their own, with and without an id.
    copies = spark.range(n).select("id", array_to_vector(F.array(F.lit(1.0), (F.col("id") % 3 == 0).cast("double"))).alias("features"))
    for id_col in ("", "id"):
        state = IsolationForest(trees=trees, sampleRows=rows, idCol=id_col).fit(copies).state
        assert state["rows"][0] == rows and (state["path"] > 0).any()


def test_centres_without_an_exchange_of_rows(spark, monkeypatch):
    """With an id no plan of the fit shuffles feature rows."""
    from flowguard.models import kmeans
    df = spark.range(0, 600, 1, 2).select("id", array_to_vector(F.array(F.sin("id"), F.cos("id"))).alias("features"))
    seen = []
    monkeypatch.setattr(kmeans, "_mean_variance", lambda rows, n, f=kmeans._mean_variance: seen.append(
        rows._jdf.queryExecution().executedPlan().toString()) or f(rows, n))
    NearestCentre(k=3, restarts=1, idCol="id").fit(df)
    NearestCentre(k=3, restarts=1).fit(df)
    assert "Exchange" not in seen[0] and "Exchange" in seen[1]


def test_network_does_not_depend_on_partitions(planted):
    _, df = planted
    for id_col in ("id", ""):
        est = Reconstruction(method="mlp", layers=[8, 3, 8], epochs=2, batchSize=300, stepSize=5e-3, idCol=id_col)
        a, b = (est.fit(df.repartition(p)).state for p in (2, 5))
        assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], rtol=1e-9, atol=1e-12) for k in a)


def test_network_equals_a_single_process(spark, planted):
    """The same batches and steps in one loop give the same weights."""
    from flowguard.models import recon
    _, df = planted
    est = Reconstruction(method="mlp", layers=[6, 2, 6], epochs=2, batchSize=200, stepSize=1e-2, idCol="id")
    state = est.fit(df).state
    rows = df.select(vector_to_array("features").alias("x"), F.xxhash64("id").alias("h")).collect()
    x, width = np.array([r["x"] for r in rows]), len(rows[0]["x"])
    shapes = recon._layer_shapes(width, [6, 2, 6])
    w, t = recon._initial_weights(shapes, 42), 0
    m, v = np.zeros_like(w), np.zeros_like(w)
    steps = min(recon.MAX_STEPS, -(-len(rows) // 200))
    ids = spark.createDataFrame([(r["h"],) for r in rows], "h long")
    at = np.array([r[0] for r in ids.select(F.pmod(F.xxhash64("h", F.lit(42)), F.lit(steps))).collect()])
    for epoch in range(2):
        for s in np.random.default_rng([42, epoch]).permutation(steps):
            if (at == s).any():
                g = recon._gradient(x[at == s], recon._unflatten(w, shapes))
                t += 1
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                w = w - 1e-2 * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t) * m / (np.sqrt(v) + 1e-8)
    got = np.concatenate([np.concatenate([state[f"w{i}"].ravel(), state[f"b{i}"].ravel()]) for i in range(len(shapes))])
    assert np.allclose(got, w, rtol=1e-6, atol=1e-9)


def test_forest_on_tiny_and_constant_tables(spark, planted):
    _, df = planted
    tiny = IsolationForest(trees=5).fit(df.limit(3))
    assert 0 < tiny.transform(df.limit(3)).first()["isolation_score"] < 1
    flat = df.withColumn("features", array_to_vector(F.array(F.lit(1.0), F.lit(2.0))))
    scores = {round(r[0], 9) for r in IsolationForest(trees=5).fit(flat).transform(flat).select("isolation_score").collect()}
    assert scores == {0.5}


def test_nearest_centre(planted):
    x, df = planted
    model = NearestCentre(k=3, restarts=4).fit(df)
    out = model.transform(df)
    cluster, distance = nearest_centre(model.state["centres"], x)
    assert column(out, "kmeans_distance") == pytest.approx(distance) and (column(out, "cluster") == cluster).all()
    from pyspark.ml.clustering import KMeans
    spark_cost = min(KMeans(k=3, seed=i, maxIter=30).fit(df).summary.trainingCost for i in range(3))
    assert (distance ** 2).sum() <= 1.02 * spark_cost


def test_centres_do_not_depend_on_partitions(planted):
    _, df = planted
    for id_col in ("", "id"):
        a, b = (NearestCentre(k=3, restarts=2, idCol=id_col).fit(df.repartition(n)).state["centres"] for n in (2, 5))
        assert a == pytest.approx(b, abs=1e-9)


def test_starts_weigh_equal_rows(spark):
    """A vector that a third of all rows share is a candidate of every start, and a table of few
    distinct vectors gets as many different centres as asked for."""
    x = np.random.default_rng(2).normal(size=(2_000, 3))
    rows = [(v.tolist(),) for v in x] + [([9.0, 9.0, 9.0],)] * 1_000
    flood = spark.createDataFrame(rows, "x array<double>").select(array_to_vector("x").alias("features"))
    centres = NearestCentre(k=2, restarts=1).fit(flood).state["centres"]
    assert np.abs(centres - 9.0).max(axis=1).min() < 1e-9
    numbered = flood.withColumn("id", F.monotonically_increasing_id()).persist()
    assert np.abs(NearestCentre(k=2, restarts=1, idCol="id").fit(numbered).state["centres"] - 9.0).max(axis=1).min() < 1e-9
    few = spark.range(20_000).select(array_to_vector(F.array(*[(F.col("id") % 20 * p % 17).cast("double") for p in (1, 3, 5)])).alias("features"))
    centres = NearestCentre(k=8, restarts=1, maxIter=1).fit(few).state["centres"]
    assert len(np.unique(centres, axis=0)) == 8


def test_combined_score(planted):
    _, df = planted
    t = df.select("id", F.col("id").cast("double").alias("p"), F.sin("id").alias("q"))
    p, q = column(t, "p"), column(t, "q")
    want = ((p - p.mean()) / (p.std() + 1e-9) + (q - q.mean()) / (q.std() + 1e-9)) / 2
    assert column(combined_score(t, ["p", "q"]), "anomaly_score") == pytest.approx(want)
    frozen = combined_score(t, ["p", "q"], mean=[p.mean(), q.mean()], std=[p.std(), q.std()])
    assert column(frozen.where("id < 7"), "anomaly_score") == pytest.approx(want[:7])


@pytest.fixture(scope="module")
def detector(planted):
    return AnomalyDetector(trees=50, restarts=2, k=3, layers=[4, 2, 4], budget=0.02, idCol="id").fit(planted[1])


def test_detector_finds_planted_rows(planted, detector):
    out = detector.transform(planted[1])
    assert out.agg(F.sum("alert")).first()[0] == pytest.approx(40, abs=2)
    assert out.where("Label = 1").agg(F.avg("alert")).first()[0] > 0.85


def test_detector_statistics_modes(planted, detector):
    df = planted[1]
    one = detector.transform(df.where("id = 1999")).first()["anomaly_score"]
    assert one == pytest.approx(detector.transform(df).where("id = 1999").first()["anomaly_score"])
    batch = detector.copy({detector.stats: "batch"})
    assert batch.transform(df.where("id = 1999")).first()["anomaly_score"] == pytest.approx(0.0)
    assert column(batch.transform(df), "anomaly_score") == pytest.approx(column(detector.transform(df), "anomaly_score"))


def test_detector_roundtrip_and_tendency(spark, planted, detector, tmp_path):
    PipelineModel([detector]).write().overwrite().save(str(tmp_path / "d"))
    again = PipelineModel.load(str(tmp_path / "d"))
    assert (column(again.transform(planted[1]), "anomaly_score") == column(detector.transform(planted[1]), "anomaly_score")).all()
    rows = {r["cluster"]: r["mean_recon_error"] for r in detector.tendency(spark).collect()}
    out = detector.transform(planted[1]).groupBy("cluster").agg(F.avg("recon_error")).collect()
    assert rows == {r[0]: pytest.approx(r[1]) for r in out}


def test_forest_only_detector(planted):
    model = AnomalyDetector(components=["isolation"], trees=20, budget=0.1, idCol="id").fit(planted[1])
    out = model.transform(planted[1])
    assert "recon_error" not in out.columns and out.where("anomaly_score <> isolation_score").count() == 0
    assert out.agg(F.avg("alert")).first()[0] == pytest.approx(0.1, abs=0.01)
    with pytest.raises(ValueError):
        AnomalyDetector(components=["other"])


@pytest.mark.parametrize("make,trees,depth,balanced", [(boosted_trees, 5, 3, False), (random_forest, 10, 4, True)])
def test_classifiers(spark, planted, make, trees, depth, balanced):
    estimator = make(trees=trees, depth=depth)
    df = planted[1].withColumn("Label", (F.col("id") % 4 == 0).cast("int")).withColumn(
        "features", array_to_vector(F.array(F.col("Label") + F.rand(3) * 0.6, F.rand(4))))
    model = fit_classifier(df, estimator, balanced=balanced)
    out = model.transform(df)
    assert "probability" not in out.columns
    assert out.agg(F.corr("proba", "Label")).first()[0] > 0.95
    set_threshold(model, 0.99)
    assert get_threshold(model) == 0.99
    top = top_features(feature_importance(spark, model, ["signal", "noise"]), 1).collect()
    assert [r["feature"] for r in top] == ["signal"]


def test_boosted_trees_equal_sparks(spark, monkeypatch):
    """Without draws the trees, probabilities and importances are those of Spark's trees, in any number of tasks. Every
    row has a weight of its own, or equal counts would leave the choice between two cuts to rounding."""
    from pyspark.ml.classification import GBTClassifier

    from flowguard.models import boosting
    from flowguard.models.classifier import AttackProbability
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=3_000), rng.integers(0, 5, 3_000), np.where(rng.random(3_000) < 0.4, 1.5, rng.lognormal(size=3_000))])
    y = (x[:, 0] + 0.3 * x[:, 1] * (x[:, 2] > 1.5) + rng.normal(scale=0.7, size=3_000) > 0.5).astype(int)
    rows = [(i, r.tolist(), int(v), float(w)) for i, (r, v, w) in enumerate(zip(x, y, rng.uniform(0.5, 2, 3_000)))]
    df = spark.createDataFrame(rows, "id int, x array<double>, Label int, weight double") \
        .select("id", array_to_vector("x").alias("features"), "Label", "weight").repartition(5, "id").persist()

    def fitted(estimator):
        model = PipelineModel([estimator.fit(df), AttackProbability()])
        importance = [r["importance"] for r in feature_importance(spark, model, ["a", "b", "c"]).collect()]
        return column(model.transform(df), "proba"), column(model.transform(df), "decision"), importance

    want = fitted(GBTClassifier(labelCol="Label", weightCol="weight", maxIter=6, maxDepth=4, stepSize=0.1))
    for rows_per_task in (10_000, 700):
        monkeypatch.setattr(boosting, "ROWS_PER_TASK", rows_per_task)
        got = fitted(boosted_trees(trees=6, depth=4, rows=1.0, columns="all"))
        assert got[0] == pytest.approx(want[0], abs=1e-9) and (got[1] == want[1]).all()
        assert got[2] == pytest.approx(want[2], abs=1e-6)


def test_boosted_trees_take_few_jobs(spark, planted, tmp_path):
    """A fit is a handful of jobs, however many trees; saved and loaded it scores alike, and the leaves found by bits
    are those of a walk."""
    from flowguard.models.boosting import Scorer
    df = planted[1]
    spark.sparkContext.setJobGroup("boosted", "")
    model = fit_classifier(df, boosted_trees(trees=40))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("boosted")) < 20
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert (column(again.transform(df), "proba") == column(model.transform(df), "proba")).all()
    scorer = Scorer(**{k: model.stages[0].state[k] for k in ("feature", "cut", "leaf", "width")})
    assert scorer(planted[0]) == pytest.approx(scorer._walked(planted[0]))
    assert column(model.transform(df), "proba") == pytest.approx(1 / (1 + np.exp(-2 * scorer(planted[0]))))


def test_boosted_trees_refuse_what_spark_refuses(spark):
    rows = [(0, [1.0], 0), (1, [2.0], 1), (2, [3.0], None)]
    df = spark.createDataFrame(rows, "id int, x array<double>, Label int").select("id", array_to_vector("x").alias("features"), "Label")
    with pytest.raises(Exception, match="labels"):
        fit_classifier(df, boosted_trees(trees=2))
    with pytest.raises(ValueError):
        fit_classifier(df.limit(0), boosted_trees(trees=2))
    one = fit_classifier(df.where("id = 0"), boosted_trees(trees=2)).transform(df)
    assert column(one, "decision").tolist() == [0, 0, 0]


def test_network_takes_few_jobs(spark, planted, monkeypatch):
    """A fit is a handful of jobs, however many steps, and several tasks that add up their gradients give the weights
    of one."""
    from flowguard.models import recon
    df = planted[1]
    est = Reconstruction(method="mlp", layers=[6, 2, 6], epochs=6, batchSize=100, stepSize=1e-2, idCol="id")
    spark.sparkContext.setJobGroup("network", "")
    one = est.fit(df).state
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("network")) < 20
    monkeypatch.setattr(recon, "ROWS_PER_TASK", 600)
    four = est.fit(df).state
    assert all(np.allclose(one[k], four[k], rtol=1e-6, atol=1e-9) for k in one)
