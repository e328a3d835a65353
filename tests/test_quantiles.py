import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.operators.quantiles import exact_quantiles, order_statistics

PROBS = [0.0, 0.01, 0.25, 0.5, 0.8, 0.95, 0.99, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double") \
                .repartition(5)


@pytest.mark.parametrize("shape", ["normal", "hot", "few", "one", "pair", "bool", "signs"])
def test_quantiles_match_numpy(spark, shape):
    rng = np.random.default_rng(3)
    values = {
        "normal": rng.normal(size=3_000),
        "hot": np.concatenate([np.full(1_500, 7.0), rng.uniform(0, 20, 1_500)]),
        "few": rng.integers(0, 4, 1_000),
        "one": np.array([5.0]),
        "pair": np.array([1.0, 2.0]),
        "signs": np.concatenate([-rng.exponential(size=500), [-0.0, 0.0, -1e300, 1e-300], rng.exponential(size=500)]),
        "bool": np.array([0.0] * 999 + [1.0]),
    }[shape]
    df = frame(spark, [None, *values, None])
    got = exact_quantiles(df, {"x": F.col("x")}, PROBS)["x"]
    assert [q.value for q in got] == pytest.approx(np.quantile(values, PROBS).tolist(), abs=1e-12)


def test_many_columns_and_empty(spark):
    df = frame(spark, range(101))
    items = {"x": F.col("x"), "neg": -F.col("x"), "none": F.lit(None).cast("double"),
             "half": F.when(F.col("x") < 50, F.col("x"))}
    got = exact_quantiles(df, items, [0.5])
    assert got["none"] == [None]
    assert [got[n][0].value for n in ("x", "neg", "half")] == [50.0, -50.0, 24.5]


def test_ranks_of_integers(spark):
    df = spark.range(0, 10_000, 1, 7).select((F.col("id") * 3).alias("x"))
    got = order_statistics(df, {"x": F.col("x")}, lambda _, n: [0, 1, 5_000, n - 1])
    assert got["x"] == {0: 0, 1: 3, 5_000: 15_000, 9_999: 29_997}
