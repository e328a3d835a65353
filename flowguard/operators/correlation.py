"""Does flow length make an attack easier to detect? Correlations and quartile rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.functions.pvalues import pearson_p
from flowguard.operators.quantiles import exact_quantiles

MIN_GROUP = 20


def _pearson(x: Column, y: Column) -> Column:
    """Pearson's r from moments; NULL, not an error, when a column is constant."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def flow_length_corr(df: DataFrame, packets: str, duration: str, detected: str) -> DataFrame:
    """Correlation of log packets and of duration with detection: r, p and n, one row each."""
    d = F.col(detected)
    row = df.agg(F.count(d).alias("n"), _pearson(F.log1p(packets), d).alias("r0"),
                 _pearson(F.col(duration), d).alias("r1"))
    rows = F.array(*[F.struct(F.lit(name).alias("measure"), F.col(c).alias("r"))
                     for name, c in (("log_packets", "r0"), ("duration", "r1"))])
    flat = row.select("n", F.inline(rows))
    return flat.withColumn("p", pearson_p(F.col("r"), F.col("n"))).select("measure", "r", "p", "n")


def within_class_corr(df: DataFrame, packets: str, detected: str, attack_type: str = "attack_type",
                      min_rows: int = MIN_GROUP) -> DataFrame:
    """The log-packets correlation inside each class; NULL for a class with fewer than
    ``min_rows`` rows or a single outcome."""
    d = F.col(detected)
    grouped = df.groupBy(F.col(attack_type).alias("attack_type")).agg(
        F.count(F.lit(1)).alias("n"), (F.min(d) != F.max(d)).alias("_varied"),
        _pearson(F.log1p(packets), d).alias("_r"))
    kept = grouped.select("attack_type", "n",
                          F.when(F.col("_varied") & (F.col("n") >= min_rows), F.col("_r")).alias("r"))
    return kept.withColumn("p", pearson_p(F.col("r"), F.col("n")))


def detection_by_bucket(df: DataFrame, value: str, detected: str, parts: int = 4,
                        **options) -> DataFrame:
    """Detection rate per quantile bucket of a column. Buckets are right-closed, the lowest
    value belongs to the first, and equal edges are merged."""
    c = F.col(value)
    found = exact_quantiles(df, {"v": c}, [i / parts for i in range(parts + 1)], **options)["v"]
    edges = sorted({q.value for q in found if q is not None})
    if len(edges) < 2:
        edges = edges * 2
    inner = F.array(*[F.lit(float(e)) for e in edges[1:-1]]) if len(edges) > 2 else \
        F.array().cast("array<double>")
    lows = F.array(*[F.lit(float(e)) for e in edges])
    bucket = F.size(F.filter(inner, lambda e: e < c.cast("double")))
    rated = (df.where(c.isNotNull()).groupBy(bucket.alias("bucket"))
               .agg(F.count(F.lit(1)).alias("n"), F.avg(detected).alias("detection_rate")))
    return rated.select("bucket", F.get(lows, F.col("bucket")).alias("lo"),
                        F.get(lows, F.col("bucket") + 1).alias("hi"), "n", "detection_rate")
