"""Keys that hold much of a table, found with a mergeable sketch.

The sketch is Spark's own (``approx_top_k``): a bounded map of counters per task, merged across
tasks and, in a stream, across micro-batches. A count it reports is never more than ``ERROR`` / size
of all rows above the true one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

#: Counters per shuffle partition, and the most that a sketch takes.
COUNTERS, MOST_COUNTERS = 32, 1_000_000
ERROR = 3.5


def sketch_size(partitions: int) -> int:
    return min(MOST_COUNTERS, COUNTERS * max(32, partitions))


def key_sketch(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """One row: the sketch of the keys and the number of rows."""
    return df.agg(F.expr(f"approx_top_k_accumulate(`{key}`, {sketch_size(partitions)})").alias("sketch"),
                  F.count(F.lit(1)).alias("rows"))


def merged_sketch(sketches: DataFrame, partitions: int) -> DataFrame:
    """Several rows of ``key_sketch`` as one."""
    return sketches.agg(F.expr(f"approx_top_k_combine(sketch, {sketch_size(partitions)})").alias("sketch"),
                        F.sum("rows").alias("rows"))


def salts_from(sketch: DataFrame, partitions: int) -> dict:
    """Number of salts of each key that holds over half of what a task gets on average (at most
    two keys a task): as many as give every salt half of such a share."""
    top = 2 * partitions
    row = sketch.select("rows", F.expr(f"approx_top_k_estimate(sketch, {min(top, sketch_size(partitions))})").alias("items")).first()
    if not row or not row["rows"]:
        return {}
    share = row["rows"] / partitions / 2
    return {i["item"]: math.ceil(i["count"] / share) for i in row["items"] or [] if i["item"] is not None and i["count"] > share}


def key_salts(df: DataFrame, key: str, partitions: int | None = None) -> dict:
    """Salts of the heavy keys of a table, from one pass."""
    partitions = partitions or max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return salts_from(key_sketch(df.where(F.col(key).isNotNull()), key, partitions), partitions)


def salt_count(key: Column, salts: dict, kind: DataType) -> Column:
    """The number of salts of a key as a column, 1 for keys not listed."""
    if not salts:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for k, n in salts.items() for x in (F.lit(k).cast(kind), n)])
    return F.coalesce(F.try_element_at(table, key), F.lit(1))
