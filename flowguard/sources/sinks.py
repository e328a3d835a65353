"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Long metrics (scope, stage, metric, value) as JSON lines."""
    metrics.write.mode("overwrite").json(path)


def nested_report(metrics: DataFrame) -> DataFrame:
    """The long metrics as one row of nested JSON: scope -> stage -> metric -> value.

    The input is a few rows per stage, whatever the size of the data behind it.
    """
    def entries(key: str, value: str):
        return F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, value))))

    stages = metrics.groupBy("scope", "stage").agg(entries("metric", "value").alias("m"))
    scopes = stages.groupBy("scope").agg(
        F.collect_list(F.struct("stage", "m")).alias("s"))
    scopes = scopes.select("scope", F.map_from_entries("s").alias("s"))
    whole = scopes.agg(F.map_from_entries(F.collect_list(F.struct("scope", "s"))).alias("r"))
    return whole.select(F.to_json("r").alias("report"))


def write_report(metrics: DataFrame, path: str) -> None:
    nested_report(metrics).write.mode("overwrite").text(path)
