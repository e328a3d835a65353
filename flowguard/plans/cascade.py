"""The two-stage decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.functions.cleaning import reached


def confirmation(alert: Column, have_flow: Column, proba: Column, threshold: Column | float) -> Column:
    """1 where the flow model confirms; without a flow record the first stage is trusted."""
    return F.when(have_flow, reached(proba, threshold)).otherwise(alert)


def cascade_decision(df: DataFrame, threshold: float, alert: str = "alert", have_flow: str = "have_flow",
                     proba: str = "proba", out: str = "combined") -> DataFrame:
    """Final decision: an alert that the second stage confirms."""
    confirm = confirmation(F.col(alert), F.col(have_flow), F.col(proba), F.lit(float(threshold)))
    return df.withColumn(out, ((F.col(alert) == 1) & (confirm == 1)).cast("int"))


def supervised_only(df: DataFrame, threshold: float, have_flow: str = "have_flow", proba: str = "proba",
                    out: str = "supervised_only") -> DataFrame:
    """Decision of the flow model alone; a packet without a flow record counts as benign."""
    decided = F.when(F.col(have_flow), reached(F.col(proba), F.lit(float(threshold)))).otherwise(0)
    return df.withColumn(out, decided)
