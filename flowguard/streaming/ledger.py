"""Alert shares per micro-batch and per time window, kept in a ledger."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRIES = "window_start timestamp, n long, n_alerts long, batch_id long"


@dataclass
class AlertLedger:
    """One entry per micro-batch and window in a folder named after the batch. A batch that is run
    again writes the same folder anew, so it counts once. ``path`` lies in a shared folder."""

    path: str
    ts: str
    window: str
    budget: float
    alert: str = "alert"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(F.window(self.ts, self.window).alias("w")).agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(self.alert), F.lit(0)).cast("long").alias("n_alerts"))
        entries = counts.select(F.col("w.start").alias("window_start"), "n", "n_alerts")
        entries.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def entries(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(ENTRIES).parquet(self.path)

    def per_batch(self, spark: SparkSession) -> DataFrame:
        """Each micro-batch against the budget; batches without rows are not listed."""
        return self._against_budget(self.entries(spark).groupBy("batch_id"))

    def per_window(self, spark: SparkSession) -> DataFrame:
        """Each window against the budget, whatever batches its rows came in."""
        return self._against_budget(self.entries(spark).groupBy("window_start"))

    def _against_budget(self, grouped) -> DataFrame:
        share = F.col("n_alerts") / F.col("n")
        return grouped.agg(F.sum("n").alias("n"), F.sum("n_alerts").alias("n_alerts")) \
            .withColumn("share", share).withColumn("over_budget", F.col("share") > self.budget)
