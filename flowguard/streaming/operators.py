"""Streaming forms of the flow operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.operators.flows import unify_flows
from flowguard.operators.heavy import key_sketch, merged_sketch, salts_from
from flowguard.operators.joins import lookup_flows
from flowguard.operators.segments import (SEGMENT_SECONDS, PacketColumns, flow_segments,
                                          flow_sessions_native)
from flowguard.plans.cascade import cascade_decision
from flowguard.session import shared_dir
from flowguard.streaming.ledger import AlertLedger
from flowguard.streaming.runner import start

WATERMARK = "10 minutes"


def stream_segments(packets: DataFrame, c: PacketColumns, segment_seconds: int = SEGMENT_SECONDS,
                    watermark: str = WATERMARK) -> DataFrame:
    """Clock-aligned segments. State is bounded by the watermark; later packets are dropped."""
    return flow_segments(packets.withWatermark(c.ts, watermark), c, segment_seconds)


def stream_sessions(packets: DataFrame, c: PacketColumns, gap_seconds: int,
                    watermark: str = WATERMARK) -> DataFrame:
    """Flow sessions; a session is final once the watermark passes its end. Sessions of a batch are
    merged inside the tasks first, so that a large flow does not meet packet by packet."""
    packets.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return flow_sessions_native(packets.withWatermark(c.ts, watermark), gap_seconds, c)


def stream_unify(segments: DataFrame, classes: list[str], **options) -> DataFrame:
    """Running flow records. State has one entry per flow and grows with their number; use
    ``records.stream_flow_records`` where it has to stay bounded."""
    return unify_flows(segments, classes=classes, **options)


def stream_scores(packets: DataFrame, stage1: PipelineModel, keep: list[str], key: str = "flow_id") -> DataFrame:
    """Arriving packets scored by a frozen detector: a map, without state."""
    if any(s.hasParam("stats") and s.getOrDefault("stats") != "fit" for s in stage1.stages):
        raise ValueError("a stream needs a detector with frozen statistics (stats='fit')")
    return stage1.transform(packets).select(*keep, key, "anomaly_score", "alert")


@dataclass
class CascadeWriter:
    """Confirms the alerts of every micro-batch from a table of flow probabilities (one row per
    flow) and writes the decided packets to a folder of the batch.

    Heavy keys are known from the batch itself and from a sketch of all batches before, which is
    handed on from batch to batch; their packets are salted in proportion and only their flow rows
    are repeated. A batch that is run again reads the sketch its predecessor left and writes the
    same folders. ``ledger`` gets the decided packets of each batch.
    """

    path: str
    flow_proba: DataFrame
    threshold: float
    key: str = "flow_id"
    spread_by: str | None = None
    ledger: AlertLedger | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            spark = batch.sparkSession
            parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
            own = stored(key_sketch(batch.where(F.col(self.key).isNotNull()), self.key, parts), f"{self.path}/own/{batch_id}")
            known = own
            if batch_id:
                carried = spark.read.schema(own.schema).parquet(f"{self.path}/carried/{batch_id - 1}")
                known = merged_sketch(own.unionByName(carried), parts)
            known = stored(known, f"{self.path}/carried/{batch_id}")
            salts = salts_from(known, parts)
            for k, n in salts_from(own, parts).items():
                salts[k] = max(n, salts.get(k, 1))
            flows = self.flow_proba.select(self.key, "proba")
            decided = cascade_decision(lookup_flows(batch, flows, self.key, salts=salts, spread_by=self.spread_by), self.threshold)
            out = stored(decided, f"{self.path}/decided/batch_id={batch_id}")
            if self.ledger:
                self.ledger.write(out, batch_id)
        finally:
            batch.unpersist()


def stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_cascade(scores: DataFrame, flow_proba: DataFrame, threshold: float, key: str = "flow_id",
                spread_by: str | None = None, ledger: AlertLedger | None = None) -> DataFrame:
    """Run the cascade over the scores that are there, and return all decided packets."""
    spark = scores.sparkSession
    work = shared_dir(spark, "cascade")
    start(scores, CascadeWriter(work, flow_proba, threshold, key, spread_by, ledger), "append", work).awaitTermination()
    return spark.read.parquet(f"{work}/decided").drop("batch_id")


def alert_share(decided: DataFrame, ts: str, window: str, budget: float, alert: str = "alert") -> DataFrame:
    """Alerts per time window against the budget."""
    grouped = decided.groupBy(F.window(ts, window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(alert).alias("n_alerts"), F.avg(alert).alias("share"))
    return grouped.select(F.col("w.start").alias("window_start"), "n", "n_alerts", "share",
                          (F.col("share") > budget).alias("over_budget"))
