"""Keyed lookups between packets and flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.operators.heavy import key_salts, salt_count


def lookup_flows(packets: DataFrame, flows: DataFrame, key: str = "flow_id", prefix: str = "flow_",
                 salts: dict | None = None, spread_by: str | None = None) -> DataFrame:
    """Left join of every packet to its flow, with ``have_flow``.

    ``flows`` has one row per key. Its columns that also occur in ``packets`` get the prefix
    ``flow_``. ``salts`` names the heavy keys and into how many parts the packets of each go, in
    proportion to their number (``heavy.key_salts``, which is the default and costs a pass); only
    the flow rows of those keys are repeated, as often as their key has parts, so a key with a third
    of all packets does not end in one task. The part comes from the packet's
    partition and, if named, the ``spread_by`` column: never from its position, which may change when
    a lost task is run again. Whether to broadcast is left to the optimizer's size check.
    """
    if salts is None:
        salts = key_salts(packets, key)
    clash = [c for c in flows.columns if c in packets.columns and c != key]
    right = flows.withColumnsRenamed({c: prefix + c for c in clash})
    right = right.withColumn("have_flow", F.lit(True))
    if not salts:
        joined = packets.join(right, key, "left")
    else:
        n = salt_count(F.col(key), salts, packets.schema[key].dataType)
        place = F.spark_partition_id().cast("bigint") + (F.shiftright(F.xxhash64(spread_by), 1) if spread_by else F.lit(0))
        left = packets.withColumn("_salt", F.pmod(place, n).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1)))
        joined = left.join(right, [key, "_salt"], "left").drop("_salt")
    return joined.withColumn("have_flow", F.coalesce("have_flow", F.lit(False)))


def flagged_lookup(packets: DataFrame, flows: DataFrame, alert: str = "alert",
                   key: str = "flow_id", **options) -> DataFrame:
    """The lookup for alerts only, which is all the second stage needs."""
    return lookup_flows(packets.where(F.col(alert) == 1), flows, key, **options)


def unmatched(looked_up: DataFrame) -> DataFrame:
    """Number of packets and of packets without a flow record."""
    return looked_up.agg(F.count(F.lit(1)).alias("n_packets"),
                         F.count_if(~F.col("have_flow")).alias("n_unmatched"))


def without_test_flows(flows: DataFrame, test_packets: DataFrame, key: str = "flow_id") -> DataFrame:
    """Leakage guard: flows whose id occurs in the packet test set are removed."""
    return flows.join(test_packets.select(key).distinct(), key, "left_anti")
