"""Lookup joins and flow aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import (LINE_CLASSES, PACKETS_SQL, SEGMENTS_SQL, UNIFY_OPTIONS, packets, query, rounded,
                           segments)
from flowguard.operators.flows import majority_class, segment_stats, unify_flows
from flowguard.operators.joins import flagged_lookup, lookup_flows, unmatched, without_test_flows
from flowguard.operators.metrics import per_class_detection
from flowguard.operators.sampling import split_by_key
from flowguard.operators.thresholds import alerts, budget_threshold


def unified(spark, sf):
    return unify_flows(segments(spark, sf), taxonomy=LINE_CLASSES, **UNIFY_OPTIONS)


UNIFIED_SQL = "WITH " + SEGMENTS_SQL


@query("unify_flows", UNIFIED_SQL + """
SELECT flow_id, total_packets, round(flow_duration, 2) + 0.0 AS flow_duration,
       round(pkt_len_mean, 6) + 0.0 AS pkt_len_mean, flow_packets_per_s + 0.0 AS flow_packets_per_s, "Label",
       n_segments, l_partkey, l_suppkey, attack_type, label_conflict FROM uni""")
def _unify_flows(spark, sf):
    return unified(spark, sf).withColumns({
        "flow_duration": rounded("flow_duration", 2), "pkt_len_mean": rounded("pkt_len_mean"),
        "flow_packets_per_s": F.col("flow_packets_per_s") + F.lit(0.0)})


@query("unify_flows_inferred", """
WITH firsts AS (
  SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS r
  FROM lineitem)
SELECT l_orderkey AS flow_id, sum(l_quantity) AS duration, round(avg(l_extendedprice), 6) + 0.0 AS "Average Packet Size",
       round(avg(l_discount), 6) + 0.0 AS "Down/Up Ratio", max(l_tax) + 0.0 AS "Fwd Max",
       round(min(l_extendedprice), 2) + 0.0 AS min_len, round(sum(l_extendedprice), 2) + 0.0 AS "Total Length",
       any_value(f.l_partkey) AS l_partkey, max(CAST(l_returnflag <> 'N' AS INTEGER)) AS "Label", count(*) AS n_segments
FROM lineitem JOIN firsts f USING (l_orderkey) WHERE f.r = 1 GROUP BY l_orderkey""")
def _unify_flows_inferred(spark, sf):
    price = F.col("flow_duration")
    t = segments(spark, sf).select(
        "flow_id", "l_linenumber", "l_partkey", "Label", "attack_type",
        F.col("total_packets").alias("duration"), price.alias("Average Packet Size"),
        F.col("pkt_len_mean").alias("Down/Up Ratio"), F.col("flow_packets_per_s").alias("Fwd Max"),
        price.alias("min_len"), price.alias("Total Length"))
    out = unify_flows(t, policy={}, order="l_linenumber", id_columns=("l_partkey",), skip=("l_linenumber",),
                      classes=LINE_CLASSES.classes, taxonomy=LINE_CLASSES)
    return out.select(
        "flow_id", "duration", rounded("Average Packet Size").alias("Average Packet Size"),
        rounded("Down/Up Ratio").alias("Down/Up Ratio"), (F.col("Fwd Max") + F.lit(0.0)).alias("Fwd Max"),
        rounded("min_len", 2).alias("min_len"), rounded("Total Length", 2).alias("Total Length"),
        "l_partkey", "Label", "n_segments")


@query("majority_class", UNIFIED_SQL + "SELECT flow_id, attack_type FROM uni")
def _majority_class(spark, sf):
    return majority_class(segments(spark, sf))


@query("segment_stats", """
SELECT count(*) AS n_unified_flows, count(*) FILTER (n > 1) AS multi_segment_flows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)""")
def _segment_stats(spark, sf):
    return segment_stats(unified(spark, sf))


LOOKUP_SQL = "WITH " + PACKETS_SQL + "," + SEGMENTS_SQL


@query("packet_flow_lookup", LOOKUP_SQL + """
SELECT p.packet_id, p.attack_type, u.attack_type AS flow_attack_type, u.n_segments,
       u.total_packets, u.flow_id IS NOT NULL AS have_flow
FROM pkt p LEFT JOIN uni u ON u.flow_id = p.flow_id""")
def _packet_flow_lookup(spark, sf):
    return lookup_flows(packets(spark, sf), unified(spark, sf), spread_by="packet_id").select(
        "packet_id", "attack_type", "flow_attack_type", "n_segments", "total_packets", "have_flow")


@query("unmatched_packets", """
SELECT count(*) AS n_packets,
       count(*) FILTER (NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) AS n_unmatched
FROM orders""")
def _unmatched_packets(spark, sf):
    flows = unified(spark, sf).select("flow_id", "n_segments")
    return unmatched(lookup_flows(packets(spark, sf), flows, spread_by="packet_id"))


@query("flagged_lookup", LOOKUP_SQL + """
SELECT p.packet_id, u.n_segments, u.flow_id IS NOT NULL AS have_flow
FROM pkt p LEFT JOIN uni u ON u.flow_id = p.flow_id
WHERE p.packet_length >= (SELECT quantile_cont(packet_length, 0.8) FROM pkt)""")
def _flagged_lookup(spark, sf):
    p = packets(spark, sf)
    flagged = alerts(p, "packet_length", budget_threshold(p, "packet_length", 0.2))
    return flagged_lookup(flagged, unified(spark, sf), spread_by="packet_id").select("packet_id", "n_segments", "have_flow")


@query("leakage_guard", LOOKUP_SQL + """
SELECT flow_id, n_segments FROM uni WHERE flow_id NOT IN (
  SELECT flow_id FROM pkt WHERE CAST('0x' || substr(md5('42|' || flow_id), 1, 8) AS BIGINT) / 4294967296.0 >= 0.7)""")
def _leakage_guard(spark, sf):
    split = split_by_key(packets(spark, sf), {"train": 0.7, "test": 0.3}, "flow_id", 42)
    test = split.where("split = 'test'")
    return without_test_flows(unified(spark, sf), test).select("flow_id", "n_segments")


@query("flow_alerts_by_class", UNIFIED_SQL + """,
flagged AS (SELECT attack_type, flow_duration >= (SELECT quantile_cont(flow_duration, 0.8) FROM uni) AS alert FROM uni)
SELECT c.attack_type, count(*) FILTER (f.alert) AS detected, count(f.attack_type) AS total,
       round(count(*) FILTER (f.alert) / count(f.attack_type), 6) AS detection_rate
FROM (VALUES ('A'), ('R')) c(attack_type) LEFT JOIN flagged f USING (attack_type) GROUP BY c.attack_type""")
def flow_alerts_by_class(spark, sf):
    """Flagship: unify the flows, flag the longest fifth, and rate the detection per class."""
    flows = unified(spark, sf).select("flow_duration", "attack_type").persist()
    flagged = alerts(flows, "flow_duration", budget_threshold(flows, "flow_duration", 0.2))
    rates = per_class_detection(flagged, "alert", classes=LINE_CLASSES.attacks)
    return rates.withColumn("detection_rate", F.round("detection_rate", 6))
