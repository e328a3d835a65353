"""How the operators meet the given tables: registry, table roles and rounding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.sources.tables import read_table
from flowguard.taxonomy import Taxonomy

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Roles of the tables: events are packets with a time, lineitem holds flow segments, orders
# are packets for the lookup.
EVENT_CLASSES = Taxonomy("view", ("click", "error", "purchase", "signup"))
LINE_CLASSES = Taxonomy("N", ("A", "R"))
ORDER_CLASSES = Taxonomy("O", ("F", "P"))


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can state it, the SQL of the same result."""
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f
    return add


def rounded(c: Column | str, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Packets: flow = user, class = event type, features value and k."""
    t = read_table(spark, sf, "events")
    return t.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value",
        F.get_json_object("props", "$.k").try_cast("double").alias("k"),
        F.col("event_type").alias("attack_type"), (F.col("event_type") != "view").cast("int").alias("Label"))


EVENTS_SQL = """
ev AS (
  SELECT event_id, ts, user_id, value,
         TRY_CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS DOUBLE) AS k,
         event_type AS attack_type, CAST(event_type <> 'view' AS INTEGER) AS "Label"
  FROM events)
"""


def gappy_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with k missing for errors, NaN and infinite for some users."""
    k = (F.when(F.col("attack_type") == "error", F.lit(None).cast("double"))
          .when(F.col("user_id") == 1, F.lit(float("nan")))
          .when(F.col("user_id") == 2, F.lit(float("inf"))).otherwise(F.col("k")))
    return events(spark, sf).withColumn("k", k)


GAPPY_SQL = EVENTS_SQL + """,
gap AS (
  SELECT event_id, ts, user_id, attack_type, "Label", value,
         CASE WHEN attack_type = 'error' OR user_id IN (1, 2) THEN NULL ELSE k END AS k
  FROM ev)
"""


def segments(spark: SparkSession, sf: str) -> DataFrame:
    """Flow segments: flow = order, class = return flag."""
    t = read_table(spark, sf, "lineitem")
    return t.select(
        F.col("l_orderkey").alias("flow_id"), "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").alias("total_packets"), F.col("l_extendedprice").alias("flow_duration"),
        F.col("l_discount").alias("pkt_len_mean"), F.col("l_tax").alias("flow_packets_per_s"),
        F.col("l_returnflag").alias("attack_type"), (F.col("l_returnflag") != "N").cast("int").alias("Label"))


UNIFY_OPTIONS = {"id_columns": ("l_partkey", "l_suppkey"), "skip": ("l_linenumber",),
                 "classes": LINE_CLASSES.classes}

SEGMENTS_SQL = """
seg AS (
  SELECT l_orderkey AS flow_id, l_linenumber, l_partkey, l_suppkey, l_quantity AS total_packets,
         l_extendedprice AS flow_duration, l_discount AS pkt_len_mean, l_tax AS flow_packets_per_s,
         l_returnflag AS attack_type, CAST(l_returnflag <> 'N' AS INTEGER) AS "Label"
  FROM lineitem),
cls AS (
  SELECT flow_id, attack_type,
         row_number() OVER (PARTITION BY flow_id ORDER BY count(*) DESC, attack_type) AS place
  FROM seg GROUP BY flow_id, attack_type),
uni AS (
  SELECT s.flow_id, s.total_packets, s.flow_duration, s.pkt_len_mean, s.flow_packets_per_s, s."Label",
         s.n_segments, s.l_partkey, s.l_suppkey, c.attack_type,
         CAST(s."Label" = 1 AND c.attack_type = 'N' AS INTEGER) AS label_conflict
  FROM (SELECT flow_id, sum(total_packets) AS total_packets, sum(flow_duration) AS flow_duration,
               avg(pkt_len_mean) AS pkt_len_mean, max(flow_packets_per_s) AS flow_packets_per_s,
               max("Label") AS "Label", count(*) AS n_segments,
               min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey
        FROM seg GROUP BY flow_id) s
  JOIN cls c ON c.flow_id = s.flow_id AND c.place = 1)
"""


def packets(spark: SparkSession, sf: str) -> DataFrame:
    """Packets for the lookup: flow = order key, class = order status."""
    t = read_table(spark, sf, "orders")
    return t.select(
        F.col("o_orderkey").alias("flow_id"), F.col("o_orderkey").alias("packet_id"), "o_custkey",
        F.col("o_totalprice").alias("packet_length"), F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
        F.col("o_orderstatus").alias("attack_type"), (F.col("o_orderstatus") != "O").cast("int").alias("Label"))


PACKETS_SQL = """
pkt AS (
  SELECT o_orderkey AS flow_id, o_orderkey AS packet_id, o_custkey, o_totalprice AS packet_length,
         o_orderdate AS "timestamp", o_orderstatus AS attack_type,
         CAST(o_orderstatus <> 'O' AS INTEGER) AS "Label"
  FROM orders)
"""
