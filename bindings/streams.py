"""Segments, sessions and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import LINE_CLASSES, SEGMENTS_SQL, events, query, rounded
from flowguard.operators.segments import (PacketColumns, flow_segments, flow_segments_relative,
                                          flow_sessions)
from flowguard.operators.thresholds import alerts, budget_threshold
from flowguard.session import shared_dir
from flowguard.sources.tables import read_table
from flowguard.streaming.ledger import AlertLedger
from flowguard.streaming.operators import run_cascade, stream_segments, stream_sessions, stream_unify
from flowguard.streaming.records import stream_flow_records
from flowguard.streaming.runner import replay, run_append, run_update, start, stream_table

# Gaps inside a user's events are hours long, so segments of a day and slices of a week.
DAY = 86_400
COLUMNS = PacketColumns("user_id", "ts", "value")

STATS_SQL = """
       count(*) AS total_packets, round(sum(value), 2) + 0.0 AS total_bytes,
       round(avg(value), 6) + 0.0 AS pkt_len_mean, round(stddev_pop(value), 6) + 0.0 AS pkt_len_std,
       min(value) + 0.0 AS pkt_len_min, max(value) + 0.0 AS pkt_len_max,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) + 0.0 AS flow_duration,
       round(count(*) / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0), 6) + 0.0 AS flow_packets_per_s,
       CAST(max(CAST(event_type <> 'view' AS INTEGER)) AS INTEGER) AS "Label"
"""


def _tidy(t, *keys):
    """Comparable columns: rounded doubles and times as microseconds."""
    def micros(c):
        return F.unix_micros(F.col(c).cast("timestamp")).alias(c + "_us")

    return t.select(
        "user_id", *[micros(k) if k.endswith("start") else F.col(k) for k in keys], "total_packets",
        rounded("total_bytes", 2).alias("total_bytes"),
        rounded("pkt_len_mean").alias("pkt_len_mean"), rounded("pkt_len_std").alias("pkt_len_std"),
        (F.col("pkt_len_min") + F.lit(0.0)).alias("pkt_len_min"),
        (F.col("pkt_len_max") + F.lit(0.0)).alias("pkt_len_max"),
        rounded("flow_duration").alias("flow_duration"),
        rounded("flow_packets_per_s").alias("flow_packets_per_s"), "Label")


CLOCK_SQL = """
SELECT user_id, epoch_us(date_trunc('day', ts)) AS segment_start_us,""" + STATS_SQL + """
FROM events GROUP BY user_id, date_trunc('day', ts)"""


@query("flow_segments", CLOCK_SQL)
def _flow_segments(spark, sf):
    return _tidy(flow_segments(events(spark, sf), COLUMNS, DAY), "segment_start")


@query("flow_segments_stream", CLOCK_SQL)
def _flow_segments_stream(spark, sf):
    raw = stream_table(spark, sf, "events.parquet")
    stream = raw.select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "value",
                        (F.col("event_type") != "view").cast("int").alias("Label"))
    done = run_update(stream_segments(stream, COLUMNS, DAY), ["user_id", "segment_start"], "segments")
    return _tidy(done, "segment_start")


@query("flow_segments_relative", """
WITH p AS (SELECT *, CAST(least(floor((epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY user_id))) / 86400e6), 4) AS INTEGER)
                  AS segment_index,
                  epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS gap FROM events)
SELECT user_id, segment_index, avg(gap) / 1e6 AS iat_mean, round(stddev_pop(gap) / 1e6, 3) + 0.0 AS iat_std,"""
       + STATS_SQL + "FROM p GROUP BY user_id, segment_index")
def _flow_segments_relative(spark, sf):
    done = flow_segments_relative(events(spark, sf), COLUMNS, DAY, slice_seconds=7 * DAY)
    done = done.withColumn("iat_std", rounded("iat_std", 3))
    return _tidy(done, "segment_index", "iat_mean", "iat_std")


SESSIONS_SQL = """
WITH g AS (SELECT *, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) > 43200e6, true) AS starts
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(CAST(starts AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts) AS num FROM g)
SELECT user_id, epoch_us(min(ts)) AS session_start_us,""" + STATS_SQL + "FROM s GROUP BY user_id, num"


@query("flow_sessions", SESSIONS_SQL)
def _flow_sessions(spark, sf):
    return _tidy(flow_sessions(events(spark, sf), DAY // 2, COLUMNS, slice_seconds=7 * DAY), "session_start")


@query("stream_unify", "WITH " + SEGMENTS_SQL + """
SELECT flow_id, total_packets, round(flow_duration, 2) + 0.0 AS flow_duration, round(pkt_len_mean, 6) + 0.0 AS pkt_len_mean,
       flow_packets_per_s + 0.0 AS flow_packets_per_s, "Label", n_segments, attack_type FROM uni""")
def _stream_unify(spark, sf):
    raw = stream_table(spark, sf, "lineitem.parquet")
    stream = raw.select(
        F.col("l_orderkey").alias("flow_id"), F.col("l_quantity").alias("total_packets"),
        F.col("l_extendedprice").alias("flow_duration"), F.col("l_discount").alias("pkt_len_mean"),
        F.col("l_tax").alias("flow_packets_per_s"), F.col("l_returnflag").alias("attack_type"),
        (F.col("l_returnflag") != "N").cast("int").alias("Label"))
    done = run_update(stream_unify(stream, LINE_CLASSES.classes, taxonomy=LINE_CLASSES), ["flow_id"], "unify")
    return done.select(
        "flow_id", "total_packets", rounded("flow_duration", 2).alias("flow_duration"),
        rounded("pkt_len_mean").alias("pkt_len_mean"),
        (F.col("flow_packets_per_s") + F.lit(0.0)).alias("flow_packets_per_s"), "Label", "n_segments", "attack_type")


# -- streams of several micro-batches ---------------------------------------------------------

#: Micro-batches of a replayed table.
BATCHES = 5


@query("flow_sessions_stream", SESSIONS_SQL)
def _flow_sessions_stream(spark, sf):
    """Sessions as they close: the state of five batches, each file one, a closing row at the end."""
    t = events(spark, sf).select("ts", "user_id", "value", "Label")
    stream = stream_table(spark, replay(t, "ts", BATCHES, "packets", "30 DAYS"), "*.parquet", t.schema, 1)
    return _tidy(run_append(stream_sessions(stream, COLUMNS, DAY // 2, "1 hour"), "sessions"), "session_start")


#: Days without a segment after which a flow record is closed.
IDLE_DAYS = 365

RECORDS_SQL = f"""
WITH g AS (
  SELECT *, coalesce(epoch_us(l_shipdate) - epoch_us(lag(l_shipdate) OVER w) > {IDLE_DAYS * DAY * 1_000_000}, true) AS starts
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate)),
s AS (SELECT *, sum(CAST(starts AS INTEGER)) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate) AS num FROM g),
c AS (
  SELECT l_orderkey, num, l_returnflag, row_number() OVER (PARTITION BY l_orderkey, num ORDER BY count(*) DESC, l_returnflag) AS place
  FROM s GROUP BY l_orderkey, num, l_returnflag)
SELECT s.l_orderkey AS flow_id, epoch_us(min(l_shipdate)) AS start_us, epoch_us(max(l_shipdate)) AS end_us,
       min(l_partkey) AS l_partkey, sum(l_quantity) + 0.0 AS total_packets, round(sum(l_extendedprice), 2) + 0.0 AS flow_duration,
       round(avg(l_discount), 6) + 0.0 AS pkt_len_mean, max(l_tax) + 0.0 AS flow_packets_per_s,
       CAST(max(CAST(s.l_returnflag <> 'N' AS INTEGER)) AS INTEGER) AS "Label", count(*) AS n_segments, min(c.l_returnflag) AS attack_type,
       CAST(max(CAST(s.l_returnflag <> 'N' AS INTEGER)) = 1 AND min(c.l_returnflag) = 'N' AS INTEGER) AS label_conflict
FROM s JOIN c ON c.l_orderkey = s.l_orderkey AND c.num = s.num AND c.place = 1 GROUP BY s.l_orderkey, s.num
"""


@query("stream_flow_records", RECORDS_SQL)
def _stream_flow_records(spark, sf):
    """Flow records that leave when idle, from segments in the order of their ship date."""
    t = read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("flow_id"), "l_partkey", F.col("l_quantity").alias("total_packets"),
        F.col("l_extendedprice").alias("flow_duration"), F.col("l_discount").alias("pkt_len_mean"),
        F.col("l_tax").alias("flow_packets_per_s"), F.col("l_returnflag").alias("attack_type"),
        (F.col("l_returnflag") != "N").cast("int").alias("Label"), F.col("l_shipdate").cast("timestamp").alias("ts"))
    stream = stream_table(spark, replay(t, "ts", BATCHES, "segments", f"{2 * IDLE_DAYS} DAYS"), "*.parquet", t.schema, 1)
    done = run_append(stream_flow_records(stream, "ts", IDLE_DAYS * DAY, LINE_CLASSES.classes, id_columns=("l_partkey",),
                                          taxonomy=LINE_CLASSES), "records")
    return done.select(
        "flow_id", F.unix_micros("record_start").alias("start_us"), F.unix_micros("record_end").alias("end_us"), "l_partkey",
        (F.col("total_packets") + F.lit(0.0)).alias("total_packets"), rounded("flow_duration", 2).alias("flow_duration"),
        rounded("pkt_len_mean").alias("pkt_len_mean"), (F.col("flow_packets_per_s") + F.lit(0.0)).alias("flow_packets_per_s"),
        "Label", "n_segments", "attack_type", "label_conflict")


@query("stream_batch_alerts", f"""
WITH t AS (SELECT quantile_cont(value, 0.8) AS cut, min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events),
d AS (SELECT CAST(value >= cut AS INTEGER) AS alert, (epoch_us(ts) - low) // ((high - low) // {BATCHES} + 1) AS batch,
             epoch_us(date_trunc('day', ts)) AS day FROM events, t),
g AS (SELECT 'batch' AS scope, CAST(batch AS BIGINT) AS place, count(*) AS n, CAST(sum(alert) AS BIGINT) AS n_alerts FROM d GROUP BY batch
      UNION ALL SELECT 'window', day, count(*), CAST(sum(alert) AS BIGINT) FROM d GROUP BY day)
SELECT scope, place, n, n_alerts, round(n_alerts / n, 6) + 0.0 AS share, n_alerts / n > 0.2 AS over_budget FROM g""")
def _stream_batch_alerts(spark, sf):
    """Alerts of each micro-batch and of each day against the budget, from the ledger."""
    t = events(spark, sf).select("ts", "value")
    cut = budget_threshold(t, "value", 0.2)
    stream = stream_table(spark, replay(t, "ts", BATCHES, "packets"), "*.parquet", t.schema, 1)
    work = shared_dir(spark, "ledger")
    ledger = AlertLedger(f"{work}/entries", "ts", "1 day", 0.2)
    start(alerts(stream, "value", cut), ledger.write, "append", work).awaitTermination()

    def rows(df, scope, place):
        return df.select(F.lit(scope).alias("scope"), place.cast("long").alias("place"), "n", "n_alerts",
                         rounded("share").alias("share"), "over_budget")

    return rows(ledger.per_batch(spark), "batch", F.col("batch_id")).unionByName(
        rows(ledger.per_window(spark), "window", F.unix_micros("window_start")))


@query("stream_lookup_decisions", """
WITH t AS (SELECT quantile_cont(o_totalprice, 0.8) AS cut FROM orders),
d AS (SELECT o_orderkey AS packet_id, o_custkey, CAST(o_totalprice >= cut AS INTEGER) AS alert,
             c_custkey IS NOT NULL AS have_flow, round((c_acctbal + 1000) / 11000, 6) AS proba
      FROM orders CROSS JOIN t LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 10 <> 3)
SELECT packet_id, alert, have_flow, CAST(CASE WHEN have_flow AND alert = 1 THEN proba >= 0.5 ELSE alert = 1 END AS INTEGER) AS combined FROM d""")
def _stream_lookup_decisions(spark, sf):
    """The streaming cascade with given scores: orders as packets, customers as flows."""
    orders = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("packet_id"), F.col("o_custkey").alias("flow_id"), "o_totalprice",
        F.col("o_orderdate").cast("timestamp").alias("ts"))
    cut = budget_threshold(orders, "o_totalprice", 0.2)
    customers = read_table(spark, sf, "customer").where("c_custkey % 10 <> 3").select(
        F.col("c_custkey").alias("flow_id"), F.round((F.col("c_acctbal") + 1000) / 11000, 6).alias("proba"))
    stream = stream_table(spark, replay(orders, "ts", BATCHES, "packets"), "*.parquet", orders.schema, 1)
    decided = run_cascade(alerts(stream, "o_totalprice", cut), customers, 0.5, spread_by="packet_id")
    return decided.select("packet_id", "alert", "have_flow", "combined")
