"""Sources, scalar functions, preprocessing and union."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import (EVENT_CLASSES, EVENTS_SQL, GAPPY_SQL, events, gappy_events, packets, query,
                           rounded, segments)
from flowguard.functions.cleaning import clean_numeric, flow_key
from flowguard.functions.labels import canonical_class, normalize_labels
from flowguard.models.preprocess import Preprocessor
from flowguard.operators.keys import union_by_name
from flowguard.operators.segments import ffill_by_key
from flowguard.operators.thresholds import alerts, budget_threshold
from flowguard.session import shared_dir
from flowguard.sources.csv_dirs import scan_labelled_dir
from flowguard.sources.tables import read_table
from flowguard.taxonomy import TRAFFIC

EVENT_RULES = tuple((c, ((c,),)) for c in EVENT_CLASSES.classes)


def _events_as_csv(spark, sf, parts: list[str]) -> str:
    """The events as CSV files below folders named after their class."""
    folder = shared_dir(spark, "csv")
    t = read_table(spark, sf, "events").withColumn("bucket", F.col("event_id") % 8)
    t = t.withColumn("ts", F.col("ts").cast("string")).withColumn("class", F.col("event_type"))
    t.drop("props", "event_type").repartition(*parts).write.partitionBy(*parts).option("header", True).csv(folder)
    return folder


@query("scan_labelled_dir", """
SELECT event_id, user_id, value, ts, event_type AS attack_type,
       CAST(event_type <> 'view' AS INTEGER) AS "Label" FROM events""")
def _scan_labelled_dir(spark, sf):
    scanned = scan_labelled_dir(spark, _events_as_csv(spark, sf, ["class", "bucket"]), EVENT_CLASSES,
                                EVENT_RULES, with_key=False)
    return scanned.select(F.col("event_id").cast("bigint").alias("event_id"),
                          F.col("user_id").cast("bigint").alias("user_id"),
                          F.col("value").cast("double").alias("value"),
                          F.col("ts").cast("timestamp_ntz").alias("ts"), "attack_type", "Label")


@query("scan_row_cap", """
SELECT event_type AS attack_type, event_id % 8 AS bucket, least(count(*), 150) AS n_rows
FROM events GROUP BY ALL""")
def _scan_row_cap(spark, sf):
    scanned = scan_labelled_dir(spark, _events_as_csv(spark, sf, ["class", "bucket"]), EVENT_CLASSES,
                                EVENT_RULES, max_rows=150, with_key=False, keep_source=True)
    bucket = F.regexp_extract("_file", r"bucket=(\d+)", 1).cast("bigint")
    return scanned.groupBy("attack_type", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("flow_key", """
WITH raw AS (
  SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE ' 10.0.0.' || l_suppkey END AS src_ip,
         CASE WHEN l_linestatus = 'O' THEN 'x' ELSE (l_partkey % 1000) || '.0' END AS src_port,
         '10.0.0.' || (l_orderkey % 200) AS dst_ip, CAST(l_linenumber AS VARCHAR) AS dst_port FROM lineitem),
ends AS (
  SELECT coalesce(trim(src_ip), 'na') || ':' ||
         coalesce(CAST(CAST(TRY_CAST(src_port AS DOUBLE) AS BIGINT) AS VARCHAR), '-1') AS a,
         dst_ip || ':' || dst_port AS b FROM raw)
SELECT CASE WHEN a > b THEN b || '-' || a ELSE a || '-' || b END AS flow_id, count(*) AS n
FROM ends GROUP BY 1""")
def _flow_key(spark, sf):
    t = read_table(spark, sf, "lineitem")
    src_ip = F.when(F.col("l_linenumber") != 7, F.concat(F.lit(" 10.0.0."), "l_suppkey"))
    src_port = F.when(F.col("l_linestatus") == "O", "x").otherwise(
        F.concat((F.col("l_partkey") % 1000).cast("string"), F.lit(".0")))
    dst_ip = F.concat(F.lit("10.0.0."), (F.col("l_orderkey") % 200).cast("string"))
    key = flow_key(src_ip, src_port, dst_ip, F.col("l_linenumber").cast("string"))
    return t.groupBy(key.alias("flow_id")).agg(F.count(F.lit(1)).alias("n"))


@query("clean_numeric", """
SELECT l_linenumber, count(*) AS n, count(*) FILTER (l_linenumber <= 3) AS n_missing,
       round(sum(CASE WHEN l_linenumber > 3 THEN l_extendedprice END), 2) + 0.0 AS total
FROM lineitem GROUP BY l_linenumber""")
def _clean_numeric(spark, sf):
    number = F.col("l_linenumber")
    x = (F.when(number == 1, F.lit(float("nan"))).when(number == 2, F.lit(float("inf")))
          .when(number == 3, F.lit(float("-inf"))).otherwise(F.col("l_extendedprice")))
    t = clean_numeric(read_table(spark, sf, "lineitem").withColumn("x", x), ["x"])
    return t.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("x").isNull()).alias("n_missing"),
        rounded(F.sum("x"), 2).alias("total"))


@query("canonical_label", """
WITH paths AS (
  SELECT CASE event_type
           WHEN 'view' THEN CASE WHEN user_id % 2 = 0 THEN 'Benign/BenignTraffic' ELSE 'Normal day' END
           WHEN 'click' THEN CASE WHEN user_id % 2 = 0 THEN 'DDoS/DDoS-HTTP_Flood' ELSE 'DoS/dos-http' END
           WHEN 'error' THEN CASE WHEN user_id % 2 = 0 THEN 'Spoofing/DNS' ELSE 'abnormal/Mirai' END
           WHEN 'purchase' THEN 'Web-Based/XSS' ELSE 'BruteForce/' || event_type END AS path
  FROM events)
SELECT path,
       CASE path WHEN 'Benign/BenignTraffic' THEN 'Benign' WHEN 'Normal day' THEN 'Benign'
            WHEN 'DDoS/DDoS-HTTP_Flood' THEN 'DDoS-HTTP_Flood' WHEN 'DoS/dos-http' THEN 'DoS-HTTP_Flood'
            WHEN 'Spoofing/DNS' THEN 'DNS_Spoofing' WHEN 'Web-Based/XSS' THEN 'XSS'
            WHEN 'BruteForce/signup' THEN 'Brute_Force' END AS attack_type, count(*) AS n
FROM paths GROUP BY ALL""")
def _canonical_label(spark, sf):
    even, kind = F.col("user_id") % 2 == 0, F.col("event_type")
    path = (F.when(kind == "view", F.when(even, "Benign/BenignTraffic").otherwise("Normal day"))
             .when(kind == "click", F.when(even, "DDoS/DDoS-HTTP_Flood").otherwise("DoS/dos-http"))
             .when(kind == "error", F.when(even, "Spoofing/DNS").otherwise("abnormal/Mirai"))
             .when(kind == "purchase", "Web-Based/XSS").otherwise(F.concat(F.lit("BruteForce/"), kind)))
    t = read_table(spark, sf, "events").select(path.alias("path"))
    return t.groupBy("path", canonical_class(F.col("path")).alias("attack_type")).agg(F.count(F.lit(1)).alias("n"))


@query("normalize_labels", """
WITH t AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'F' THEN 'Benign'
              WHEN o_orderstatus = 'O' THEN 'DoS-HTTP_Flood' ELSE 'Recon' END AS attack_type FROM orders)
SELECT attack_type, CAST(attack_type <> 'Benign' AS INTEGER) AS "Label", count(*) AS n FROM t GROUP BY ALL""")
def _normalize_labels(spark, sf):
    status = F.col("o_orderstatus")
    text = F.when(status == "F", "benign traffic").when(status == "O", "DoS http").otherwise("Recon")
    t = read_table(spark, sf, "orders").select(F.when(F.col("o_orderpriority") != "5-LOW", text).alias("Class"))
    return normalize_labels(t, TRAFFIC).groupBy("attack_type", "Label").agg(F.count(F.lit(1)).alias("n"))


@query("event_features", """
SELECT event_id, user_id, value, TRY_CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS DOUBLE) AS k
FROM events""")
def _event_features(spark, sf):
    return events(spark, sf).select("event_id", "user_id", "value", "k")


# -- preprocessing: the steps one by one, then together -------------------------------------

BOUNDS_SQL = "WITH " + GAPPY_SQL + """,
q AS (SELECT quantile_cont(value, 0.01) AS lv, quantile_cont(value, 0.99) AS hv,
             quantile_cont(k, 0.01) AS lk, quantile_cont(k, 0.99) AS hk FROM gap),
clip AS (
  SELECT event_id, CASE WHEN value IS NOT NULL THEN greatest(lv, least(hv, value)) END AS value,
         CASE WHEN k IS NOT NULL THEN greatest(lk, least(hk, k)) END AS k FROM gap, q),
med AS (SELECT quantile_cont(value, 0.5) AS mv, quantile_cont(k, 0.5) AS mk FROM clip),
imp AS (SELECT event_id, coalesce(value, mv) AS value, coalesce(k, mk) AS k FROM clip, med)
"""
SCALE_SQL = """
SELECT event_id, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) + 0.0 AS value,
       round((k - avg(k) OVER ()) / stddev_pop(k) OVER (), 6) + 0.0 AS k FROM """


def _fitted(spark, sf, **options):
    t = gappy_events(spark, sf).select("event_id", "value", "k").persist()
    return t, Preprocessor(inputCols=["value", "k"], **options).fit(t)


def _two(t, columns):
    return t.select("event_id", rounded(columns["value"]).alias("value"), rounded(columns["k"]).alias("k"))


@query("robust_clip", BOUNDS_SQL + "SELECT event_id, round(value, 6) + 0.0 AS value, round(k, 6) + 0.0 AS k FROM clip")
def _robust_clip(spark, sf):
    t, model = _fitted(spark, sf)
    return _two(t, model.clipped(t))


@query("median_impute", BOUNDS_SQL + "SELECT event_id, round(value, 6) + 0.0 AS value, round(k, 6) + 0.0 AS k FROM imp")
def _median_impute(spark, sf):
    t, model = _fitted(spark, sf)
    return _two(t, model.imputed(t))


@query("standard_scale", "WITH " + GAPPY_SQL + """,
raw AS (SELECT event_id, value, coalesce(k, (SELECT quantile_cont(k, 0.5) FROM gap)) AS k FROM gap)
""" + SCALE_SQL + "raw")
def _standard_scale(spark, sf):
    t, model = _fitted(spark, sf, clip=False)
    return _two(t, model.scaled(t))


@query("preprocess", BOUNDS_SQL + SCALE_SQL + "imp")
def _preprocess(spark, sf):
    t, model = _fitted(spark, sf)
    return _two(t, model.scaled(t))


@query("ffill_by_key", "WITH " + GAPPY_SQL + """
SELECT event_id, user_id,
       coalesce(last_value(k IGNORE NULLS) OVER w,
                first_value(k IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS k
FROM gap WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def _ffill_by_key(spark, sf):
    t = clean_numeric(gappy_events(spark, sf), ["k"])
    filled = ffill_by_key(t, "user_id", "ts", ["k"], "event_id", slice_seconds=86_400)
    return filled.select("event_id", "user_id", "k")


@query("alerts", "WITH " + EVENTS_SQL + """
SELECT event_id, CAST(value >= (SELECT quantile_cont(value, 0.8) FROM ev) AS INTEGER) AS alert FROM ev""")
def _alerts(spark, sf):
    t = events(spark, sf)
    return alerts(t, "value", budget_threshold(t, "value", 0.2)).select("event_id", "alert")


@query("union_by_name", """
SELECT attack_type, "Label", count(*) AS n, count(packet_length) AS n_length, count(value) AS n_value
FROM (SELECT o_orderstatus AS attack_type, CAST(o_orderstatus <> 'O' AS INTEGER) AS "Label",
             o_totalprice AS packet_length, NULL::DOUBLE AS value FROM orders
      UNION ALL SELECT event_type, CAST(event_type <> 'view' AS INTEGER), NULL, value FROM events
      UNION ALL SELECT l_returnflag, CAST(l_returnflag <> 'N' AS INTEGER), NULL, NULL FROM lineitem)
GROUP BY ALL""")
def _union_by_name(spark, sf):
    together = union_by_name([packets(spark, sf), events(spark, sf), segments(spark, sf)])
    return together.groupBy("attack_type", "Label").agg(
        F.count(F.lit(1)).alias("n"), F.count("packet_length").alias("n_length"),
        F.count("value").alias("n_value"))
