"""Streams of several micro-batches: records, sessions, the cascade and its ledger."""

import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowguard.operators.segments import PacketColumns, flow_sessions
from flowguard.streaming.ledger import AlertLedger
from flowguard.streaming.operators import CascadeWriter, run_cascade, stream_sessions
from flowguard.streaming.records import stream_flow_records
from flowguard.streaming.runner import replay, run_append, start, stream_table
from flowguard.taxonomy import Taxonomy

START = dt.datetime(2024, 1, 1)
KINDS = Taxonomy("N", ("A", "R"))
SEGMENTS = ("flow_id string, ts timestamp, total_packets long, pkt_len_mean double, pkt_len_max double, src_port long, "
            "Label int, attack_type string")


@pytest.fixture(scope="module")
def rows():
    rng, out = random.Random(11), []
    for i in range(900):
        flow = "hot" if i % 3 == 0 else f"f{rng.randrange(25)}"
        kind = rng.choice(["N", "N", "A", "R", None])
        mean = rng.choice([None, rng.uniform(0, 9)])
        out.append((flow, START + dt.timedelta(seconds=rng.randrange(20_000)), rng.randrange(9), mean, float(rng.randrange(50)),
                    rng.randrange(3), int(kind in ("A", "R")), kind))
    return out


def records(rows, idle):
    """Records by a pass over each flow in the order of time."""
    out = []
    for flow in {r[0] for r in rows}:
        open_ = []
        for r in sorted((r for r in rows if r[0] == flow), key=lambda r: r[1]) + [None]:
            if open_ and (r is None or (r[1] - open_[-1][1]).total_seconds() > idle):
                means = [x[3] for x in open_ if x[3] is not None]
                kinds = Counter(x[7] for x in open_ if x[7])
                name = min(kinds, key=lambda k: (-kinds[k], k)) if kinds else None
                out.append((flow, open_[0][1], open_[-1][1], sum(x[2] for x in open_), sum(means) / len(means) if means else None,
                            max(x[4] for x in open_), min(x[5] for x in open_), max(x[6] for x in open_), len(open_), name))
                open_ = []
            open_.append(r)
    return sorted(out)


def close(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] + a[5:] == b[:4] + b[5:] and (a[4] == b[4] if b[4] is None else a[4] == pytest.approx(b[4]))


COLUMNS = ["flow_id", "record_start", "record_end", "total_packets", "pkt_len_mean", "pkt_len_max", "src_port", "Label", "n_segments", "attack_type"]


def run_records(spark, table, idle, batches, close_after, states=None):
    folder = replay(table, "ts", batches, "segments", close_after)
    stream = stream_flow_records(stream_table(spark, folder, "*.parquet", table.schema, 1), "ts", idle, KINDS.classes,
                                 id_columns=("src_port",), taxonomy=KINDS)
    out = run_append(stream, "records") if states is None else watched(stream, states)
    return sorted(tuple(r) for r in out.select(COLUMNS).collect())


def watched(stream, states):
    """Run a stream and note the rows of state after each micro-batch."""
    from flowguard.session import shared_dir
    spark, work = stream.sparkSession, shared_dir(stream.sparkSession, "watched")
    query = start(stream, lambda batch, i: batch.write.mode("overwrite").parquet(f"{work}/out/b={i}"), "append", work)
    query.awaitTermination()
    for p in query.recentProgress:
        p = json.loads(p.json) if hasattr(p, "json") else p
        states.append((p["numInputRows"], p["stateOperators"][0]["numRowsTotal"]))
    return spark.read.parquet(f"{work}/out")


@pytest.mark.parametrize("idle,batches", [(300, 4), (5_000, 7)])
def test_records_leave_when_idle(spark, rows, idle, batches):
    table, states = spark.createDataFrame(rows, SEGMENTS).repartition(3), []
    close(run_records(spark, table, idle, batches, "30 DAYS", states), records(rows, idle))
    assert sum(n > 1 for n, _ in states) == batches  # several batches met the state
    assert max(s for _, s in states) > 0 and states[-1][1] == 0  # and it is empty at the end


def test_records_stay_open_without_a_closing_row(spark, rows):
    table = spark.createDataFrame(rows, SEGMENTS).repartition(2)
    got, want = run_records(spark, table, 300, 3, None), records(rows, 300)
    assert 0 < len(got) < len(want) and set(r[:3] for r in got) <= set(r[:3] for r in want)


def test_pause_equal_to_the_idle_time_joins(spark):
    times = [0, 100, 200.000001, 400, 500]
    rows = [("f", START + dt.timedelta(seconds=t), 1, None, 1.0, 0, 0, "N") for t in times] + [(None, START, 1, None, 1.0, 0, 0, "N"),
                                                                                            ("g", None, 1, None, 1.0, 0, 0, "N")]
    got = run_records(spark, spark.createDataFrame(rows, SEGMENTS), 100, 5, "1 DAY")
    assert [r[8] for r in got] == [2, 1, 2]


def test_records_are_combined_without_python(spark, rows):
    """Segments meet their records in Spark's own operators; NaN counts as a missing value."""
    odd = [(*r[:3], float("nan") if r[3] is None else r[3], *r[4:]) for r in rows]
    table = spark.createDataFrame(odd, SEGMENTS).repartition(3)
    close(run_records(spark, table, 700, 3, "30 DAYS"), records(rows, 700))
    folder = replay(table, "ts", 2, "segments")
    stream = stream_flow_records(stream_table(spark, folder, "*.parquet", table.schema, 1), "ts", 700, KINDS.classes, taxonomy=KINDS)
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "InPandas" not in plan and "TransformWithState" not in plan


def test_session_stream_equals_batch(spark, rows):
    c = PacketColumns(ts="ts", length="total_packets")
    table = spark.createDataFrame(rows, SEGMENTS).select("flow_id", "ts", "total_packets", "Label")
    stream = stream_table(spark, replay(table, "ts", 4, "packets", "2 DAYS"), "*.parquet", table.schema, 1)
    done = run_append(stream_sessions(stream, c, 200, "10 seconds"), "sessions")
    columns = ["flow_id", "session_start", "total_packets", "total_bytes", "flow_duration", "Label"]
    assert sorted(done.select(columns).collect()) == sorted(flow_sessions(table, 200, c).select(columns).collect())


@pytest.fixture(scope="module")
def scores(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 400))
    return spark.range(0, 6_000, 1, 4).select(
        F.col("id").alias("packet_id"), key.alias("flow_id"), (F.col("id") % 5 == 0).cast("int").alias("alert"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"))


@pytest.fixture(scope="module")
def proba(spark):
    names = spark.range(0, 300).select(F.concat(F.lit("k"), "id").alias("flow_id"), (F.col("id") / 300).alias("proba"))
    return names.unionByName(spark.createDataFrame([("hot", 0.9)], "flow_id string, proba double"))


def test_cascade_over_batches(spark, scores, proba, tmp_path):
    ledger = AlertLedger(str(tmp_path / "ledger"), "ts", "10 minutes", 0.15)
    stream = stream_table(spark, replay(scores, "ts", 4, "scores"), "*.parquet", scores.schema, 1)
    decided = run_cascade(stream, proba, 0.5, spread_by="packet_id", ledger=ledger).persist()
    assert decided.count() == 6_000 and decided.select("packet_id").distinct().count() == 6_000
    joined = scores.join(proba, "flow_id", "left").select(
        "packet_id", ((F.col("alert") == 1) & F.coalesce(F.col("proba") >= 0.5, F.lit(True))).cast("int").alias("combined"))
    assert sorted(decided.select("packet_id", "combined").collect()) == sorted(joined.collect())
    batches = ledger.per_batch(spark).collect()
    assert len(batches) == 4 and sum(r["n"] for r in batches) == 6_000 and all(r["over_budget"] for r in batches)
    windows = {r["window_start"]: (r["n"], r["n_alerts"]) for r in ledger.per_window(spark).collect()}
    want = scores.groupBy(F.window("ts", "10 minutes")["start"].alias("w")).agg(F.count("*").alias("n"), F.sum("alert").alias("a")).collect()
    assert windows == {r["w"]: (r["n"], r["a"]) for r in want}


def test_batch_run_again_changes_nothing(spark, scores, proba, tmp_path):
    ledger = AlertLedger(str(tmp_path / "ledger"), "ts", "10 minutes", 0.5)
    writer = CascadeWriter(str(tmp_path / "work"), proba, 0.5, spread_by="packet_id", ledger=ledger)
    halves = [scores.where("packet_id < 2500"), scores.where("packet_id >= 2500")]

    def state():
        return (sorted(spark.read.parquet(str(tmp_path / "work" / "decided")).select("packet_id", "combined", "batch_id").collect()),
                sorted(ledger.per_batch(spark).collect()), sorted(ledger.per_window(spark).collect()))

    for i, half in enumerate(halves):
        writer(half, i)
    first = state()
    assert len(first[0]) == 6_000
    for i in (1, 0, 1):
        writer(halves[i], i)
        assert state() == first


def test_heavy_key_is_carried_to_a_batch_without_it(spark, scores, proba, tmp_path):
    from flowguard.operators.heavy import salts_from
    writer = CascadeWriter(str(tmp_path / "work"), proba, 0.5)
    writer(scores, 0)
    writer(scores.where("flow_id <> 'hot'").limit(100), 1)
    carried = spark.read.parquet(str(tmp_path / "work" / "carried" / "1"))
    assert carried.first()["rows"] == 6_100 and salts_from(carried, 8)["hot"] >= 5


def test_empty_table_replays(spark, scores):
    folder = replay(scores.limit(0), "ts", 3, "none", "1 DAY")
    assert spark.read.schema(scores.schema).parquet(folder).count() == 0
