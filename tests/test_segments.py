import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from flowguard.operators.segments import (PacketColumns, ffill_by_key, flow_segments, flow_segments_relative,
                                          flow_sessions, flow_sessions_native, session_number,
                                          with_arrival_gaps)
from flowguard.streaming.operators import stream_segments, stream_sessions
from flowguard.streaming.runner import run_append, run_update, stream_table

START = dt.datetime(2024, 1, 1)
C = PacketColumns(flags=("flag_syn",))


@pytest.fixture(scope="module")
def rows():
    """One flow with 400 of 600 packets, others short; times with microseconds."""
    rng, out = random.Random(4), []
    for i in range(600):
        flow = "hot" if i % 3 else f"f{i % 7}"
        at = START + dt.timedelta(seconds=rng.uniform(0, 2_000))
        out.append((i, flow, at, float(rng.randint(40, 1500)), i % 2, int(flow == "hot")))
    return out


@pytest.fixture(scope="module")
def packets(spark, rows):
    return spark.createDataFrame(rows, "id int, flow_id string, timestamp timestamp, packet_length double, "
                                       "flag_syn int, Label int").repartition(4).persist()


def by_flow(rows):
    flows = {}
    for r in sorted(rows, key=lambda r: r[2]):
        flows.setdefault(r[1], []).append(r)
    return flows


def test_gaps_do_not_depend_on_the_slice(packets, rows):
    want = {}
    for members in by_flow(rows).values():
        for a, b in zip([None] + members[:-1], members):
            want[b[0]] = None if a is None else (b[2] - a[2]).total_seconds()
    for width in (1, 60, 10_000):
        got = {r["id"]: r for r in with_arrival_gaps(packets, C, "gap", width).collect()}
        assert len(got) == 600
        assert all((got[i]["gap"] is None) == (w is None) and (w is None or got[i]["gap"] == pytest.approx(w, abs=1e-9))
                   for i, w in want.items())
        assert all(r["flow_start"] == by_flow(rows)[r["flow_id"]][0][2] for r in got.values())


def test_relative_segments(packets, rows):
    got = {(r["flow_id"], r["segment_index"]): r for r in flow_segments_relative(packets, C, slice_seconds=30).collect()}
    for flow, members in by_flow(rows).items():
        parts = {}
        for m in members:
            parts.setdefault(min(int((m[2] - members[0][2]).total_seconds() // 120), 4), []).append(m)
        for index, part in parts.items():
            r = got.pop((flow, index))
            span = (part[-1][2] - part[0][2]).total_seconds()
            assert (r["total_packets"], r["total_bytes"]) == (len(part), sum(m[3] for m in part))
            assert r["flow_duration"] == pytest.approx(span) and r["syn_count"] == sum(m[4] for m in part)
            assert (r["flow_packets_per_s"] is None) == (span == 0)
    assert not got


def test_single_packet_segment(spark):
    df = spark.createDataFrame([("f", START, 10.0, 1, 0)], "flow_id string, timestamp timestamp, packet_length double, flag_syn int, Label int")
    r = flow_segments(df, C).first()
    assert (r["flow_duration"], r["flow_packets_per_s"], r["pkt_len_std"]) == (0.0, None, 0.0)


def test_sessions_equal_native_sessions(packets):
    columns = ["flow_id", "session_start", "total_packets", "total_bytes", "flow_duration", "Label"]
    for gap in (5, 30, 200):
        native = sorted(flow_sessions_native(packets, gap, C).select(columns).collect())
        for width in (7, 60, 5_000):
            assert sorted(flow_sessions(packets, gap, C, width).select(columns).collect()) == native


def test_pause_longer_than_the_gap_starts_a_session(spark):
    times = [0, 10, 20.5, 29]
    df = spark.createDataFrame([("f", START + dt.timedelta(seconds=s), 1.0) for s in times],
                               "flow_id string, timestamp timestamp, packet_length double")
    c = PacketColumns(label=None)
    numbered = session_number(df, 10, c).orderBy("timestamp").collect()
    assert [r["session"] for r in numbered] == [0, 0, 1, 1]
    assert flow_sessions_native(df, 10, c).count() == 2


def test_stream_equals_batch(spark, packets, tmp_path):
    folder = str(tmp_path / "in")
    for i, edge in enumerate((0, 300, 700, 1_200, 5_000)):
        part = packets.where((F.unix_timestamp("timestamp") - int(START.replace(tzinfo=dt.UTC).timestamp())).between(
            0 if i == 0 else [0, 300, 700, 1_200][i - 1], edge - 1))
        part.coalesce(1).write.mode("append").parquet(folder)
    batch = flow_segments(packets, C)
    stream = stream_segments(stream_table(spark, folder, "*.parquet", packets.schema, 1), C, watermark="1 hour")
    done = run_update(stream, ["flow_id", "segment_start"], "t")
    columns = ["flow_id", "segment_start", "total_packets", "total_bytes", "syn_count"]
    assert sorted(done.select(columns).collect()) == sorted(batch.select(columns).collect())


def test_stream_drops_late_packets_and_closes_sessions(spark, tmp_path):
    schema = "flow_id string, timestamp timestamp, packet_length double"
    folder = str(tmp_path / "late")
    for seconds in (0, 4_000, 10, 9_000):
        spark.createDataFrame([("f", START + dt.timedelta(seconds=seconds), 1.0)], schema).coalesce(1) \
             .write.mode("append").parquet(folder)
    c = PacketColumns(label=None)
    source = stream_table(spark, folder, "*.parquet", spark.read.parquet(folder).schema, 1)
    done = run_append(stream_sessions(source, c, 60, "10 minutes"), "late")
    starts = sorted((r["session_start"] - START).total_seconds() for r in done.collect())
    assert 4_000.0 in starts and 9_000.0 not in starts and 10.0 not in starts


def test_ffill(spark):
    rows = [("a", 1, None), ("a", 100, 5.0), ("a", 101, None), ("a", 900, None), ("a", 901, 7.0), ("a", 2_000, None),
            ("b", 1, None), ("c", 1, None), ("c", 500, 2.0)]
    df = spark.createDataFrame([(k, START + dt.timedelta(seconds=t), v) for k, t, v in rows],
                               "k string, ts timestamp, v double")
    want = [5.0, 5.0, 5.0, 5.0, 7.0, 7.0, None, 2.0, 2.0]
    for width in (1, 60, 10_000):
        got = ffill_by_key(df, "k", "ts", ["v"], slice_seconds=width).orderBy("k", "ts").collect()
        assert [r["v"] for r in got] == want
