"""Packets to flow segments and sessions, and keyed gap filling.

No operator here brings all packets of a flow together. Those that need the order of a
flow's packets cut it into time slices: rows are ordered inside a slice only, and what must
cross a slice border (last time, running number, last value) is carried through a table with
one row per flow and slice. A flow with a third of all packets is spread over its slices.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT_SECONDS = 120
MAX_SEGMENTS = 5
SLICE_SECONDS = 60


@dataclass(frozen=True)
class PacketColumns:
    """Names of the packet columns; optional ones may be None. Arrival gaps are divided by
    ``iat_unit``."""

    key: str = "flow_id"
    ts: str = "timestamp"
    length: str = "packet_length"
    iat: str | None = None
    iat_unit: float = 1.0
    flags: tuple[str, ...] = ()
    label: str | None = "Label"


def micros(ts: Column) -> Column:
    """Microseconds since the epoch. The session time zone should be UTC when times carry no
    zone."""
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(1_000_000.0)


def segment_aggregates(c: PacketColumns) -> list[Column]:
    """The columns of a segment. ``std`` is the population form, so one packet gives 0."""
    length = F.col(c.length)
    out = [F.count(F.lit(1)).alias("total_packets"), F.sum(length).alias("total_bytes"),
           F.avg(length).alias("pkt_len_mean"), F.stddev_pop(length).alias("pkt_len_std"),
           F.min(length).alias("pkt_len_min"), F.max(length).alias("pkt_len_max"),
           F.min(c.ts).alias("_first"), F.max(c.ts).alias("_last")]
    if c.iat:
        out += [(F.avg(c.iat) / c.iat_unit).alias("iat_mean"),
                (F.stddev_pop(c.iat) / c.iat_unit).alias("iat_std")]
    out += [F.sum(f).alias(f.replace("flag_", "") + "_count") for f in c.flags]
    if c.label:
        out.append(F.max(c.label).alias("Label"))
    return out


def with_rates(segments: DataFrame) -> DataFrame:
    """Duration and rates; rates of a segment without duration are NULL."""
    span = seconds_between(F.col("_first"), F.col("_last"))
    return (segments.withColumn("flow_duration", span).drop("_first", "_last")
            .withColumn("flow_packets_per_s", F.try_divide(F.col("total_packets").cast("double"), "flow_duration"))
            .withColumn("flow_bytes_per_s", F.try_divide(F.col("total_bytes").cast("double"), "flow_duration")))


def flow_segments(packets: DataFrame, c: PacketColumns = PacketColumns(),
                  segment_seconds: int = SEGMENT_SECONDS) -> DataFrame:
    """Segments aligned to the clock: one row per flow and tumbling window. The same code
    serves batch and streaming input."""
    grouped = packets.groupBy(c.key, F.window(c.ts, f"{segment_seconds} seconds").alias("w"))
    out = with_rates(grouped.agg(*segment_aggregates(c)))
    return out.withColumn("segment_start", F.col("w.start")).drop("w")


def _sliced(df: DataFrame, c: PacketColumns, slice_seconds: int) -> DataFrame:
    return df.withColumn("_slice", F.floor(micros(F.col(c.ts)) / (slice_seconds * 1_000_000)))


def _with_gaps(packets: DataFrame, c: PacketColumns, out: str, slice_seconds: int) -> DataFrame:
    """``with_arrival_gaps`` in microseconds and with the ``_slice`` column kept, so that
    later steps reuse the partitioning by (flow, slice)."""
    sliced = _sliced(packets, c, slice_seconds)
    bounds = sliced.groupBy(c.key, "_slice").agg(F.min(c.ts).alias("_first"), F.max(c.ts).alias("_last"))
    over_flow = Window.partitionBy(c.key).orderBy("_slice")
    carried = bounds.select(
        c.key, "_slice", F.lag("_last").over(over_flow).alias("_carried"),
        F.min("_first").over(over_flow.rowsBetween(Window.unboundedPreceding, 0)).alias("flow_start"))
    inside = Window.partitionBy(c.key, "_slice").orderBy(c.ts)
    previous = F.coalesce(F.lag(c.ts).over(inside), F.col("_carried"))
    gap = micros(F.col(c.ts)) - micros(previous)
    return sliced.join(carried, [c.key, "_slice"], "left").withColumn(out, gap).drop("_carried")


def with_arrival_gaps(packets: DataFrame, c: PacketColumns = PacketColumns(), out: str = "iat",
                      slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Add ``flow_start`` and the seconds since the flow's previous packet (NULL at first).

    The slice table carries the last time of the previous slice and the flow's start. It is
    joined on (flow, slice), the partitioning the in-slice window needs as well.
    """
    gaps = _with_gaps(packets, c, out, slice_seconds).drop("_slice")
    return gaps.withColumn(out, F.col(out) / F.lit(1_000_000.0))


def flow_segments_relative(packets: DataFrame, c: PacketColumns = PacketColumns(),
                           segment_seconds: int = SEGMENT_SECONDS, max_segments: int = MAX_SEGMENTS,
                           slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Segments counted from the flow's first packet: number floor(offset / length), at most
    ``max_segments``, the last one taking the rest. Arrival gaps are derived."""
    gaps = _with_gaps(packets, c, "_iat", slice_seconds)
    offset = seconds_between(F.col("flow_start"), F.col(c.ts))
    index = F.least(F.floor(offset / segment_seconds), F.lit(max_segments - 1)).cast("int")
    columns = replace(c, iat="_iat", iat_unit=1e6)
    grouped = gaps.withColumn("segment_index", index).groupBy(c.key, "segment_index")
    return with_rates(grouped.agg(*segment_aggregates(columns)))


def session_number(packets: DataFrame, gap_seconds: float, c: PacketColumns = PacketColumns(),
                   out: str = "session", slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Number the sessions of each flow from 0: a new one starts after a pause longer than
    ``gap_seconds``. Counts of earlier slices are carried, so a slice is numbered alone."""
    gaps = _with_gaps(packets, c, "_gap", slice_seconds).drop("flow_start")
    marked = gaps.withColumn(
        "_starts", F.coalesce((F.col("_gap") > int(gap_seconds * 1_000_000)).cast("int"), F.lit(0)))
    per_slice = marked.groupBy(c.key, "_slice").agg(F.sum("_starts").alias("_n"))
    before = Window.partitionBy(c.key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slice.select(c.key, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = (Window.partitionBy(c.key, "_slice").orderBy(c.ts)
                    .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    number = (F.sum("_starts").over(inside) + F.col("_before")).cast("bigint")
    return marked.join(carried, [c.key, "_slice"], "left").withColumn(out, number) \
                 .drop("_before", "_slice", "_starts", "_gap")


def flow_sessions(packets: DataFrame, gap_seconds: int, c: PacketColumns = PacketColumns(),
                  slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """One row per flow session, batch form. Equal to grouping by ``session_window``, which
    would sort a whole flow in one task."""
    numbered = session_number(packets, gap_seconds, c, "_session", slice_seconds)
    grouped = numbered.groupBy(c.key, "_session").agg(
        *segment_aggregates(c), F.min(c.ts).alias("session_start"))
    return with_rates(grouped).drop("_session")


def flow_sessions_native(packets: DataFrame, gap_seconds: int,
                         c: PacketColumns = PacketColumns()) -> DataFrame:
    """The same with ``session_window``, for streams."""
    grouped = packets.groupBy(c.key, F.session_window(c.ts, f"{gap_seconds} seconds").alias("w"))
    out = with_rates(grouped.agg(*segment_aggregates(c)))
    return out.withColumn("session_start", F.col("w.start")).drop("w")


def ffill_by_key(df: DataFrame, key: str, ts: str, columns: list[str], tie: str | None = None,
                 slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Fill gaps with the key's previous non-null value, and leading gaps with its next one.

    ``tie`` orders rows of equal time. The last (first) value of earlier (later) slices is
    carried, so only rows of one slice are ordered together.
    """
    order = [ts] + ([tie] if tie else [])
    sliced = _sliced(df, PacketColumns(key=key, ts=ts), slice_seconds)
    place = F.struct(*order)

    def edge(f, name: str) -> Column:
        value = F.col(f"`{name}`")
        return f(F.when(value.isNotNull(), F.struct(place.alias("o"), value.alias("v"))))["v"]

    bounds = sliced.groupBy(key, "_slice").agg(
        *[edge(F.max, c).alias(f"_l{i}") for i, c in enumerate(columns)],
        *[edge(F.min, c).alias(f"_f{i}") for i, c in enumerate(columns)])
    flow = Window.partitionBy(key).orderBy("_slice")
    earlier = flow.rowsBetween(Window.unboundedPreceding, -1)
    whole_flow = flow.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = bounds.select(
        key, "_slice",
        *[F.last(f"_l{i}", ignorenulls=True).over(earlier).alias(f"_b{i}") for i in range(len(columns))],
        *[F.first(f"_f{i}", ignorenulls=True).over(whole_flow).alias(f"_a{i}") for i in range(len(columns))])
    slice_ = Window.partitionBy(key, "_slice").orderBy(*order)
    back = slice_.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # With no earlier value anywhere, the next value is the first one of the slice, else of
    # the flow: whole-partition frames, which are evaluated once.
    whole = slice_.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    joined = sliced.join(carried, [key, "_slice"], "left")
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(back), F.col(f"_b{i}"),
                            F.first(c, ignorenulls=True).over(whole), F.col(f"_a{i}"))
              for i, c in enumerate(columns)}
    out = joined.select(*[filled[c].alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns])
    return out
