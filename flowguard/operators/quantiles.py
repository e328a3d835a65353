"""Exact order statistics and quantiles of columns of any size.

``percentile`` keeps a map of all distinct values in one task, which a column of 10^12
doubles does not allow. Here a value is found by descent through the digits of its 64-bit
image, which has the order of the values: each pass counts, over the rows that share the
digits found so far, how often each next digit occurs, and the running sum tells the digit
of the wanted rank. Five passes of 13 bits give every value of every column exactly. A pass is
one counting scan for all columns with at most 8192 counters per open prefix and task; rows
are never shuffled, and nothing depends on the size of the table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 13
SIGN = np.uint64(1 << 63)


def _images(values: pa.Array) -> np.ndarray:
    """64-bit images of the values present, in the order of the values (NaN last, as in Spark)."""
    present = values.drop_null().to_numpy(zero_copy_only=False)
    if present.dtype.kind != "f":
        return present.astype(np.int64).view(np.uint64) ^ SIGN
    plain = np.where(np.isnan(present), np.nan, present + 0.0).view(np.uint64)
    return np.where(plain & SIGN, ~plain, plain | SIGN)


def _value(image: int, whole: bool) -> float | int:
    bits = np.array([image], np.uint64)
    if whole:
        return int((bits ^ SIGN).view(np.int64)[0])
    return float(np.where(bits & SIGN, bits ^ SIGN, ~bits).view(np.float64)[0])


def _next_digits(df: DataFrame, groups: list[tuple[int, int]], places: list[tuple[int, int]], top: int,
                 low: int) -> dict[tuple[int, int], tuple[int, int]]:
    """For (group, place) the next digit and the number of values before it in the group. A
    group is a column and the image's bits above ``top``; the digit is the bits from ``low`` on."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = top - low
        counts = np.zeros((len(groups), 1 << width), np.int64)
        for batch in batches:
            for column in {c for c, _ in groups}:
                image = _images(batch.column(column))
                for g, (c, prefix) in enumerate(groups):
                    if c == column:
                        own = image if top == 64 else image[image >> np.uint64(top) == np.uint64(prefix)]
                        digit = (own >> np.uint64(low)) & np.uint64((1 << width) - 1)
                        counts[g] += np.bincount(digit.astype(np.int64), minlength=1 << width)
        g, digit = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(digit, pa.int32()),
                                          pa.array(counts[g, digit], pa.int64())], ["g", "digit", "n"])

    counted = df.mapInArrow(count, "g int, digit int, n long").groupBy("g", "digit").agg(F.sum("n").alias("n"))
    ends = counted.withColumn("end", F.sum("n").over(Window.partitionBy("g").orderBy("digit")))
    wanted = df.sparkSession.createDataFrame(places, "g int, place long")
    hit = (F.col("place") < F.col("end")) & (F.col("place") >= F.col("end") - F.col("n"))
    rows = ends.join(F.broadcast(wanted), "g").where(hit).select("g", "place", "digit", (F.col("end") - F.col("n")).alias("before"))
    return {(r["g"], r["place"]): (r["digit"], r["before"]) for r in rows.collect()}


def count_values(df: DataFrame, items: dict[str, Column]) -> dict[str, int]:
    names = list(items)
    row = df.agg(*[F.count(items[n]).alias(f"n{i}") for i, n in enumerate(names)]).first()
    return {n: row[f"n{i}"] for i, n in enumerate(names)}


def order_statistics(df: DataFrame, items: dict[str, Column], ranks: Callable[[str, int], list[int]],
                     counts: dict[str, int] | None = None) -> dict[str, dict[int, float | int]]:
    """Exact values at 0-based ranks of each column expression, NULLs left out.

    ``ranks(name, n)`` names the ranks wanted of a column with ``n`` values. The input is
    read several times, so it must give the same rows each time.
    """
    names = list(items)
    counts = counts or count_values(df, items)
    plain = df.select(*[items[n].alias(f"c{i}") for i, n in enumerate(names)])
    whole = [f.dataType.typeName() in ("byte", "short", "integer", "long", "boolean") for f in plain.schema.fields]
    frame = plain.select(*[F.col(f"c{i}").cast("bigint" if w else "double") for i, w in enumerate(whole)])
    # Of each wanted value: its column, the bits found and its rank among the rows that share them.
    found = {(i, r): (0, r) for i, n in enumerate(names) if counts[n] for r in sorted(set(ranks(n, counts[n])))}
    top = 64
    while top and found:
        low = max(0, top - BITS)
        groups = sorted({(i, prefix) for (i, _), (prefix, _) in found.items()})
        number = {g: k for k, g in enumerate(groups)}
        places = sorted({(number[i, prefix], place) for (i, _), (prefix, place) in found.items()})
        digits = _next_digits(frame, groups, places, top, low)
        for (i, r), (prefix, place) in found.items():
            if (number[i, prefix], place) not in digits:
                raise RuntimeError(f"no value of rank {r} in {names[i]}: is the input stable between passes?")
            digit, before = digits[number[i, prefix], place]
            found[i, r] = (prefix << (top - low) | digit, place - before)
        top = low
    out: dict[str, dict[int, float | int]] = {name: {} for name in names}
    for (i, r), (image, _) in found.items():
        out[names[i]][r] = _value(image, whole[i])
    return out


@dataclass(frozen=True)
class Quantile:
    """The two neighbouring values of a linearly interpolated quantile."""

    lower: float
    upper: float
    weight: float

    @property
    def value(self) -> float:
        return self.lower + (self.upper - self.lower) * self.weight


def exact_quantiles(df: DataFrame, items: dict[str, Column], probs: list[float],
                    counts: dict[str, int] | None = None) -> dict[str, list[Quantile | None]]:
    """Linearly interpolated quantiles (position q * (n - 1)) of each column, exact.
    A column without values gives None."""
    counts = counts or count_values(df, items)

    def position(q: float, n: int) -> tuple[int, float]:
        at = q * (n - 1)
        low = min(int(math.floor(at)), n - 1)
        return low, at - low

    def ranks(name: str, n: int) -> list[int]:
        return [r for q in probs for low in (position(q, n)[0],) for r in (low, min(low + 1, n - 1))]

    found = order_statistics(df, items, ranks, counts)
    out: dict[str, list[Quantile | None]] = {}
    for name in items:
        n = counts[name]
        out[name] = []
        for q in probs:
            if not n:
                out[name].append(None)
                continue
            low, weight = position(q, n)
            out[name].append(Quantile(found[name][low], found[name][min(low + 1, n - 1)], weight))
    return out
