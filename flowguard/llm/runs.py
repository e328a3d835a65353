"""Runs of repeated words: maximal periodic stretches of a text, found by recompression.

The words of a group of documents become one sequence of numbers, each document between marks
that occur once. ``Grammar`` compresses it in rounds: block compression names every maximal
repetition of one symbol, pair compression names every neighbouring pair of a left and a right
symbol, where a hash of the symbol says which it is. Equal stretches get equal names but at
their ends, so the common extension of two places is walked upwards through the rounds while
names agree and downwards to the first word that differs.

A run of period p and two periods at least holds two neighbours of the grid 0, p, 2p, ...
For every p the grid's neighbours with equal words are candidates (the grids have n ln n places in
all); extensions to both sides say exactly where such a stretch ends, and the least period of
equal stretches is the run's own.

Defined results: a null or empty text has no words and no runs; repeated rows are treated one by
one; an empty table gives an empty table; a text may be of any length, one task needs memory in
proportion to the longest text or ``GROUP`` bytes; only the id and text columns are read,
a row with a null id is treated like others. Of stretches of one length the one that begins first
is the longest run.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import id_and_text, mixed, texts

#: Words that a run has at least.
LEAST = 12
#: Rounds of block and pair compression at most; the walk is exact after any number of them.
ROUNDS = 64
#: Bytes of text that are searched together.
GROUP = 1 << 20
#: Candidates that are extended together.
CANDIDATES = 1 << 18

SCHEMA = ("doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


class Level:
    """A sequence of symbols on the way through the grammar. ``size``: words of each symbol;
    ``up``: place of the parent; ``first``, ``last``: places of the children's ends below;
    ``run_start``, ``run_end``: bounds of the repetition around a place, where the parents name
    repetitions."""

    def __init__(self, symbols: np.ndarray, size: np.ndarray, first: np.ndarray | None, last: np.ndarray | None):
        self.symbols, self.size, self.first, self.last = symbols, size, first, last
        self.head = self.tail = self.up = self.run_start = self.run_end = None

    def grouped(self, head: np.ndarray, blocks: bool) -> tuple[np.ndarray, np.ndarray]:
        """Parents begin where ``head`` is true; gives their first and last children."""
        first = np.flatnonzero(head)
        last = np.append(first[1:], len(head)) - 1
        self.head, self.tail = head, np.append(head[1:], True)
        self.up = np.cumsum(head) - 1
        if blocks:
            self.run_start, self.run_end = first[self.up], last[self.up]
        return first, last


class Grammar:
    """Run-length grammar of a sequence. Its first and last word, and those between documents,
    must be negative and occur once."""

    def __init__(self, words: np.ndarray):
        level = Level(words.astype(np.int64), np.ones(len(words), np.int64), None, None)
        self.levels, self.fresh = [level], int(words.max(initial=0)) + 1
        marks = int((words < 0).sum())
        for k in range(ROUNDS):
            if len(level.symbols) <= 2 * marks:
                break
            level = self.pairs(self.blocks(level), k)

    def named(self, level: Level, first: np.ndarray, last: np.ndarray, key: np.ndarray, joined: np.ndarray) -> Level:
        """The next level: parents that join several children get the names of their keys."""
        symbols = level.symbols[first]
        if joined.any():
            _, names = np.unique(key, return_inverse=True)
            symbols[joined] = self.fresh + names
            self.fresh += int(names.max()) + 1
        sums = np.concatenate([[0], np.cumsum(level.size)])
        made = Level(symbols, sums[last + 1] - sums[first], first, last)
        self.levels.append(made)
        return made

    def blocks(self, level: Level) -> Level:
        s = level.symbols
        first, last = level.grouped(np.append(True, s[1:] != s[:-1]), True)
        joined = last > first
        key = s[first[joined]] * (len(s) + 1) + (last - first)[joined]
        return self.named(level, first, last, key, joined)

    def pairs(self, level: Level, k: int) -> Level:
        s = level.symbols
        side = (mixed(s.astype(np.uint64) + np.uint64(k * 0x9E3779B9)) >> np.uint64(17)) & np.uint64(1)
        left, right = (s >= 0) & (side == 0), (s >= 0) & (side == 1)
        first, last = level.grouped(np.append(True, ~(left[:-1] & right[1:])), False)
        joined = last > first
        key = s[first[joined]] * self.fresh + s[last[joined]]
        return self.named(level, first, last, key, joined)

    def extension(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """Number of equal words from places a and b on (``step`` 1), or from there backwards (-1)."""
        found = np.zeros(len(a), np.int64)
        stopped: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        who, top = np.arange(len(a)), len(self.levels) - 1
        for k, level in enumerate(self.levels):
            a, b, who, rest = self.walk(level, a, b, who, found, step, k < top)
            stopped.append(rest)
            if not len(who):
                break
            a, b = level.up[a], level.up[b]
        a = b = who = np.zeros(0, np.int64)
        for k in range(len(stopped) - 1, -1, -1):
            level = self.levels[k]
            _, _, _, rest = self.walk(level, a, b, who, found, step, False)
            a, b, who = (np.concatenate(x) for x in zip(rest, stopped[k]))
            if k:
                ends = level.first if step > 0 else level.last
                a, b = ends[a], ends[b]
        return found

    def walk(self, level: Level, a, b, who, found, step: int, rise: bool):
        """Take equal symbols until they differ or, with ``rise``, both places begin a parent. Gives
        places and queries that rise, and those that ended."""
        symbols, size = level.symbols, level.size
        edge = level.head if step > 0 else level.tail
        bound = level.run_end if step > 0 else level.run_start
        risen, ended = [], []
        while len(who):
            same = symbols[a] == symbols[b]
            if not same.all():
                ended.append((a[~same], b[~same], who[~same]))
                a, b, who = a[same], b[same], who[same]
            if rise:
                both = edge[a] & edge[b]
                if both.any():
                    risen.append((a[both], b[both], who[both]))
                    a, b, who = a[~both], b[~both], who[~both]
            if not len(who):
                break
            if bound is None:
                n = np.ones(len(a), np.int64)
            else:
                n = np.minimum(np.abs(bound[a] - a), np.abs(bound[b] - b)) + 1
            found[who] += n * size[a]
            a, b = a + step * n, b + step * n
        none = [(np.zeros(0, np.int64),) * 3]
        a, b, who = (np.concatenate(x) for x in zip(*(risen or none)))
        return a, b, who, tuple(np.concatenate(x) for x in zip(*(ended or none)))


def find_runs(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows (start, end, period), in order, of all runs in ``words``; documents lie from ``starts``
    to ``ends`` with a negative word around each."""
    none = np.zeros((0, 3), np.int64)
    longest = int((ends - starts).max(initial=0))
    if longest < LEAST:
        return none
    document = np.repeat(np.arange(2 * len(starts) + 1), np.diff(np.stack([starts, ends], 1).ravel(), prepend=0, append=len(words)))
    grammar, found, held, size = None, [], [], 0
    for p in range(1, longest // 2 + 1):
        hit = np.flatnonzero(words[:-p:p] == words[p::p]) * p
        hit = hit[document[hit] == document[hit + p]]
        if len(hit):
            held.append(np.stack([hit, np.full(len(hit), p)], 1))
            size += len(hit)
        if held and (size >= CANDIDATES or p == longest // 2):
            grammar = grammar or Grammar(words)
            found.append(stretches(grammar, *np.concatenate(held).T))
            held, size = [], 0
    if held:
        found.append(stretches(grammar or Grammar(words), *np.concatenate(held).T))
    return least_periods(np.concatenate(found)) if found else none


def stretches(grammar: Grammar, place: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of the stretches around candidate places that are long enough."""
    forward = grammar.extension(place, place + period, 1)
    back = grammar.extension(place - 1, place + period - 1, -1)
    good = forward + back >= np.maximum(period, LEAST - period)
    return least_periods(np.stack([place - back, place + period + forward, period], 1)[good])


def least_periods(rows: np.ndarray) -> np.ndarray:
    """The row of the least period of each start and end, in order."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    fresh = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))
    return rows[fresh[:len(rows)]]


def numbered(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of several documents as one sequence with marks, and the bounds of the documents."""
    known: dict[bytes, int] = {}
    parts: list[int] = [-1]
    starts, ends = [], []
    for k, words in enumerate(lists):
        starts.append(len(parts))
        parts += [known.setdefault(w, len(known)) for w in words]
        ends.append(len(parts))
        parts.append(-2 - k)
    return np.asarray(parts, np.int64), np.asarray(starts, np.int64), np.asarray(ends, np.int64)


def split_words(text: str | None) -> list[bytes]:
    """Words between the blanks \\x20 and \\x09 to \\x0D."""
    return text.encode().split() if text else []


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """Words that are in no run, or among the first period of every run around them."""
    if not len(runs):
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, its runs by start and period, and the text with every run cut to one period.
    ``prepare`` may change the words of a document, given its id, before the search."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values in texts(batches, GROUP):
            lists = [split_words(v) for v in values]
            if prepare:
                lists = [prepare(i, w) for i, w in zip(ids, lists)]
            words, starts, ends = numbered(lists)
            rows = find_runs(words, starts, ends)
            cuts = np.searchsorted(rows[:, 0], starts)
            bounds = np.append(cuts, len(rows))
            own = rows.copy()
            own[:, :2] -= np.repeat(starts, np.diff(bounds))[:, None]
            collapsed = [collapse(w, own[a:b]) for w, a, b in zip(lists, bounds, bounds[1:])]
            runs = pa.StructArray.from_arrays(
                [pa.array(own[:, 0]), pa.array(own[:, 1] - own[:, 0]), pa.array(own[:, 2])], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])

    return id_and_text(docs, id_col, text_col).mapInArrow(search, SCHEMA)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document by the crc32 of its id repeats a stretch up to its end; others, and
    those without an id, stay as they are."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def digests(found: DataFrame) -> DataFrame:
    """Counts and digests of runs and collapsed text, and the longest run's figures."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    line = F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    top = found.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), best.alias("top"), listed.alias("listed"))
    return top.select(
        "doc_id", "n_runs", (-F.col("top.before")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.less")).alias("period"),
        F.expr("(1000 * top.length) div (-top.less)").cast("long").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
