"""Benchmark decontamination with a positional inverted index.

``build_index`` stores the postings of every training word. The index is cut into shards of
documents: a shard numbers its words through (documents are a gap apart, so no phrase crosses
them) and holds for each word, by a 64-bit hash, its ascending positions. Shards are rows of a
table in the shared folder. ``match_phrases`` reads each shard once per block of benchmark items;
for a phrase it takes the positions of the word that is rarest in the shard, shifts them to the
phrase's start and keeps those that the other words' shifted positions confirm, from rare to
common. ``match_near`` finds documents with all words of an item inside a span of some width.

The benchmark is taken in blocks of at most about ``BLOCK_BYTES`` of text, so what goes to the
executors at once is bounded whatever its size; every block meets every shard.

Defined results: null or empty texts have no words and are never hit; items without words match
nothing; an item shorter than the phrase length is one phrase; repeated rows are matched one by
one; items with one id count once, a null id counts hits but is not listed; an empty benchmark
leaves every document clean. Only id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import (ALNUM, RollingHash, id_and_text, joined, packed, stage, texts, unpacked,
                                  word_bounds)

WORDS = 10
#: Words of a shard; a longer document is a shard of its own.
SHARD_WORDS = 1 << 19
BLOCK_BYTES = 4 << 20

INDEX = "shard string, doc_ids array<long>, starts array<long>, n_words array<long>, terms binary, positions binary"
FOUND = "shard string, place int, doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<long>"


def word_hashes(values: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the number of words of each text."""
    data, bounds = joined(values, ALNUM)
    starts, ends = word_bounds(data)
    counts = np.diff(np.searchsorted(starts, bounds))
    return RollingHash(data).of(starts, ends), counts


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of whole documents, written to the shared folder."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids: list = []
        hashes: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, made
            every, n = np.concatenate(hashes), np.concatenate(counts)
            starts = np.cumsum([0, *(n[:-1] + 1)])
            place = np.repeat(starts - np.cumsum([0, *n[:-1]]), n) + np.arange(len(every))
            order = np.argsort(every, kind="stable")
            every, place = every[order], place[order].astype(np.uint32)
            first = np.flatnonzero(np.diff(every, prepend=~every[:1]) != 0)
            steps = np.diff(place, prepend=np.uint32(0))
            steps[first] = place[first]
            terms = packed(every[first], np.diff(first, append=len(every)).astype(np.uint32))
            row = pa.RecordBatch.from_arrays([
                pa.array([f"{part}-{made}"]), pa.array([list(ids)], pa.list_(pa.int64())),
                pa.array([starts], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64())),
                pa.array([terms], pa.binary()), pa.array([packed(np.zeros(0, np.uint64), steps)], pa.binary()),
            ], ["shard", "doc_ids", "starts", "n_words", "terms", "positions"])
            ids.clear()
            hashes.clear()
            counts.clear()
            held, made = 0, made + 1
            return row

        for keys, values in texts(batches, 1 << 20):
            h, n = word_hashes(values)
            ids += keys
            hashes.append(h)
            counts.append(n)
            held += len(h)
            if held >= SHARD_WORDS:
                yield flush()
        if ids:
            yield flush()

    return stage(id_and_text(docs, id_col, text_col).mapInArrow(shards, INDEX), "index")


class Shard:
    """Postings of one row of the index."""

    def __init__(self, terms: bytes, positions: bytes):
        self.terms, self.counts = unpacked(terms)
        self.first = np.cumsum(self.counts, dtype=np.int64) - self.counts
        steps = unpacked(positions)[1].astype(np.int64)
        total = np.cumsum(steps)
        base = np.zeros(len(self.first), np.int64)
        base[1:] = total[self.first[1:] - 1]
        self.positions = total - np.repeat(base, self.counts)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Places of the wanted words among the shard's words, -1 if absent."""
        if not len(self.terms):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
        return np.where(self.terms[at] == wanted, at, -1)

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.first[term]:self.first[term] + self.counts[term]]

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Positions where the words stand one after another."""
        order = np.argsort(self.counts[terms], kind="stable")
        starts = self.postings(terms[order[0]]) - order[0]
        for j in order[1:]:
            if not len(starts):
                break
            other = self.postings(terms[j])
            at = np.minimum(np.searchsorted(other, starts + j), len(other) - 1)
            starts = starts[other[at] == starts + j]
        return starts

    def near(self, terms: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the shortest stretches of at most ``width`` words with all words."""
        terms = terms[np.argsort(self.counts[terms], kind="stable")]
        rare = self.postings(terms[0])
        left = np.unique(np.concatenate([self.postings(t) for t in terms]))
        at = np.searchsorted(rare, left)  # a stretch holds the rarest word, at its left end or after
        left = left[at < len(rare)]
        left = left[rare[np.searchsorted(rare, left)] < left + width]
        end = left.copy()
        for t in terms:
            own = self.postings(t)
            at = np.searchsorted(own, left)
            end = np.maximum(end, np.where(at < len(own), own[np.minimum(at, len(own) - 1)], np.iinfo(np.int64).max - 1))
        keep = end < left + width
        left, end = left[keep], end[keep] + 1
        shortest = np.append(end[1:] != end[:-1], True) if len(end) else np.zeros(0, bool)
        return left[shortest], end[shortest]


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans as one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.append(True, starts[1:] > ends[:-1]) if len(starts) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return starts[at], ends[np.append(at[1:], len(starts)) - 1] if len(at) else ends


def search(index: DataFrame, queries: list, find: Callable) -> DataFrame:
    """Per document of the index its spans and items. ``find(shard, queries)`` yields (starts,
    ends, item ids) in the shard's positions."""
    def per_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                name, ids, starts, sizes, terms, positions = (
                    batch.column(k)[row].as_py() for k in ("shard", "doc_ids", "starts", "n_words", "terms", "positions"))
                starts, sizes = np.asarray(starts, np.int64), np.asarray(sizes, np.int64)
                begin, stop, pairs = [], [], set()
                for a, b, items in find(Shard(terms, positions), queries):
                    doc = np.searchsorted(starts, a, "right") - 1
                    inside = b <= starts[doc] + sizes[doc]
                    a, b, doc = a[inside], b[inside], doc[inside]
                    begin.append(a)
                    stop.append(b)
                    pairs.update((d, i) for d in np.unique(doc).tolist() for i in items)
                a, b = merged(np.concatenate(begin), np.concatenate(stop)) if begin else (np.zeros(0, int),) * 2
                doc = np.searchsorted(starts, a, "right") - 1
                spans: dict[int, list] = {}
                for d, s, e in zip(doc.tolist(), (a - starts[doc]).tolist(), (b - starts[doc]).tolist()):
                    spans.setdefault(d, []).append({"start": s, "end": e})
                items: dict[int, list] = {}
                for d, i in sorted((p for p in pairs if p[1] is not None)):
                    items.setdefault(d, []).append(i)
                n = len(ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * n), pa.array(range(n), pa.int32()), pa.array(ids, pa.int64()), pa.array(sizes),
                    pa.array([spans.get(d, []) for d in range(n)],
                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([items.get(d, []) for d in range(n)], pa.list_(pa.int64())),
                ], ["shard", "place", "doc_id", "n_words", "spans", "items"])

    return index.mapInArrow(per_shard, FOUND)


def phrases(items: list[tuple], words: int) -> list[tuple[np.ndarray, tuple]]:
    """Distinct phrases of the items with the ids of the items they stand in."""
    found: dict[bytes, set] = {}
    hashes, counts = word_hashes([text for _, text in items])
    at = 0
    for (item, _), n in zip(items, counts):
        own = hashes[at:at + n]
        at += n
        for i in range(max(1, n - words + 1) if n else 0):
            found.setdefault(own[i:i + words].tobytes(), set()).add(item)
    return [(np.frombuffer(k, np.uint64), tuple(sorted(v, key=lambda x: (x is None, x)))) for k, v in found.items()]


def find_phrases(shard: Shard, queries: list) -> Iterator[tuple]:
    lengths = np.asarray([len(q) for q, _ in queries])
    terms = shard.find(np.concatenate([q for q, _ in queries])) if queries else np.zeros(0, int)
    ends = np.cumsum(lengths) if queries else lengths
    if not queries:
        return
    for k in np.flatnonzero(np.minimum.reduceat(terms, ends - lengths) >= 0):
        starts = shard.phrase(terms[ends[k] - lengths[k]:ends[k]])
        if len(starts):
            yield starts, starts + lengths[k], queries[k][1]


def blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``limit`` bytes, dealt by the hash of their text."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-2 * size // limit)) if size > limit else 1
    for b in range(n):
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == b).distinct().collect()]


def match_phrases(index: DataFrame, benchmark: DataFrame, words: int = WORDS, id_col: str = "item_id",
                  text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, spans of words inside any phrase of ``words`` consecutive
    words of an item, and the items with such phrases."""
    return _matched([search(index, phrases(b, words), find_phrases)
                     for b in blocks(benchmark, id_col, text_col, block_bytes)])


def match_near(index: DataFrame, benchmark: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """As ``match_phrases`` for the shortest stretches of at most ``width`` words that hold all
    words of an item in any order."""
    def find_near(shard: Shard, queries: list) -> Iterator[tuple]:
        for wanted, items in queries:
            terms = shard.find(wanted)
            if len(terms) and terms.min() >= 0:
                starts, ends = shard.near(terms, width)
                if len(starts):
                    yield starts, ends, items

    def bags(items: list[tuple]) -> list:
        hashes, counts = word_hashes([text for _, text in items])
        cuts = np.split(hashes, np.cumsum(counts)[:-1]) if items else []
        return [(np.unique(h), (item,)) for (item, _), h in zip(items, cuts) if len(h)]

    return _matched([search(index, bags(b), find_near) for b in blocks(benchmark, id_col, text_col, block_bytes)])


def _matched(found: list[DataFrame]) -> DataFrame:
    if len(found) == 1:
        return found[0].select("doc_id", "n_words", "spans", "items")
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    rows = every.groupBy("shard", "place", "doc_id", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("s"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    one = F.array(F.element_at("s", 1))
    touch = lambda a, x: F.element_at(a, -1)["end"] >= x["start"]
    last = lambda a, x: F.struct(F.element_at(a, -1)["start"].alias("start"),
                                 F.greatest(F.element_at(a, -1)["end"], x["end"]).alias("end"))
    join = F.aggregate(F.slice("s", F.lit(2), F.size("s")), one, lambda a, x: F.when(
        touch(a, x), F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(last(a, x)))).otherwise(F.concat(a, F.array(x))))
    return rows.select("doc_id", "n_words", F.when(F.size("s") == 0, F.col("s")).otherwise(join).alias("spans"), "items")


def n_hit(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
