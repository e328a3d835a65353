"""Encoding and decoding with merge-type SentencePiece vocabularies.

``MergeVocabulary`` merges adjacent symbols by an agenda: a heap of pairs whose joined text is a
piece, best score first, leftmost first among equals; each merge offers its two new neighbours.
No piece of such a vocabulary holds a space mark after another character, so a text falls into
segments (a run of spaces with the word after it) that never merge with each other. Each segment
met for the first time by a worker is encoded by the agenda and compared, ids and decoded text,
with the sentencepiece library, all new segments of an Arrow batch in one call; so is one whole
text per batch. A difference raises an error.

Defined results: a null or empty text has no ids and decodes to ''; repeated rows are encoded
one by one; an empty table gives an empty table; a text may be of any length. Only the id and
text columns are read. As in the library, the character U+2581 decodes to a space.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import id_and_text, texts

MARK = "▁"
SEGMENT = re.compile(" +[^ ]*")
#: Characters up to which segments are merged many at a time.
SHORT = 32
#: Segments a worker remembers twice over; beyond that the ones not met again are forgotten.
REMEMBERED = 200_000
SCHEMA = "doc_id long, ids array<int>, decoded string"


class MergeVocabulary:
    def __init__(self, path: str):
        import sentencepiece
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.size = self.lib.get_piece_size()
        plain = [i for i in range(size) if not (self.lib.is_control(i) or self.lib.is_unknown(i)
                                               or self.lib.is_byte(i) or self.lib.is_unused(i))]
        self.ids = {self.lib.id_to_piece(i): i for i in plain}
        self.cost = {self.lib.id_to_piece(i): -self.lib.get_score(i) for i in plain}
        self.byte = [self.lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        raw = [self.lib.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)]
        for b, i in enumerate(self.byte):
            raw[i] = bytes((b,))
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.asarray([len(r) for r in raw])
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        #: The id of each character, those that are no piece above all ids.
        self.char = np.arange(size, size + 0x110000, dtype=np.int64)
        self.char[:128] = self.byte[:128]
        for p, i in self.ids.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.char[ord(" ")] = self.char[ord(MARK)]
        #: Adjacent ids that join to a piece: sorted keys, ids and costs of the pieces.
        pairs = sorted((self.pair_key(self.symbol(p[:k]), self.symbol(p[k:])), i)
                       for p, i in self.ids.items() for k in range(1, len(p))
                       if (k == 1 or p[:k] in self.ids) and (k == len(p) - 1 or p[k:] in self.ids))
        self.pairs = np.asarray([k for k, _ in pairs], np.int64)
        self.pair_id = np.asarray([i for _, i in pairs], np.int64)
        self.pair_cost = np.asarray([-self.lib.get_score(i) for _, i in pairs])
        #: False if a piece goes over a word's end; a whole text is then one segment.
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        #: Segments met lately, and those met before; only the first grows.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def symbol(self, text: str) -> int:
        return int(self.char[ord(text)]) if len(text) == 1 else self.ids[text]

    def pair_key(self, left, right):
        return left * (self.size + 0x110000) + right

    def segments(self, text: str | None) -> list[str]:
        if not text:
            return []
        spaced = " " + text.replace(MARK, " ")
        return SEGMENT.findall(spaced) if self.by_word else [spaced]

    def merge(self, symbols: list[str]) -> list[str]:
        """The symbols left when no adjacent pair on the agenda joins to a piece."""
        cost, n = self.cost, len(symbols)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(cost[p], i, p) for i in range(n - 1) if (p := symbols[i] + symbols[i + 1]) in cost]
        heapq.heapify(agenda)
        while agenda:
            _, i, piece = heapq.heappop(agenda)
            j = right[i]
            if not symbols[i] or j >= n or symbols[i] + symbols[j] != piece:
                continue  # one of the two has merged elsewhere
            symbols[i], symbols[j] = piece, ""
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if (p := piece + symbols[k]) in cost:
                    heapq.heappush(agenda, (cost[p], i, p))
            h = left[i]
            if h >= 0 and (p := symbols[h] + piece) in cost:
                heapq.heappush(agenda, (cost[p], h, p))
        return [s for s in symbols if s]

    def encode_segment(self, segment: str) -> list[int]:
        out: list[int] = []
        for s in self.merge(list(segment.replace(" ", MARK))):
            i = self.ids.get(s)
            if i is None:
                out += [self.byte[b] for b in s.encode()]
            else:
                out.append(i)
        return out

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and costs of the pieces that pairs of symbols join to; no piece: endless cost."""
        some = np.flatnonzero(right >= 0)
        keys = self.pair_key(left[some], right[some])
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        found = self.pairs[at] == keys
        some, at = some[found], at[found]
        made, cost = np.zeros(len(right), np.int64), np.full(len(right), np.inf)
        made[some], cost[some] = self.pair_id[at], self.pair_cost[at]
        return made, cost

    def merge_rows(self, symbols: np.ndarray) -> np.ndarray:
        """The same agenda for many short segments at once. Rows of symbols end in -1; column i of
        the agenda is the cost of the pair that begins at place i, so the first least cost of a
        row is the pair to merge."""
        width = symbols.shape[1]
        if width < 2:
            return symbols
        made, agenda = (x.reshape(len(symbols), width - 1) for x in self.pair(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()))
        rows, columns = np.arange(len(symbols)), np.arange(width)
        while width > 1:
            at = agenda.argmin(axis=1)
            own = np.arange(len(rows))
            active = np.isfinite(agenda[own, at])
            rows, agenda, made, at = rows[active], agenda[active], made[active], at[active]
            if not len(rows):
                break
            own = own[:len(rows)]
            line = symbols[rows, :width]
            line[own, at] = made[own, at]
            width -= 1  # each row left here has lost one symbol more
            line = line[columns[:width + 1] != at[:, None] + 1].reshape(len(rows), width)
            symbols[rows, :width] = line
            symbols[rows, width] = -1
            rest = columns[:width] != at[:, None]
            agenda, made = (x[rest].reshape(len(rows), width - 1) for x in (agenda, made))
            for place, ok in ((at, at < width - 1), (at - 1, at > 0)):
                r, c = own[ok], place[ok]
                made[r, c], agenda[r, c] = self.pair(line[r, c], line[r, c + 1])
        return symbols

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments one after another, and the number of ids of each."""
        sizes = np.asarray([len(s) for s in segments])
        codes = self.char[np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), "<u4")]
        starts = np.cumsum(sizes) - sizes
        alone = np.flatnonzero(sizes > SHORT).tolist()
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # places of segments, numbers of ids, ids
        for low, high in ((0, 6), (6, 10), (10, 16), (16, SHORT)):
            chosen = np.flatnonzero((sizes > low) & (sizes <= high))
            columns = np.arange(high)
            for some in np.array_split(chosen, max(1, len(chosen) // 20_000)):
                inside = columns < sizes[some][:, None]
                symbols = np.where(inside, codes[np.minimum(starts[some][:, None] + columns, len(codes) - 1)], -1)
                symbols = self.merge_rows(symbols)
                plain = (symbols < self.size).all(axis=1)
                alone += some[~plain].tolist()
                kept = (symbols >= 0) & plain[:, None]
                done.append((some[plain], kept.sum(axis=1)[plain], symbols[kept].astype(np.int32)))
        listed = [self.encode_segment(segments[k]) for k in alone]
        done.append((np.asarray(alone, np.int64), np.asarray([len(x) for x in listed], np.int64),
                     np.fromiter(chain.from_iterable(listed), np.int32)))
        counts = np.zeros(len(segments), np.int64)
        for places, n, _ in done:
            counts[places] = n
        begin = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        for places, n, ids in done:
            out[np.repeat(begin[places] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, counts

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The text of ids as bytes, a space before each word, and the bytes of each id."""
        sizes = self.raw_size[ids]
        ends = np.cumsum(sizes)
        place = np.repeat(self.raw_start[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.raw[place].tobytes(), sizes

    def learn(self, fresh: list[str]) -> None:
        """Encode segments by the agenda and compare them with the library."""
        ids, counts = self.encode_segments(fresh)
        bare = [s[1:] for s in fresh]
        theirs = self.lib.encode(bare, num_threads=1)
        back = self.lib.decode(theirs)
        ends = np.cumsum(counts)
        listed = np.fromiter(chain.from_iterable(theirs), np.int32)
        alone = [k for k, s in enumerate(fresh) if s == " "]  # the library adds no mark to nothing
        if alone or not (np.array_equal(listed, ids) and np.array_equal(counts, [len(t) for t in theirs])):
            for k, (s, other) in enumerate(zip(fresh, theirs)):
                mine = ids[ends[k] - counts[k]:ends[k]].tolist()
                if s != " " and mine != other:
                    raise ValueError(f"segment {s[:80]!r}: agenda {mine[:20]}, library {other[:20]}")
        if back != bare:
            s, decoded = next((s, d) for s, d in zip(bare, back) if s != d)
            raise ValueError(f"segment {s[:80]!r}: decoded {decoded[:80]!r}")
        if self.decode(ids)[0] != "".join(fresh).encode():
            raise ValueError("segments decode to another text")
        raw = ids.astype("<i4").tobytes()
        self.known.update((s, raw[4 * (e - n):4 * e]) for s, e, n in zip(fresh, ends.tolist(), counts.tolist()))

    def encode(self, values: list[str | None]) -> list[bytes]:
        """Ids (32-bit, little-endian) of each value."""
        split = [self.segments(v) for v in values]
        wanted = set(chain.from_iterable(split)).difference(self.known)
        if len(self.known) + len(wanted) > REMEMBERED:
            self.known, self.older = {}, self.known
            wanted = set(chain.from_iterable(split))
        known, older = self.known, self.older
        known.update((s, older[s]) for s in wanted.intersection(older))
        fresh = [s for s in wanted if s not in older]
        if fresh:
            self.learn(fresh)
        out = [b"".join([known[s] for s in segments]) for segments in split]
        for value, ids in zip(values, out):
            if value and len(value) <= 1 << 20:
                listed = self.lib.encode(value)
                mine = np.frombuffer(ids, "<i4")
                if not np.array_equal(listed, mine) or self.lib.decode(listed).encode() != self.decode(mine)[0][1:]:
                    raise ValueError(f"text {value[:80]!r}: the joined segments differ from the library")
                break
        return out

    def decode_all(self, encoded: list[bytes]) -> list[bytes]:
        """Decoded text of each value; the space before the first word goes."""
        ids = np.frombuffer(b"".join(encoded), "<i4")
        body, sizes = self.decode(ids)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *(len(e) // 4 for e in encoded)])].tolist()
        return [body[a + 1:b] for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> MergeVocabulary:
    return MergeVocabulary(path)


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and decoded text of every row. ``path``: the model file, on every machine."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = vocabulary(path)
        for keys, values in texts(batches, 1 << 20):
            found = book.encode(values)
            ends = np.cumsum([0, *(len(f) // 4 for f in found)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))
            decoded = pa.array(book.decode_all(found), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), ids, decoded], ["doc_id", "ids", "decoded"])

    return id_and_text(docs, id_col, text_col).mapInArrow(encode, SCHEMA)


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
