"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

A text is cut by the tokenizer's pattern. A cut that is no token itself is an array of the ids of
its bytes with the ranks of its neighbouring pairs; ``aggregate`` folds merges over it: the least
rank, leftmost first, joins its pair (a rank is the id of the joined piece), and the ranks on both
sides are looked up anew. The rank map is a constant: an array of numbers in which each left id has
a row of its right ids.

Tokens and common words are looked up whole in a second constant. The words are the commonest
``REMEMBERED`` of a sample of rows, folded once and collected (a bounded number); all others are
folded where they stand. So no text is shuffled, and the results depend on neither. A cut of over
``LONG`` bytes, where a fold would be quadratic, is merged by a heap in an Arrow batch.

Decoding takes the pieces of all ids of an Arrow batch at once and cuts them by rows.

Defined results: a null or empty text has no ids and decodes to no bytes; repeated rows are
encoded one by one; an empty table gives an empty table; a text may be of any length; only the id
and text columns are read, and a null id stays null.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections import Counter
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from flowguard.llm.common import id_and_text

#: Words (no tokens themselves) that are encoded once and kept in a constant.
REMEMBERED = 1 << 17
#: Rows of the sample, drawn by hash of the id, that tells common words. Any choice gives the same ids.
COUNTED_ROWS = 10_000
#: Bytes of a cut up to which merges are folded.
LONG = 256
#: Rank of a pair that joins to nothing.
NO_RANK = (1 << 20) - 1
#: Bits of a rank, and of the place and id of a piece.
RANK_BITS = 20
LOW_BITS = RANK_BITS + 20
#: Spreads a crc32 for its second slot.
SPREAD = 1103515245


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, as the end of a fold over nothing. Unlike an element
    of a transformed array, it does not work out the type of all that is inside at every step."""
    return F.aggregate(F.array(), value, lambda bound, _: bound, use)


def with_constants(df: DataFrame, **arrays: pa.Array) -> DataFrame:
    """Adds arrays as columns that are the same in all rows, for use in the next select alone. They
    are scalar subqueries over one local row, which the optimizer moves to where they are used: they
    run once, tasks get their bytes as they are, and the texts of plans, which Spark's listeners
    keep, name them instead of listing their elements."""
    table = lambda a: pa.table({"constant": pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)})
    return df.select("*", *(df.sparkSession.createDataFrame(table(a)).scalar().alias(name) for name, a in arrays.items()))


def literal_array(values: pa.Array) -> Column:
    """An array of strings or numbers as a literal, for small ones."""
    return F.split(F.lit("\uF8FF".join("" if v is None else str(v) for v in values.to_pylist())), "\uF8FF") \
            .cast("array<long>" if pa.types.is_integer(values.type) else "array<string>")


def java_pattern(pattern: str) -> str:
    """The pattern with the white space of Unicode, which Java's ``\\s`` is not."""
    inside = pattern.replace(r"[^\s", r"[^\p{IsWhite_Space}")
    return inside.replace(r"\S", r"[^\p{IsWhite_Space}]").replace(r"\s", r"\p{IsWhite_Space}")


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by piece, from lines of a base64 piece and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def whole_tokens(ranks: dict[bytes, int]) -> dict[str, list[int]]:
    """The tokens that are texts, with their ids."""
    found = {}
    for piece, rank in ranks.items():
        try:
            found[piece.decode()] = [rank]
        except UnicodeDecodeError:
            pass
    return found


class LiteralMap:
    """A map of strings as two constant arrays, bound once with ``let``: a key lies in one of two
    slots that its crc32 names, the value beside it."""

    def __init__(self, entries: dict):
        size = 1 << (16 + 11 * len(entries) // 5).bit_length()
        slots: list[str | None] = [None] * size
        held = Counter()
        self.left_out: list[str] = []
        for key in entries:
            crc = zlib.crc32(key.encode())
            held[crc] += 1
            if held[crc] > 2 or not self.put(slots, key):
                self.left_out.append(key)
        self.size = size
        self.keys = pa.array(slots, pa.string())
        values = pa.array([None if k is None else entries[k] for k in slots])
        self.values = values.cast(pa.list_(pa.int32())) if pa.types.is_list(values.type) else values

    @staticmethod
    def places(key: str, size: int) -> tuple[int, int]:
        crc = zlib.crc32(key.encode())
        return crc & size - 1, crc * SPREAD >> 20 & size - 1

    def put(self, slots: list, key: str) -> bool:
        """Place a key; keys in its way go to their other slot, and back if that does not end."""
        moved, at = [], self.places(key, len(slots))[0]
        for _ in range(200):
            moved.append((at, slots[at]))
            slots[at], key = key, slots[at]
            if key is None:
                return True
            one, two = self.places(key, len(slots))
            at = two if at == one else one
        for at, before in reversed(moved):
            slots[at] = before
        return False

    def bind(self, use: Callable[[Column, Column], Column]) -> Column:
        """``use`` with the arrays as literals."""
        return let(literal_array(self.keys), lambda keys: let(literal_array(self.values), lambda values: use(keys, values)))

    def get(self, keys: Column, values: Column, key: Column) -> Column:
        """The value of a key that is not empty, null without one; ``keys``, ``values``: bound literals."""
        def look(hashed: Column, otherwise: Column) -> Column:
            at = hashed.bitwiseAND(self.size - 1)
            return F.when(F.get(keys, at) == key, F.get(values, at)).otherwise(otherwise)

        return let(F.crc32(key), lambda crc: look(crc, look(F.shiftright(crc * SPREAD, 20), F.lit(None))))


class PairTable:
    """Ranks of the pairs of tokens that join to a token, in one constant array of numbers, bound
    once with ``let``: for each id where its row begins; the ids of the 256 bytes; then the rows,
    each in gaps of the others, a cell being the left id and the rank. So a look-up is two
    reads of an array, and no strings are made."""

    def __init__(self, ranks: dict[bytes, int]):
        self.names = max(ranks.values()) + 1
        rows: dict[int, dict[int, int]] = {}
        for piece, rank in ranks.items():
            for k in range(1, len(piece)):
                left, right = ranks.get(piece[:k]), ranks.get(piece[k:])
                if left is not None and right is not None:
                    rows.setdefault(left, {})[right] = rank
        begin = np.full(self.names, -(1 << 30), np.int64)
        cells = np.full(self.names + 3 * sum(map(len, rows.values())), -1, np.int64)
        draws = np.random.default_rng(0)  # the same table on every run
        for left, row in sorted(rows.items(), key=lambda r: (-len(r[1]), r[0])):
            right = np.fromiter(row, np.int64)
            at = self.gap(cells, right, draws)
            begin[left] = at
            cells[at + right] = (left << RANK_BITS) + np.fromiter(row.values(), np.int64)
        begin[begin >= 0] += 256 + self.names
        bytes_ = [ranks.get(bytes((b,)), -1) for b in range(256)]
        self.values = pa.array(np.concatenate([begin, np.asarray(bytes_, np.int64), cells]))

    @property
    def array(self) -> Column:
        return literal_array(self.values)

    def gap(self, cells: np.ndarray, right: np.ndarray, draws: np.random.Generator) -> int:
        """A place where a row fits; two thirds of the cells stay free."""
        while True:
            at = draws.integers(0, len(cells) - self.names, 64)
            fits = (cells[at[:, None] + right] < 0).all(axis=1)
            if fits.any():
                return int(at[fits.argmax()])

    def byte(self, table: Column, digit: Column) -> Column:
        return F.get(table, digit + self.names)

    def rank(self, table: Column, left: Column, right: Column) -> Column:
        """The rank of a pair; ``NO_RANK`` if it joins to nothing or one of the two is missing."""
        # A cell of another left id differs by less than zero or by more than any rank.
        cell = F.get(table, F.get(table, left) + right)
        return F.least((cell - F.shiftleft(left, RANK_BITS)).bitwiseAND((1 << 63) - 1), F.lit(NO_RANK).cast("long"))


class RankFold:
    """Merges over an array of pieces; ``table`` is the bound literal of ``map``. An element is a
    number: the rank of the piece with the next one, the byte where the piece begins, its id. So
    the least element is the pair to merge, the leftmost of the least rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.map = PairTable(ranks)

    @staticmethod
    def name(element: Column) -> Column:
        return element.bitwiseAND((1 << RANK_BITS) - 1)

    def element(self, table: Column, piece: Column, after: Column) -> Column:
        """A piece (its place and id) with the rank it has with the id ``after``."""
        return F.shiftleft(self.map.rank(table, self.name(piece), after), LOW_BITS).bitwiseOR(piece)

    def ids(self, table: Column, digits: Column) -> Column:
        """Ids of a word of at least one byte, given as ``digits``."""
        # A piece stands before the first, so each pair has one on its left; the last has none on its right.
        def fold(pieces: Column) -> Column:
            begin = F.zip_with(pieces, F.slice(pieces, F.lit(2), F.size(pieces)), lambda p, q: self.element(table, p, self.name(q)))
            return F.aggregate(pieces, begin, lambda state, _: self.merged(table, state))

        head = F.array(F.lit((1 << RANK_BITS) - 1).cast("long"))
        pieces = F.concat(head, F.transform(digits, lambda d, i: self.map.byte(table, d).bitwiseOR(F.shiftleft((i + 1).cast("long"), RANK_BITS))))
        return let(let(pieces, fold), lambda done: F.transform(F.slice(done, F.lit(2), F.size(done)), lambda e: self.name(e).cast("int")))

    def merged(self, table: Column, state: Column) -> Column:
        """The state after one merge; without a pair to merge, the state itself."""
        place = lambda e: e.bitwiseAND((1 << LOW_BITS) - (1 << RANK_BITS))

        def join(least: Column, begin: Column, n: Column) -> Column:
            """``begin``: place of the pair; ``n``: pieces before it; the rank is the id of the joined piece."""
            rank = F.shiftright(least, LOW_BITS)
            return let(F.get(state, n - 1), lambda before: let(F.get(state, n + 1), lambda right: swapped(
                least, before, right, n, self.element(table, before.bitwiseAND((1 << LOW_BITS) - 1), rank),
                self.element(table, begin.bitwiseOR(rank), self.name(F.get(state, n + 2))))))

        def swapped(least, before, right, n, *made):
            # No two elements are equal, as each has its own place.
            removed = F.array_remove(F.array_remove(F.array_remove(state, right), least), before)
            return F.array_insert(F.array_insert(removed, n, made[0]), n + 1, made[1])

        # The pair's place is counted: array_position leaves its loop by an exception, which was the dearest step of a merge.
        return let(F.array_min(state), lambda least: F.when(least < NO_RANK << LOW_BITS, let(place(least), lambda begin: let(
            F.size(F.filter(state, lambda e: place(e) < begin)), lambda n: join(least, begin, n)))).otherwise(state))


def merge_by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges in n log n steps."""
    if word in ranks:
        return [ranks[word]]
    pieces = [word[i:i + 1] for i in range(len(word))]
    n = len(pieces)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, p) for i in range(n - 1) if (r := ranks.get(p := pieces[i] + pieces[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, piece = heapq.heappop(heap)
        j = right[i]
        if not pieces[i] or j >= n or pieces[i] + pieces[j] != piece:
            continue  # one of the two has merged elsewhere
        pieces[i], pieces[j] = piece, b""
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            if (r := ranks.get(p := piece + pieces[k])) is not None:
                heapq.heappush(heap, (r, i, p))
        h = left[i]
        if h >= 0 and (r := ranks.get(p := pieces[h] + piece)) is not None:
            heapq.heappush(heap, (r, h, p))
    return [ranks[p] for p in pieces if p]


def long_words(path: str):
    """Ids of the words of an array, by the heap; most arrays are empty."""
    @F.pandas_udf("array<array<int>>")
    def encode(column: pd.Series) -> pd.Series:
        ranks = None
        out = []
        for words in column:
            if len(words) and ranks is None:
                ranks = read_ranks(path)
            out.append([merge_by_heap(w.encode(), ranks) for w in words])
        return pd.Series(out)

    return encode


def cuts(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


def digits(word: Column) -> Column:
    """The bytes of a word as numbers."""
    return F.transform(F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), ""), F.ascii)


def is_long(word: Column) -> Column:
    return F.octet_length(word) > LONG


def common_words(words: DataFrame, fold: RankFold, tokens: set[str], limit: int) -> dict[str, list[int]]:
    """Ids of the ``limit`` commonest words that are no tokens; ``words`` has arrays
    of words."""
    word = F.col("word")
    counted = words.select(F.explode("words").alias("word")).filter(~is_long(word)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(limit).repartition(words.sparkSession.sparkContext.defaultParallelism)
    ids = let(F.col("pairs"), lambda t: fold.ids(t, digits(word)))
    coded = with_constants(top, pairs=fold.map.values).select("word", F.array_join(ids.cast("array<string>"), ",").alias("ids"))  # small in the driver
    return {word: [int(i) for i in listed.split(",")] for word, listed in coded.collect() if word not in tokens}


def encode_bytes(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 remembered: int = REMEMBERED) -> DataFrame:
    """doc_id and ids of every row. ``path``: the file of ranks, on every machine."""
    ranks = read_ranks(path)
    fold, heap = RankFold(ranks), long_words(path)
    docs = id_and_text(docs, id_col, text_col)
    split = lambda rows: rows.select("doc_id", cuts(F.col("text"), pattern).alias("words"))
    place = F.pmod(F.xxhash64("doc_id", F.lit("words")), F.lit(1 << 30)) / (1 << 30)
    some = docs.filter(place < COUNTED_ROWS / max(1, docs.count()))
    tokens = whole_tokens(ranks)
    known = LiteralMap(tokens | common_words(split(some), fold, set(tokens), remembered))
    if known_tokens := tokens.keys() & set(known.left_out):
        raise ValueError(f"no place for the tokens {sorted(known_tokens)}")
    both = split(docs).select("doc_id", "words", F.filter("words", is_long).alias("long")).withColumn("long_ids", heap("long"))

    def ids(table: Column, keys: Column, values: Column, word: Column) -> Column:
        """The ids of a word."""
        listed = F.get(F.col("long_ids"), F.array_position("long", word).cast("int") - 1)
        return F.coalesce(known.get(keys, values, word), F.when(is_long(word), listed).otherwise(fold.ids(table, digits(word))))

    written = let(F.col("known_keys"), lambda keys: let(F.col("known_ids"), lambda values: let(F.col("pairs"), lambda table: F.flatten(
        F.transform("words", lambda word: ids(table, keys, values, word))))))
    return with_constants(both, known_keys=known.keys, known_ids=known.values, pairs=fold.map.values).select("doc_id", written.alias("ids"))


@lru_cache(maxsize=2)
def read_pieces(path: str) -> pa.Array:
    """Pieces by id, then an empty one for ids that have none."""
    pieces = {rank: piece for piece, rank in read_ranks(path).items()}
    return pa.array([pieces.get(i, b"") for i in range(max(pieces) + 2)], pa.binary())


def per_row(ids: pa.Array, ends: np.ndarray, data: pa.Buffer) -> pa.Array:
    """One binary per list of ``ids``; ``ends``: where in ``data`` the bytes of each flattened id begin, and the end."""
    rows = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    made = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends[rows].astype(np.int32)), data])
    return pc.if_else(ids.is_valid(), made, None) if ids.null_count else made


def piece_bytes(path: str):
    """The pieces of the ids of an array, one after the other."""
    @F.arrow_udf(BinaryType())
    def decode(ids: pa.Array) -> pa.Array:
        pieces = read_pieces(path)
        flat = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
        none = len(pieces) - 1
        taken = pieces.take(pa.array(np.where((flat < 0) | (flat > none), none, flat)))
        _, ends, data = taken.buffers()
        ends = np.frombuffer(ends, np.int32, len(taken) + 1, 4 * taken.offset) if len(taken) else np.zeros(1, np.int32)
        return per_row(ids, ends, data or pa.py_buffer(b""))

    return decode


@F.arrow_udf(BinaryType())
def id_bytes(ids: pa.Array) -> pa.Array:
    """The ids of an array, four bytes each, the lowest first."""
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
    return per_row(ids, 4 * np.arange(len(flat) + 1, dtype=np.int64), pa.py_buffer(flat.tobytes()))


def decode_bytes(encoded: DataFrame, path: str) -> DataFrame:
    """Adds the bytes that the pieces of the ids make."""
    return encoded.withColumn("decoded", piece_bytes(path)("ids"))


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and digests; an id is four bytes, the lowest first."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(id_bytes("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
