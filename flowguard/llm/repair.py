"""Repair of conversation structure: the cheapest edits that make roles follow ``(s?(ua)+)?``.

Edits: keep a turn (0), give it the role user or assistant (2), delete it (3), insert an empty
turn (2); a truncated turn that stays costs 1 more, blank and repeated turns must go. Of equal
costs the edits whose initials come first in ASCII are taken.

The least cost to go is a vector over the states of the pattern (nothing yet, after s, after u,
after a). Less its minimum only few such vectors exist, so ``Blocks`` knows in advance what every
block of four symbols makes of each (Four Russians). A conversation is a walk from its end through
the blocks; then each block is expanded once more, backwards from the vector at its end, and read
from the front: the first letter in ASCII order that keeps the least cost is the right one, for the
letters so far say which state the repaired turns are in.

No conversation is gathered in one task. Turns are dealt by ranges of (conversation, turn, role,
text), so a conversation may lie in many partitions, and packed into pieces of bounded size. The
pieces of a cut conversation give, for every vector at their end, the vector at their start and
the state reached; these small tables are chained per conversation, and every piece is then edited
alone. Only the digest of a conversation is streamed, piece by piece.

Defined results: a null role or text is one space; null turns come first, equal turns are ordered
by role and text; a null conversation id is one conversation; repeated rows are repeated turns;
an empty table gives an empty table; texts may be of any length. A conversation without present
turns has zeros, no edits and the digest of nothing. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import parts, stage

BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
#: Turns and bytes of text of a piece at most (one turn at least).
PIECE_TURNS = 4096
PIECE_BYTES = 1 << 20
BLOCK = 4

# Symbols: 0 nothing, 1 a turn that must go, then two for each kind of role: whole, truncated.
KINDS = "sua"
SYMBOLS = 2 + 2 * (len(KINDS) + 1)
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = 4
#: State after a turn that the pattern asks for next, and its role.
NEXT = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U, AFTER_U: AFTER_A}
ROLE = {AFTER_U: "user", AFTER_A: "assistant"}
DELETE, RENAME, INSERT = 3, 2, 2

PIECE = ("conv_id long, part int, seq int, whole boolean, turns array<long>, roles array<string>, texts array<string>")
EDITED = ("conv_id long, part int, seq int, turns array<long>, blank long, duplicate long, truncated long, illegal long, "
          "first_initial string, last_initial string, cost long, audit string, roles array<string>, texts array<string>")
SUMMARY = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def symbol(role: str, truncated: bool) -> int:
    kind = KINDS.find(role[:1]) if role else -1
    return 2 + 2 * (kind if kind >= 0 else len(KINDS)) + truncated


def kept_state(state: int, kind: int) -> int | None:
    """State after a turn of a kind is kept, None if the pattern forbids it."""
    if kind == 0:
        return AFTER_S if state == START else None
    if kind == len(KINDS):
        return None
    wanted = NEXT[state]
    return wanted if wanted == (AFTER_U if kind == 1 else AFTER_A) else None


class Blocks:
    """Transitions of normalised cost vectors, for single symbols and for every block."""

    def __init__(self):
        end = self.with_inserts([0, 9, 9, 0])
        self.vectors, ids, self.end = [end], {end: 0}, 0
        step, rise = [], []
        for v in self.vectors:  # grows while it is walked
            step.append([])
            rise.append([])
            for s in range(SYMBOLS):
                costs = self.stepped(v, s)
                least = min(costs)
                made = tuple(c - least for c in costs)
                if made not in ids:
                    ids[made] = len(self.vectors)
                    self.vectors.append(made)
                step[-1].append(ids[made])
                rise[-1].append(least)
        self.step, self.rise = np.asarray(step, np.int16), np.asarray(rise, np.int16)
        self.size = len(self.vectors)
        moves = [[[self.letters(q, s, v) for v in self.vectors] for s in range(SYMBOLS)] for q in range(STATES)]
        self.letter = moves
        self.state = np.asarray([[[state for _, state in row] for row in of] for of in moves], np.int8)
        code = np.arange(SYMBOLS ** BLOCK)
        self.block = np.repeat(np.arange(self.size, dtype=np.int16)[:, None], len(code), axis=1)
        self.block_rise = np.zeros(self.block.shape, np.int16)
        for k in range(BLOCK):  # from the last symbol of a block to its first
            s = code // SYMBOLS ** k % SYMBOLS
            self.block_rise += self.rise[self.block, s]
            self.block = self.step[self.block, s]

    @staticmethod
    def with_inserts(costs: list[int]) -> tuple[int, ...]:
        for _ in range(STATES):
            costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
        return tuple(costs)

    def choices(self, q: int, s: int, after: tuple[int, ...]) -> Iterator[tuple[str, int, int]]:
        """Edits of the turn itself: letter, cost to go, state."""
        yield "D", DELETE + after[q], q
        if s > 1:
            kind, truncated = divmod(s - 2, 2)
            kept = kept_state(q, kind)
            if kept is not None:
                yield "K", truncated + after[kept], kept
            yield "R", RENAME + truncated + after[NEXT[q]], NEXT[q]

    def stepped(self, after: tuple[int, ...], s: int) -> tuple[int, ...]:
        if s == 0:
            return after
        return self.with_inserts([min(c for _, c, _ in self.choices(q, s, after)) for q in range(STATES)])

    def letters(self, q: int, s: int, after: tuple[int, ...]) -> tuple[str, int]:
        """The first letters of least cost that lead past a symbol, and the state then."""
        if s == 0:
            return "", q
        costs, out = self.stepped(after, s), ""
        while True:
            own = {letter: state for letter, cost, state in self.choices(q, s, after) if cost == costs[q]}
            if costs[q] == INSERT + costs[NEXT[q]]:
                own["I"] = NEXT[q]
            letter = min(own)
            out, q = out + letter, own[letter]
            if letter != "I":
                return out, q

    def codes(self, symbols: list[int]) -> np.ndarray:
        """Block codes; nothing is put before the first symbol to fill its block."""
        padded = np.zeros(-(-len(symbols) // BLOCK) * BLOCK, np.int64)
        if symbols:
            padded[len(padded) - len(symbols):] = symbols
        return padded.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK)[::-1])

    def boundaries(self, codes: np.ndarray, end: int) -> list[int]:
        """Vectors at the ends of the blocks, found from the last block on."""
        out = [end]
        for c in codes[:0:-1].tolist():
            out.append(int(self.block[out[-1], c]))
        return out[::-1]

    def trace(self, symbols: list[int], end: int, state: int) -> tuple[list[str], int]:
        """Letters of every symbol, and the state after the last."""
        codes = self.codes(symbols)
        blocks = [0] * (len(codes) * BLOCK - len(symbols)) + symbols
        out: list[str] = []
        for k, v in enumerate(self.boundaries(codes, end) if symbols else []):
            inside = blocks[k * BLOCK:(k + 1) * BLOCK]
            after = [v]
            for s in inside[:0:-1]:
                after.append(int(self.step[after[-1], s]))
            for s, v in zip(inside, after[::-1]):
                letters, state = self.letter[state][s][v]
                out.append(letters)
        return out[len(out) - len(symbols):], state

    def table(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """For every vector at the end: the vector at the start, and the state reached from each."""
        codes = self.codes(symbols)
        ends = [np.arange(self.size)]
        for c in codes[::-1].tolist():
            ends.append(self.block[ends[-1], c])
        state = np.tile(np.arange(STATES), (self.size, 1))
        blocks = [0] * (len(codes) * BLOCK - len(symbols)) + symbols
        for k, v in enumerate(ends[-2::-1] if symbols else []):
            inside = blocks[k * BLOCK:(k + 1) * BLOCK]
            after = [v]
            for s in inside[:0:-1]:
                after.append(self.step[after[-1], s])
            for s, v in zip(inside, after[::-1]):
                state = self.state[state, s, np.asarray(v)[:, None]]
        return ends[-1].tolist(), state.ravel().tolist()


@lru_cache(maxsize=1)
def blocks() -> Blocks:
    return Blocks()


# -- pieces ----------------------------------------------------------------------------------

def pieces_of(turns: DataFrame) -> DataFrame:
    """Present turns in order, in pieces of bounded size. ``turns``: conv_id, turn, role, text,
    present; a conversation of absent turns has one piece without turns."""
    cut = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "present",
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    # A short key: the head and digest of a text, and a number that parts rows equal in all else.
    keyed = cut.withColumns({"head": F.substring("text", 1, 64), "digest": F.md5("text"), "salt": F.monotonically_increasing_id()})
    order = ["conv_id", "turn", "role", "head", "digest", "salt"]
    dealt = keyed.repartitionByRange(parts(turns.sparkSession), *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def rows():
            for b in batches:
                yield from zip(*(b.column(i).to_pylist() for i in range(5)))

        held, size, seen = [], 0, 0
        for conv, own in groupby(rows(), key=lambda r: r[0]):
            seen += 1
            made, turn, role, text, used = [], [], [], [], 0
            for _, t, r, x, present in own:
                if not present:
                    continue
                if turn and (len(turn) >= PIECE_TURNS or used + len(x) > PIECE_BYTES):
                    made.append((turn, role, text))
                    turn, role, text, used = [], [], [], 0
                    if len(made) > 1:  # a long conversation goes out as it is read
                        yield packed([(conv, part, k, False, *p) for k, p in enumerate(made[-2:-1], len(made) - 2)])
                        made[-2] = None
                turn.append(t)
                role.append(r)
                text.append(x)
                used += len(x)
            made.append((turn, role, text))
            whole = seen > 1 and len(made) == 1
            held += [(conv, part, k, whole, *p) for k, p in enumerate(made) if p]
            size += used
            if size > PIECE_BYTES or len(held) >= PIECE_TURNS:
                yield packed(held[:-1])
                held, size = held[-1:], 0
        if held:  # the last conversation may go on in the next partition
            yield packed(held[:-1] + [(*held[-1][:3], False, *held[-1][4:])])

    return dealt.select("conv_id", "turn", "role", "text", "present").mapInArrow(pack, PIECE)


def packed(rows: list[tuple]) -> pa.RecordBatch:
    c = list(zip(*rows)) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays(
        [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()), pa.array(c[2], pa.int32()), pa.array(c[3], pa.bool_()),
         pa.array(c[4], pa.list_(pa.int64())), pa.array(c[5], pa.list_(pa.string())), pa.array(c[6], pa.list_(pa.string()))],
        ["conv_id", "part", "seq", "whole", "turns", "roles", "texts"])


def mark(role: str, text: str) -> bytes:
    return hashlib.sha256(role.encode() + b"\0" + text.encode()).digest()


class Faults:
    """Symbols and counts of the turns of a piece; ``earlier``: digests of turns of pieces before."""

    def __init__(self, roles: list[str], texts: list[str], earlier=()):
        seen, self.symbols = set(earlier), []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        before = None
        for role, text in zip(roles, texts):
            body, key = text.rstrip(BLANKS), mark(role, text)
            if not body:
                self.blank += 1
                self.symbols.append(1)
            elif key in seen:
                self.duplicate += 1
                self.symbols.append(1)
            else:
                self.truncated += not body.endswith(ENDS)
                self.symbols.append(symbol(role, not body.endswith(ENDS)))
            seen.add(key)
            self.illegal += before is not None and not legal(before, role[:1])
            before = role[:1]


def legal(first: str, second: str) -> bool:
    return first + second in ("su", "ua", "au")


def edited(piece: dict, earlier, end: int, state: int, last: bool) -> tuple:
    """A row of ``EDITED``: a piece after its edits."""
    book, faults = blocks(), Faults(piece["roles"], piece["texts"], earlier)
    letters, at = book.trace(faults.symbols, end, state)
    if last:
        closing = ""
        while at in (AFTER_S, AFTER_U):
            closing, at = closing + "I", NEXT[at]
        letters = letters + [closing]
    roles, texts, cost = [], [], 0
    for k, chain in enumerate(letters):
        for letter in chain:
            if letter == "D":
                cost += DELETE
                continue
            if letter == "K":
                state = kept_state(state, (faults.symbols[k] - 2) // 2)
                roles.append(piece["roles"][k])
            else:
                state = NEXT[state]
                roles.append(ROLE[state])
                cost += RENAME if letter == "R" else INSERT
            texts.append("" if letter == "I" else piece["texts"][k])
            cost += letter != "I" and faults.symbols[k] % 2
    return (piece["conv_id"], piece["part"], piece["seq"], piece["turns"], faults.blank, faults.duplicate, faults.truncated,
            faults.illegal, piece["roles"][0][:1] if piece["roles"] else None, piece["roles"][-1][:1] if piece["roles"] else None,
            cost, "".join(letters), roles, texts)


def edited_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), *[pa.int64()] * 4, pa.string(), pa.string(), pa.int64(),
             pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      [f.split()[0] for f in EDITED.split(", ")])


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, so that a batch of large pieces is not unpacked at once."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def edit_whole(pieces: DataFrame) -> DataFrame:
    """Edits of conversations that are one piece."""
    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in rows_of(batches):
            held.append(edited(row, (), blocks().end, START, True))
            size += sum(map(len, row["texts"]))
            if size > PIECE_BYTES:
                yield edited_batch(held)
                held, size = [], 0
        if held:
            yield edited_batch(held)

    return pieces.mapInArrow(edit, EDITED)


def with_earlier(pieces: DataFrame) -> DataFrame:
    """Adds the digests of the turns of a piece that an earlier piece of the conversation has."""
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            own = list({mark(r, t) for r, t in zip(row["roles"], row["texts"])})
            n = len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["conv_id"]] * n, pa.int64()), pa.array([row["part"]] * n, pa.int32()),
                 pa.array([row["seq"]] * n, pa.int32()), pa.array(own, pa.binary())], ["conv_id", "part", "seq", "digest"])

    marks = pieces.mapInArrow(digests, "conv_id long, part int, seq int, digest binary")
    first = marks.groupBy("conv_id", "digest").agg(F.min(F.struct("part", "seq")).alias("first")).alias("f")
    marks = marks.alias("m")
    again = marks.join(first, F.col("m.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("m.digest") == F.col("f.digest"))) \
        .filter(F.struct("m.part", "m.seq") > F.col("f.first"))
    lists = again.groupBy(F.col("m.part").alias("part"), F.col("m.seq").alias("seq"), F.col("m.conv_id").alias("of")) \
        .agg(F.collect_list("m.digest").alias("earlier")).alias("e")
    p = pieces.alias("p")
    same = (F.col("p.part") == F.col("e.part")) & (F.col("p.seq") == F.col("e.seq")) & F.col("p.conv_id").eqNullSafe(F.col("e.of"))
    return p.join(lists, same, "left").select("p.*", F.coalesce("e.earlier", F.array().cast("array<binary>")).alias("earlier"))


def edit_cut(pieces: DataFrame) -> DataFrame:
    """Edits of conversations that may lie in several pieces."""
    told = stage(with_earlier(pieces), "cut-pieces")

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            start, state = blocks().table(Faults(row["roles"], row["texts"], row["earlier"]).symbols)
            yield pa.RecordBatch.from_pylist([{"conv_id": row["conv_id"], "part": row["part"], "seq": row["seq"], "start": start, "state": state}],
                                             pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()),
                                                        ("start", pa.list_(pa.int16())), ("state", pa.list_(pa.int8()))]))

    def chain(table: pa.Table) -> pa.Table:
        """The vector at the end and the state at the start of every piece of one conversation."""
        t = table.sort_by([("part", "ascending"), ("seq", "ascending")])
        starts, states = t["start"].to_pylist(), t["state"].to_pylist()
        ends, v = [], blocks().end
        for s in reversed(starts):
            ends.append(v)
            v = s[v]
        begin, q = [], START
        for v, s in zip(reversed(ends), states):
            begin.append(q)
            q = s[v * STATES + q]
        last = [False] * (len(starts) - 1) + [True]
        return pa.table([t["conv_id"], t["part"], t["seq"], pa.array(ends[::-1], pa.int32()), pa.array(begin, pa.int32()), pa.array(last)],
                        ["conv_id", "part", "seq", "end_vector", "begin_state", "last"])

    small = told.mapInArrow(tables, "conv_id long, part int, seq int, start array<short>, state array<byte>")
    chained = small.groupBy("conv_id").applyInArrow(
        chain, "conv_id long, part int, seq int, end_vector int, begin_state int, last boolean").alias("c")
    p = told.alias("p")
    same = (F.col("p.part") == F.col("c.part")) & (F.col("p.seq") == F.col("c.seq")) & F.col("p.conv_id").eqNullSafe(F.col("c.conv_id"))
    ready = p.join(chained, same).select("p.*", "c.end_vector", "c.begin_state", "c.last")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            yield edited_batch([edited(row, row["earlier"], row["end_vector"], row["begin_state"], row["last"])])

    return ready.mapInArrow(edit, EDITED)


def repair_conversations(turns: DataFrame) -> DataFrame:
    """Pieces of the repaired conversations, in the order of (part, seq): roles and texts after the
    edits, the letters of the edits, and the counts of faults before."""
    pieces = stage(pieces_of(turns), "pieces")
    return edit_whole(pieces.filter("whole")).unionByName(edit_cut(pieces.filter("NOT whole")))


def summaries(repaired: DataFrame) -> DataFrame:
    """One row per conversation: gaps between turns, faults, edits, and the digest of the result."""
    order = ["conv_id", "part", "seq"]
    dealt = repaired.repartition(parts(repaired.sparkSession), "conv_id").sortWithinPartitions(*order)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for conv, own in groupby(rows_of(batches), key=lambda r: r["conv_id"]):
            counts, audit, digest, begun = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0), [], hashlib.sha256(), False
            low = high = initial = None
            distinct = 0
            for row in own:
                for name in counts:
                    counts[name] += row[name]
                if initial is not None and row["first_initial"] is not None:
                    counts["illegal"] += not legal(initial, row["first_initial"])
                initial = initial if row["last_initial"] is None else row["last_initial"]
                for t in row["turns"]:
                    if t is not None and t != high:
                        low, high, distinct = t if low is None else low, t, distinct + 1
                audit.append(row["audit"])
                for role, text in zip(row["roles"], row["texts"]):
                    digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                    begun = True
            gaps = high - low + 1 - distinct if distinct else 0
            held.append((conv, gaps, *counts.values(), "".join(audit), digest.hexdigest()))
            if len(held) >= PIECE_TURNS:
                yield summary_batch(held)
                held = []
        if held:
            yield summary_batch(held)

    return dealt.mapInArrow(fold, SUMMARY)


def summary_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in SUMMARY.split(", ")])


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults made by the crc32 of their conversation and number; dropped ones stay as
    absent turns, so that no conversation is lost."""
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    named = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                         (F.crc32(place) % 20).alias("fault"))
    fault = F.col("fault")
    return named.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (fault != 0).alias("present"), F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    ).drop("copy")
