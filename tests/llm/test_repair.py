import hashlib
import random
import zlib
from itertools import groupby

import pytest

from flowguard.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, part string, seq int, copy boolean"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(rows):
    """Least (cost, letters) and its turns by dynamic programming over whole scripts, from the end."""
    blanks, seen, marked = " \t\n\x0b\x0c\r", set(), []
    for role, text in rows:
        body = text.strip(blanks)
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, kind))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {q: (0, "", ()) if q in ("", "a") else None for q in follow}

    def add(cost, letter, turn, rest):
        return None if rest is None else (cost + rest[0], letter + rest[1], ((turn,) if turn else ()) + rest[2])

    def least(options):
        return min((o for o in options if o is not None), key=lambda o: o[:2], default=None)

    def inserted(best):
        for _ in range(3):
            best = {q: least([b] + [add(2, "I", ({"u": "user", "a": "assistant"}[n], ""), best[n]) for n in follow[q] if n != "s"])
                    for q, b in best.items()}
        return best

    best = inserted(best)
    for role, text, kind in reversed(marked):
        extra = kind == "truncated"
        made = {}
        for q in follow:
            options = [add(3, "D", None, best[q])]
            if kind in ("", "truncated"):
                if role[:1] and role[:1] in follow[q]:
                    options.append(add(extra, "K", (role, text), best[role[:1]]))
                options += [add(2 + extra, "R", ({"u": "user", "a": "assistant"}[n], text), best[n]) for n in follow[q] if n != "s"]
            made[q] = least(options)
        best = inserted(made)
    return marked, best[""]


def brute(rows):
    out = []
    ids = sorted({r[0] for r in rows}, key=lambda c: (c is not None, c))
    kept = damage(rows)
    for conv in ids:
        own = sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        marked, (cost, audit, turns) = cheapest([r[2:] for r in own])
        numbers = [r[1] for r in own if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        count = lambda kind: sum(m[2] == kind for m in marked)
        text = "\n".join(f"{r}:{t}" for r, t in turns)
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def talks(seed, count=80, most=25):
    rng, rows = random.Random(seed), []
    for conv in range(count):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "umpire"])
            text = rng.choice(["yes.", "no!", "why?", "cut off", " \t", "", None, f"n{rng.randint(0, 9)}.", "a\nb. \n"])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]) if seed % 2 else turn, role, text))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, True) for r in rows], SCHEMA)


def result(spark, rows):
    return sorted((tuple(r) for r in repair.summaries(repair.repair_conversations(repair.damaged(table(spark, rows)))).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = talks(seed)
    got = result(spark, rows)
    assert got == brute(rows) and sum(len(r[7]) for r in got) > 500


@pytest.mark.parametrize("size", [1, 3, 7])
def test_cut_conversations(spark, monkeypatch, size):
    rows = talks(4, 8, 60)
    monkeypatch.setattr(repair, "PIECE_TURNS", size)
    assert result(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (1, None, None, None), (2, 5, "user", "word. " * 30_000),
            (2, 6, "assistant", "ok."), (3, 3, "system", "Be kind."), (4, 1, "user", "a."), (4, 1, "user", "a."), (4, 1, "user", "a.")]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_conversation_of_dropped_turns(spark):
    conv = next(i for i in range(1_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert result(spark, [(conv, 0, "user", "x.")]) == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_blocks_equal_single_symbols():
    book, rng = repair.blocks(), random.Random(5)
    for _ in range(200):
        symbols = [rng.randrange(repair.SYMBOLS) for _ in range(rng.randint(0, 30))]
        v = book.end
        for s in reversed(symbols):
            v = int(book.step[v, s])
        starts, states = book.table(symbols)
        assert starts[book.end] == v
        for q in range(repair.STATES):
            assert book.trace(symbols, book.end, q)[1] == states[book.end * repair.STATES + q]
    assert book.size < 100


def test_ties_take_the_first_letters():
    # A lone system turn: deleted (3), not kept with two inserts (4).
    assert repair.edited({"conv_id": 1, "part": 0, "seq": 0, "turns": [0], "roles": ["system"], "texts": ["x."]}, (), 0, 0, True)[10:12] == (3, "D")
    roles = ["user", "user", "assistant"]
    row = repair.edited({"conv_id": 1, "part": 0, "seq": 0, "turns": [0, 1, 2], "roles": roles, "texts": ["a.", "b.", "c."]}, (), 0, 0, True)
    assert row[10:12] == (2, "KIKK")


def test_pieces_hold_every_turn(spark):
    rows = talks(2, 30)
    got = [r for r in repair.pieces_of(repair.damaged(table(spark, rows))).collect()]
    assert sum(len(r.turns) for r in got) == len(damage(rows))
    for _, own in groupby(sorted(got, key=lambda r: (r.conv_id, r.part, r.seq)), key=lambda r: r.conv_id):
        own = list(own)
        assert len(own) == 1 or not any(r.whole for r in own)
