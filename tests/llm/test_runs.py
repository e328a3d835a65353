import hashlib
import random
import zlib

import numpy as np
import pytest

from flowguard.llm.runs import (LEAST, SCHEMA, Grammar, collapse, digests, find_runs, numbered, periodic_runs, planted,
                                split_words)
from tests.llm.helpers import frame, prose


def brute_runs(words):
    """(start, length, period) of all runs, by comparing words."""
    n, least = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i >= p and j + p - i >= LEAST:
                least.setdefault((i, j + p - i), p)
            i = j + 1
    return sorted((s, k, p) for (s, k), p in least.items())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_row(doc_id, text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, k, p in runs for i in range(s + p, s + k)}
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            sha("".join(f"{s},{k},{p}\n" for s, k, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def texts_with_runs(seed, count=120):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        letters = "abcdefghij"[:rng.choice([1, 2, 3, 10])]
        words = [rng.choice(letters) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 4)):
            unit = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
            words += (unit * 12)[:rng.randint(5, 60)] + [rng.choice(letters) for _ in range(rng.randint(0, 5))]
        out.append(" ".join(words))
    return out


def found(lists):
    words, starts, ends = numbered(lists)
    rows = find_runs(words, starts, ends)
    return [[(s - a, e - s, p) for s, e, p in rows.tolist() if a <= s < b] for a, b in zip(starts.tolist(), ends.tolist())]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    lists = [split_words(t) for t in texts_with_runs(seed)]
    assert found(lists) == [brute_runs(w) for w in lists]
    assert sum(map(len, found(lists))) > 50


def test_extensions_equal_comparing():
    rng = np.random.default_rng(3)
    for letters in (1, 2, 4):
        inner = rng.integers(0, letters, 400)
        words = np.concatenate([[-1], inner[:200], [-2], inner[200:], inner[200:290], [-3]])
        grammar = Grammar(words)
        a, b = rng.integers(1, len(words) - 1, (2, 500))
        a, b = a[a != b], b[a != b]
        for step in (1, -1):
            got = grammar.extension(a, b, step)
            for x, y, n in zip(a.tolist(), b.tolist(), got.tolist()):
                k = 0
                while words[x + step * k] == words[y + step * k]:
                    k += 1
                assert n == k


def test_fibonacci_and_nested_periods():
    a, b = [b"b"], [b"a"]
    while len(b) < 400:
        a, b = b, b + a
    unit = [b"x"] * 13 + [b"y"]
    lists = [b, unit * 9, [b"z"] * 500, [b"z"] * 11, []]
    assert found(lists) == [brute_runs(w) for w in lists]
    assert found([unit * 9])[0][-1] == (112, 13, 1) and (0, 126, 14) in found([unit * 9])[0]


def test_candidates_in_many_parts(monkeypatch):
    monkeypatch.setattr("flowguard.llm.runs.CANDIDATES", 5)
    lists = [split_words(t) for t in texts_with_runs(9, 20)]
    assert found(lists) == [brute_runs(w) for w in lists]


def test_collapse_keeps_first_periods():
    words = split_words("s " + "a b c " * 6 + "t")
    runs = np.asarray([(s, s + k, p) for s, k, p in brute_runs(words)])
    assert collapse(words, runs) == b"s a b c t"


def rows_of(spark, rows):
    return digests(periodic_runs(frame(spark, rows), prepare=planted)).collect()


def test_query_equals_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts_with_runs(21, 200))] + prose(5, 20) + [(None, "a b " * 9), (7001, None), (7002, "  \t\n"),
                                                                                   (7003, "tab\x0bvt\x0cff\x00nul  ls nb " * 8)]
    got = sorted((tuple(r) for r in rows_of(spark, rows)), key=repr)
    assert got == sorted((brute_row(i, t) for i, t in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 60


def test_edges(spark):
    got = {(r.doc_id, r.n_runs, r.start, r.length, r.period) for r in rows_of(spark, None)}
    assert (1, 0, None, None, None) in got and (2, 0, None, None, None) in got and len(got) >= 6
    assert (4, 1, 0, 30_000, 1) in got
    empty = periodic_runs(frame(spark, []))
    assert empty.count() == 0 and empty.schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()
