"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, n_words long, kept boolean, component string"


def edge_rows(extra=()):
    """Rows with nulls, empty and long texts, repeats, and columns named like an operator's own."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a row without an id " * 5), (4, "word " * 30_000), (5, "same text " * 20),
            (5, "same text " * 20), (6, "same text " * 20), *extra]
    return [(i, t, "xx", 7, True, "c") for i, t in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(edge_rows() if rows is None else [(*r, "xx", 7, True, "c") if len(r) == 2 else r for r in rows], SCHEMA)


def prose(seed: int, groups: int = 40):
    """Groups of near copies of random word lists."""
    rng = random.Random(seed)
    words, rows = [f"w{i}" for i in range(60)], []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 4, 5, 6, 8, 9, 10, 14, 20, 40, 80, 150]))]
        for _ in range(rng.choice([1, 2, 3, 6, 20])):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 14))):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((len(rows) * 3 + 1000, " ".join(t[rng.randint(0, 2):] if rng.random() < 0.3 else t)))
    rng.shuffle(rows)
    return rows
