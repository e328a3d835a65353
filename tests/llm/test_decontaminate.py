import random
import re

from pyspark.sql import functions as F

from flowguard.llm import decontaminate
from tests.llm.helpers import frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, k=10):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            q = words(text)
            n = min(k, len(q))
            for s in range(max(1, len(q) - n + 1) if q else 0):
                for a in range(len(w) - n + 1):
                    if w[a:a + n] == q[s:s + n]:
                        hit |= set(range(a, a + n))
                        found.add(item)
        out.append((i is None, i or 0, len(w), len(hit), tuple(sorted(x for x in found if x is not None))))
    return sorted(out)


def result(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.hit, tuple(r["items"])) for r in df.withColumn("hit", decontaminate.n_hit()).collect())


def tables(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Étude", "b2", "x"] + [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(50, None), (51, "the of"), (0, items[0][1]), (None, "lonely item words here")]
    docs = []
    for i in range(60):
        parts = [rng.choice([rng.choice(items)[1] or "", " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 20)))]) for _ in range(4)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts).upper() if i % 7 == 0 else " - ".join(parts)))
    return docs + [(100, None), (101, ""), (None, "the of"), (102, "the of"), (102, "the of")], items


def test_phrases_equal_brute_force_whatever_the_blocks(spark):
    docs, items = tables(1)
    index = decontaminate.build_index(frame(spark, docs).repartition(3))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert result(decontaminate.match_phrases(index, bench)) == want
    assert result(decontaminate.match_phrases(index, bench, block_bytes=100)) == want


def test_near_matches(spark):
    docs = [(1, "alpha x beta y gamma"), (2, "gamma z z z z z z alpha beta"), (3, "beta alpha gamma"), (4, "alpha beta"), (5, "alpha"), (6, "gamma beta alpha")]
    index = decontaminate.build_index(frame(spark, docs))
    got = decontaminate.match_near(index, spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string"), width=5)
    hit = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in got.filter(F.size("items") > 0).collect()}
    assert hit == {1: [(0, 5)], 3: [(0, 3)], 6: [(0, 3)]}


def test_edge_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    index = decontaminate.build_index(frame(spark))
    assert all(r.hit == 0 for r in decontaminate.match_phrases(index, none).withColumn("hit", decontaminate.n_hit()).collect())
    assert decontaminate.match_phrases(index, none).count() == 8
    empty = decontaminate.build_index(frame(spark, []))
    assert decontaminate.match_phrases(empty, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
