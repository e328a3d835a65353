import collections
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.llm import jaccard
from flowguard.llm.graph import components
from tests.llm.helpers import frame, prose


def brute(rows):
    low = {c: c + 32 for c in range(65, 91)}
    sets = {}
    for i, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(low)) if x]
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    where = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for i, s in sets.items():
        for j, n in collections.Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = prose(seed) + [(1, None), (2, ""), (3, " \n"), (4, "One two"), (6, "one TWO")]
    got = jaccard.similar_documents(frame(spark, rows).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows) and len(got) == len(rows)


@pytest.mark.parametrize("block", [7, 1024])
def test_links_equal_brute_force(spark, monkeypatch, block):
    """Every linked pair of documents counts, copies and settled points included."""
    monkeypatch.setattr(jaccard, "BESIDE", block)
    rows = prose(1) + [(1, None), (2, ""), (4, "One two"), (6, "one TWO"), (8, "one two")]
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    want, component = collections.Counter(), {i: c for i, (_, c) in brute(rows).items()}
    for i, s in sets.items():
        for j, t in sets.items():
            if j < i and s and 100 * len(s & t) >= 80 * len(s | t):
                want[component[i]] += 1
    got = jaccard.similar_documents(frame(spark, rows).repartition(3)).collect()
    assert {r.doc_id: r.n_links for r in got} == {i: want[component[i]] for i in sets} and max(want.values()) > 50


def test_edge_rows(spark):
    got = jaccard.similar_documents(frame(spark)).collect()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert len(got) == 8 and found[1] == (0, 1) and found[2] == (0, 2) and found[3] == (0, 3)
    assert found[4] == (1, 4) and found[5] == found[6] == (2, 5) and found[None][1] is None
    assert jaccard.similar_documents(frame(spark, [])).count() == 0


def test_every_link_shares_a_group_content():
    rng = np.random.default_rng(3)
    for n in [4, 5, 6, 7, 9, 12, 20, 41, 42, 100, 333]:
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            drop = rng.integers(0, n // 9 + 1)
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 62, rng.integers(0, n // 9 + 1)).astype(np.uint64)]))
            shared = len(np.intersect1d(a, b))
            for common in (None, rng.permutation(a)[:rng.integers(0, n)]):
                keys, place = jaccard.contents(np.concatenate([a, b]), np.asarray([len(a), len(b)]), common)
                if jaccard.linked(shared, len(a), len(b)) and not np.array_equal(a, b):
                    assert len(np.intersect1d(keys[place == 0], keys[place == 1]))


def test_bounds_hold():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(rng.integers(0, 900, rng.integers(1, 700)).astype(np.uint64))
        b = np.unique(rng.integers(0, 900, rng.integers(1, 700)).astype(np.uint64))
        shared = len(np.intersect1d(a, b))
        assert jaccard.summed_minima(jaccard.counts_of(a), jaccard.counts_of(b)) >= shared
        need = jaccard.needed(len(a), len(b), len(b))
        if jaccard.linked(shared, len(a), len(b)):
            assert need is not None and shared >= need


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(101, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors_pass_through_small():
    # A count below 256 goes as one byte: the vectors are what most shuffles of the join carry.
    rng = np.random.default_rng(3)
    found = rng.integers(0, 1 << 63, 700).astype(np.uint64)
    counts = jaccard.counts_of(found)
    blob = jaccard.vector_blob(counts)
    assert np.array_equal(jaccard.vector(blob), counts) and len(blob) < len(counts) * 2 / 8 + 64
    large = np.asarray([0, 255, 256, 1 << 20])
    assert np.array_equal(jaccard.vector(jaccard.vector_blob(large)), large)
    assert not len(jaccard.vector(jaccard.vector_blob(np.zeros(0, np.int64))))


def test_only_what_the_result_reads_stays(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    found = jaccard.similar_documents(frame(spark, prose(4, 6)))
    assert sorted(p.name.split("-")[1] for p in set(folder.iterdir()) - before if p.is_dir()) == ["classes", "sets"]
    assert found.count() == len(prose(4, 6))


def test_a_linked_set_shares_what_it_needs():
    rng = np.random.default_rng(5)
    met = 0
    for n in [4, 5, 6, 7, 9, 12, 20, 41, 42, 100, 333, 549]:
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            drop = rng.integers(0, n // 9 + 1)
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 62, rng.integers(0, n // 9 + 1)).astype(np.uint64)]))
            if np.array_equal(a, b) or not jaccard.linked(len(np.intersect1d(a, b)), len(a), len(b)):
                continue
            met += 1
            for common in (None, rng.permutation(a)[:rng.integers(0, n)]):
                keys, place, slot, needs = jaccard.group_contents(np.concatenate([a, b]), np.asarray([len(a), len(b)]), common)
                for one, other in ((0, 1), (1, 0)):
                    shared = (place == one) & np.isin(keys, keys[place == other])
                    assert (shared & (slot == jaccard.OWN)).sum() >= needs[0, one] or (shared & (slot == jaccard.NEXT)).sum() >= needs[1, one]
    assert met > 100


def test_a_quoted_passage_makes_no_cluster(spark):
    """Texts that share a third of their shingles meet, but are no points of a tree; copies stay."""
    words = lambda i, n: [f"w{i}x{k}" for k in range(n)]
    rows = [(i, " ".join(words(i, 300) + words(f"q{i // 3}", 150))) for i in range(30)]
    rows += [(100 + i, " ".join(words(f"near{i // 2}", 300) + words(100 + i, 20))) for i in range(10)]
    docs = jaccard.id_and_text(frame(spark, rows))
    found = jaccard.meetings(jaccard.candidate_edges(docs, 20_000, 24, np.zeros(0, np.uint64))).collect()
    assert sum(r.a == r.b for r in found) > 20 and sum(r.a == r.b and r.able for r in found) == 10
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard.similar_documents(docs).collect()}
    assert {i: r[:2] for i, r in got.items()} == brute(rows) and got[100][2] == 1 and got[0][2] == 0


def test_texts_of_others_are_not_shuffled(spark):
    docs = jaccard.id_and_text(frame(spark, [(i, f"text {i}") for i in range(2_000)]))
    nodes = docs.filter("doc_id % 100 = 0").select("doc_id")
    ids = {r.doc_id for r in jaccard.chosen_texts(docs, nodes).collect()}
    assert {i for i in range(0, 2_000, 100)} <= ids and len(ids) < 200


def test_rows_left_out_by_id(spark):
    """Rows of other ids and those without one stay, whatever the other columns are called; texts of rows off the filter meet no join."""
    rows = [(i % 1_500, f"text {i}") for i in range(2_000)] + [(None, "no id")]
    docs = frame(spark, rows).withColumn("hit", F.lit(1))
    ids = docs.filter("doc_id % 100 = 0").select("doc_id").distinct()
    got = jaccard.without(docs, ids)
    assert got.columns == docs.columns
    assert sorted(map(repr, got.collect())) == sorted(repr(r) for r in docs.collect() if r.doc_id is None or r.doc_id % 100)


def test_hashing_a_block_takes_little_memory():
    text = "abcd " * (jaccard.BLOCK // 5)
    jaccard.shingle_sets([text])
    tracemalloc.start()
    jaccard.shingle_sets([text])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8e6 and jaccard.BATCH_BYTES <= 2 << 20
