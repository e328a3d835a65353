import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from flowguard.llm import bytebpe
from tests.llm.helpers import frame, prose

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.read_ranks(PATH), special_tokens={})


def encoded(spark, rows, **options):
    return bytebpe.encode_bytes(frame(spark, rows), PATH, public_tokenizers.PATTERN, **options)


def row(library, doc_id, text):
    ids = library.encode_ordinary(text or "")
    return (doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


AWKWARD = ["it's we'll I'd they've 'S x're", "a  b   c \n\n d\t\te  ", "x  y  z　 \u0085 end ", "naïve café Ωμέγα 東京都 числа",
           "१२३ ½ ² Ⅷ 12345678901234567890", "é ​ zero‍width ﻿", "🙂🙃 👨‍👩‍👧 flags🇩🇪", "--==##!!?? $%^ |key=1|2| =| ,",
           "\x00\x01\x7f \x0b\x0c", "z" * 300, "ab" * 2_000 + " " + "q" * 400, " " * 700 + "x", "don''t ''s", "AaBbCcDdEe" * 40]


def test_equals_the_library(spark, library):
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzäé -'0123456789\n"
    rows = [(i, t) for i, t in enumerate(AWKWARD)] + [
        (100 + i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 120)))) for i in range(60)] + prose(3, 6)
    got = bytebpe.digests(bytebpe.decode_bytes(encoded(spark, rows), PATH)).collect()
    assert sorted(tuple(r) for r in got) == sorted(row(library, i, t) for i, t in rows)


def test_remembered_words_change_nothing(spark):
    rows = [(i, t) for i, t in enumerate(AWKWARD)]
    few, many = encoded(spark, rows, remembered=1), encoded(spark, rows)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_edges(spark, library):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a row without an id " * 5), (4, "word " * 30_000),
            (5, "same text " * 20), (5, "same text " * 20), (6, "same text " * 20)]
    got = bytebpe.digests(bytebpe.decode_bytes(encoded(spark, None), PATH)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted((row(library, i, t) for i, t in rows), key=repr)
    empty = encoded(spark, [])
    assert empty.count() == 0 and empty.columns == ["doc_id", "ids"]


def test_fold_and_heap_agree(spark, library):
    ranks = bytebpe.read_ranks(PATH)
    fold = bytebpe.RankFold(ranks)
    words = [w for t in AWKWARD for w in t.split() if 1 < len(w.encode()) <= 400]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = df.select("w", bytebpe.let(fold.map.array, lambda t: bytebpe.let(bytebpe.digits(F.col("w")), lambda c: fold.ids(t, c))).alias("ids"))
    for r in got.collect():
        if r.w.encode() not in ranks:
            assert r.ids == bytebpe.merge_by_heap(r.w.encode(), ranks)


def test_heap_on_long_words(library):
    rng = random.Random(7)
    ranks = bytebpe.read_ranks(PATH)
    for text in ["".join(rng.choice("abcxyz") for _ in range(5_000)), "a" * 3_000, "thethe" * 700]:
        assert bytebpe.merge_by_heap(text.encode(), ranks) == library.encode_ordinary(text)


def test_pair_table_and_literal_map(spark):
    ranks = {b"a": 0, b"b": 1, b"c": 2, b"ab": 3, b"abc": 4, b"bc": 5, b"aa": 6}
    table = bytebpe.PairTable(ranks)
    pairs = [(x, y) for x in range(7) for y in range(7)]
    names = {r: p for p, r in ranks.items()}
    df = spark.createDataFrame(pairs + [(3, None), (None, 3)], "l long, r long")
    got = df.select("l", "r", bytebpe.let(table.array, lambda t: table.rank(t, F.col("l"), F.col("r"))).alias("rank")).collect()
    assert {(r.l, r.r): r.rank for r in got} == {(x, y): bytebpe.NO_RANK if None in (x, y) else ranks.get(names[x] + names[y], bytebpe.NO_RANK)
                                                 for x, y in [*pairs, (3, None), (None, 3)]}
    words = {f"w{i} |=,\x00": str(i) for i in range(500)}
    known = bytebpe.LiteralMap(words)
    asked = [*words, "w1", "", "unknown"]
    found = spark.createDataFrame([(w,) for w in asked], "w string").select("w", known.bind(lambda k, v: known.get(k, v, F.col("w"))).alias("v"))
    assert not known.left_out and {r.w: r.v or None for r in found.collect()} == {w: words.get(w) for w in asked}


def test_plans_name_their_constants(spark):
    """The text of a plan, which Spark's listeners keep in the driver, does not list the tables."""
    made = bytebpe.digests(bytebpe.decode_bytes(encoded(spark, [(1, "some unheardof words")]), PATH))
    assert len(made._jdf.queryExecution().executedPlan().toString()) < 100_000


def test_digests_of_large_ids(spark):
    rows = [(1, [3, 70_000, 0]), (2, [65_535]), (3, [65_536]), (4, []), (5, [0, 1])]
    got = bytebpe.digests(spark.createDataFrame([(i, ids, bytearray(b"x")) for i, ids in rows], "doc_id long, ids array<int>, decoded binary"))
    assert {r.doc_id: r.ids_sha256 for r in got.collect()} == {
        i: hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest() for i, ids in rows}


def test_merges_search_no_place_by_exception(spark):
    """``array_position`` leaves its loop by an exception when it finds an element, the dearest step of a merge."""
    fold = bytebpe.RankFold({b"a": 0, b"b": 1, b"ab": 2})
    made = spark.range(1).select(bytebpe.let(fold.map.array, lambda t: fold.ids(t, bytebpe.digits(F.lit("abab")))).alias("ids"))
    assert "array_position" not in made._jdf.queryExecution().analyzed().toString()
    assert made.collect()[0].ids == [2, 2]


def test_decoding_runs_in_batches_without_constants(spark):
    ranks = bytebpe.read_ranks(PATH)
    some = sorted(ranks.items(), key=lambda r: -len(r[0]))[:50]
    rows = [(1, [r for _, r in some]), (2, None), (3, []), (4, [-1, ranks[b"a"], len(ranks) + 70_000]), (5, [ranks[b"b"]])] * 7
    made = bytebpe.decode_bytes(spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1), PATH)
    assert {(r.doc_id, None if r.decoded is None else bytes(r.decoded)) for r in made.collect()} == {
        (1, b"".join(p for p, _ in some)), (2, None), (3, b""), (4, b"a"), (5, b"b")}
    plan = bytebpe.digests(made)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "ubquery" not in plan
