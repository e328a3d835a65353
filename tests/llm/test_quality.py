import re

from pyspark.sql import functions as F

from flowguard.llm import quality
from tests.llm.helpers import edge_rows, frame


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.sub(r"[\x20\x09-\x0D]", "", line):
            dups += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(hit))


def test_counts_equal_brute_force(spark):
    rows = edge_rows([(10, "a b c d e f a b c d e\na b\na b\n# x"), (11, "x x x x x x"), (12, "é ü z |<> " * 4)])
    got = quality.quality_rules(frame(spark, rows)).collect()
    want = sorted(((r[0] is None, r[0] or 0), *brute(r[1])) for r in rows)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_order_changes_no_verdict(spark):
    rows = frame(spark, [(i, f"{'# ' * (i % 5)} some words stand in line {i} and more follow here today") for i in range(60)])
    rules = quality.default_rules()
    a = {r.doc_id: r.kept for r in quality.quality_rules(rows, rules).collect()}
    base = quality.with_base(rows.select("doc_id", "text"))
    b = {r.doc_id: r.bad is None for r in base.select("doc_id", quality.cascade(
        [quality.Rule("base", quality.base_failed()), *rules[::-1]]).alias("bad")).collect()}
    assert a == b and True in a.values()


def test_rules_are_ordered_by_rejections_per_cost(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("eleven words stand here so that the base rule is content now").alias("text"))
    rules = [quality.Rule("never", F.lit(False) & (F.col("n_words") < 0)), quality.Rule("always", F.col("n_words") > 0)]
    assert [r.name for r in quality.order_rules(docs, rules)] == ["always", "never"]


def test_empty_table_and_kept_rows(spark):
    assert quality.quality_rules(frame(spark, [])).count() == 0
    good = "ten plain words make this text pass every single rule today"
    kept = quality.keep_good(frame(spark, [(1, good), (2, "short"), (None, good)]))
    assert sorted(map(str, kept.collect())) == sorted(map(str, frame(spark, [(1, good), (None, good)]).collect()))
