"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a predicate that rejects a document. ``order_rules`` runs each rule alone over a
sample, base rules included, notes the seconds that it and its counts take and the share it
rejects, and puts the rules with the most rejections per second first; ``cascade`` evaluates them
in that order inside one CASE, so a document leaves at the first rule that rejects it and later
rules never see it. The order
changes the work, never the verdict. The sample serves the order alone: every document is judged
on its whole text.

Defined results: a null or empty text has no words, so it fails the base rules and is not kept;
repeated rows are judged one by one; an empty table gives an empty table and the given order;
a null id stays null. Only the id and text columns are read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import id_and_text, let, quoted

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rows of the sample that orders the rules.
SAMPLE_ROWS = 2_000
#: Timed runs of a rule over the sample, and what a rule takes at least, as shorter times are noise.
RUNS = 1
LEAST_SECONDS = 0.005


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for documents that the rule turns away."""
    name: str
    rejects: Column


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more."""
    def windows(hashes: Column) -> Column:
        rows = F.transform(hashes, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, WINDOW))))
        return F.when(F.size(hashes) >= WINDOW, F.slice(rows, F.lit(1), F.size(hashes) - (WINDOW - 1))) \
                .otherwise(F.array().cast("array<bigint>"))

    def covered(found: Column) -> Column:
        placed = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda s: let(repeated(s), lambda starts: F.aggregate(
            F.transform(starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW)))),
            F.lit(0).cast("bigint"), lambda a, b: a + b)))

    def repeated(s: Column) -> Column:
        same = F.filter(s, lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
                        | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False)))
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    def counted(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("bigint")).otherwise(covered(found))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), counted))


def with_base(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, text, _words, n_lines and the counts of the base rules, besides carried columns.

    Words and lines are split once, in a generator of one row: a filter over the counts is moved
    below the counts, where its CASE works out only those it comes to, but not below the splits.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")
    step = docs.select(*carried, "doc_id", "text", F.inline(F.array(F.struct(
        words_of(text).alias("_words"), lines.alias("_lines")))))
    return step.select(
        *carried, "doc_id", "text", "_words", F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.translate(text, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_words")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def default_rules() -> list[Rule]:
    """Heuristics known from web-corpus filters: symbols per word, repeated lines, word length,
    share of words with a letter."""
    n = F.col("n_words")
    with_letter = F.size(F.filter("_words", lambda w: F.regexp_like(w, F.lit(r"\p{L}"))))
    return [
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("repeated_lines", 2 * F.col("n_dup_lines") > F.col("n_lines")),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("letters", 10 * with_letter < 6 * n),
    ]


def base_rule() -> Rule:
    return Rule("base", base_failed())


def order_rules(docs: DataFrame, rules: list[Rule], rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per second on a random sample of about ``rows`` documents.

    A rule's seconds are those of a job that works out nothing but the counts this rule needs, the
    least of ``RUNS`` after a first one, less those of a job without a rule."""
    n = docs.count()
    if not n:
        return list(rules)
    sample = docs.select("doc_id", "text").sample(min(1.0, rows / n), seed=0).repartition(1).persist()

    def run(rejects: Column) -> tuple[int, float]:
        job, seconds, rejected = with_base(sample).agg(F.count_if(rejects)), [], 0
        for _ in range(1 + RUNS):
            begin = time.perf_counter()
            rejected = job.first()[0]
            seconds.append(time.perf_counter() - begin)
        return rejected, min(seconds[1:])

    try:
        sample.count()
        empty = run(F.col("text").isNull())[1]
        value = {}
        for rule in rules:
            rejected, seconds = run(rule.rejects)
            value[rule.name] = (rejected + 1e-3) / max(seconds - empty, LEAST_SECONDS)
        return sorted(rules, key=lambda r: -value[r.name])
    finally:
        sample.unpersist()


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects, null if none does."""
    out = None
    for rule in rules:
        out = F.when(rule.rejects, rule.name) if out is None else out.when(rule.rejects, rule.name)
    return F.lit(None).cast("string") if out is None else out


def quality_rules(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text",
                  sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, the base counts, base_failed, failed_rule and kept."""
    docs = id_and_text(docs, id_col, text_col)
    ordered = order_rules(docs, [base_rule(), *(default_rules() if rules is None else rules)], sample_rows)
    return with_base(docs).withColumns({"base_failed": base_failed(), "failed_rule": cascade(ordered)}) \
                          .withColumn("kept", F.col("failed_rule").isNull()).drop("_words")


def keep_good(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text",
              sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns."""
    ordered = order_rules(id_and_text(docs, id_col, text_col),
                          [base_rule(), *(default_rules() if rules is None else rules)], sample_rows)
    whole = docs.select(F.struct("*").alias("_row"), F.col(quoted(id_col)).cast("long").alias("doc_id"),
                        F.col(quoted(text_col)).cast("string").alias("text"))
    return with_base(whole, "_row").filter(cascade(ordered).isNull()).select("_row.*")
