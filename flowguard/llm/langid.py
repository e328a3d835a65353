"""Language identification: words first, then shorter and shorter character n-grams.

The model holds per language the log frequency of its most frequent words and, for words it does
not know, of character n-grams of 5 to 1 characters (a blank marks both ends of a word). A word
is scored by its own row; an unknown word by the mean row of its known n-grams of the greatest
length that has any, less a step for each length given up. A text takes the language of the
greatest sum; its score is that language's share after a softmax.

``fit`` learns from labelled rows drawn by a hash of their id, about ``ROWS_PER_LANG`` per
language (all of a language with fewer); counting is a distributed aggregation, and only the
``WORDS`` and ``GRAMS`` most frequent rows per language reach the driver, so the model's size
does not grow with the corpus.

Defined results: a null text or one without letters is ``und`` with score 0; so is every text if
nothing was learned; ties take the first language by name; rows without a language teach
nothing; repeated rows count each time; empty tables give empty results. Prediction reads the id
and text columns only.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.common import id_and_text, stage, texts

ROWS_PER_LANG = 4_000
WORDS = 20_000
GRAMS = 8_000
LONGEST = 5
#: Log probability lost for each n-gram length given up.
STEP = 0.9
REMEMBERED = 200_000
#: Letters of a word that n-grams are taken from; a longer one is scored by its parts.
LETTERS = re.compile(r"[^\W\d_]{1,40}")
NONE = "und"
COUNTS = "lang string, kind int, term string, n long"


def words_of(text: str | None) -> list[str]:
    found = LETTERS.findall(text.lower()) if text else []
    # The pattern also takes numbers such as the half or the squared two.
    return [part for w in found for part in ((w,) if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def grams(word: str, n: int) -> list[str]:
    marked = f" {word} " if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    langs: list[str]
    rows: dict[tuple[int, str], int] = field(default_factory=dict)
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def places(self, word: str) -> tuple[list[int], int]:
        """Rows of the table that score a word, and how many lengths were given up."""
        rows = self.rows
        at = rows.get((0, word))
        if at is not None:
            return [at], 0
        marked = f" {word} "
        size = len(marked)
        for n in range(LONGEST, 0, -1):
            places = range(size - n + 1) if n > 1 else range(1, size - 1)
            found = [r for i in places if (r := rows.get((n, marked[i:i + n]))) is not None]
            if found:
                return found, LONGEST + 1 - n
        return [], 0

    def score(self, words: list[str]) -> np.ndarray:
        """One row per word: log frequencies by language, zeros for a word with nothing known."""
        found = [self.places(w) for w in words]
        counts = np.asarray([len(f) for f, _ in found])
        out = np.zeros((len(words), len(self.langs)))
        known = np.flatnonzero(counts)
        if len(known):
            every = self.table[[r for f, _ in found for r in f]]
            first = np.cumsum(counts[known]) - counts[known]
            lost = np.asarray([d for _, d in found])[known]
            out[known] = np.add.reduceat(every, first) / counts[known][:, None] - STEP * lost[:, None]
        return out


def fit(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
        rows_per_lang: int = ROWS_PER_LANG) -> Model:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).filter(F.col("lang").isNotNull())
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model([])
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, rows_per_lang / n)])
    place = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) / (1 << 30)
    drawn = rows.filter(place < share[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                found.update((lang, w) for w in words_of(text.as_py()))
                if len(found) > REMEMBERED:
                    yield rows_out(((k[0], 0, k[1], n) for k, n in found.items()))
                    found.clear()
        yield rows_out((k[0], 0, k[1], n) for k, n in found.items())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "term", "n"))):
                for k in range(1, LONGEST + 1):
                    for g in grams(word, k):
                        found[lang, k, g] += n
            yield rows_out((*k, n) for k, n in found.items())

    per_word = stage(summed(drawn.mapInArrow(count, COUNTS)), "langid-words")
    every = per_word.unionByName(summed(per_word.mapInArrow(split, COUNTS)))
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "term"))
    total = F.sum("n").over(Window.partitionBy("lang", "kind"))
    kept = every.withColumns({"total": total, "rank": rank}) \
                .filter(F.col("rank") <= F.when(F.col("kind") == 0, WORDS).otherwise(GRAMS)).collect()
    model = Model(sorted(sizes))
    place_of = {lang: i for i, lang in enumerate(model.langs)}
    totals = np.ones((LONGEST + 1, len(model.langs)))
    for r in kept:
        totals[r.kind, place_of[r.lang]] = r.total
        model.rows.setdefault((r.kind, r.term), len(model.rows))
    model.table = np.zeros((len(model.rows), len(model.langs)))
    kinds = np.empty(len(model.rows), int)
    for (kind, _), at in model.rows.items():
        kinds[at] = kind
    model.table[:] = np.log(0.2 / totals)[kinds]
    for r in kept:
        model.table[model.rows[r.kind, r.term], place_of[r.lang]] = math.log(r.n / r.total)
    return model


def rows_out(rows) -> pa.RecordBatch:
    lang, kind, term, n = zip(*rows) if (rows := list(rows)) else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(kind, pa.int32()),
                                       pa.array(term, pa.string()), pa.array(n, pa.int64())], ["lang", "kind", "term", "n"])


def summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang", "kind", "term").agg(F.sum("n").alias("n"))


class Scorer:
    """Word rows a worker has met, in one growing table."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.found: list[np.ndarray] = []
        self.table = np.zeros((0, len(self.model.langs)))

    def predict(self, values: list[str | None]) -> tuple[list[str], list[float]]:
        split = [words_of(v) for v in values]
        fresh = set().union(*split).difference(self.at)
        if len(self.at) + len(fresh) > REMEMBERED:
            self.forget()
            fresh = set().union(*split)
        if fresh and self.model.langs:
            for w in fresh:
                self.at[w] = len(self.at)
            self.table = np.concatenate([self.table, self.model.score(list(self.at)[-len(fresh):])])
        langs, scores = [], []
        for words in split:
            if not words or not self.model.langs:
                langs.append(NONE)
                scores.append(0.0)
                continue
            total = self.table[[self.at[w] for w in words]].sum(axis=0)
            best = int(total.argmax())
            langs.append(self.model.langs[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return langs, scores


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for keys, values in texts(batches, 1 << 20):
            langs, scores = scorer.predict(values)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(langs), pa.array(scores)],
                                             ["doc_id", "lang_pred", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def fold(id_col: str, n: int) -> Column:
    """Fold of a row by its id as text; a null id falls into fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % n, F.lit(0))
