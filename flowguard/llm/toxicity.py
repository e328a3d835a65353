"""Toxicity: a lexicon trie met by Levenshtein automata, and scores of the context of each hit.

The lexicon is learned from labelled rows: words, and stems that many inflected words share,
which occur in far more different contexts (the words before and after) of toxic rows than of
clean ones; contexts, not rows, are counted so that copies of one text teach nothing. Its terms
stand in a trie; Levenshtein automata of distance 1 for all of them are run over each distinct word
at once, their states found as words need them, and give exact and misspelled terms. A hit's window of words tells quotation from abuse: quotation
marks around it count against, a second-person word near it for. A logistic model over the sums
of these scores gives the result.

Labelled rows are drawn by a hash of their id, about ``ROWS`` of each class (all, if fewer);
lexicon and model sizes are bounded by parameters, so both can go to every executor.

Defined results: a null or empty text has no hits and takes the model's lowest ordinary score;
with no labelled rows, or one class only, the score is the share of toxic rows (0 without rows);
repeated label rows count once and equal texts once, as toxic if one of them is; rows with a null
label or id teach nothing; texts may be of any length; an empty table gives
an empty table. Scoring reads the id and text columns only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import id_and_text, stage, texts

ROWS = 3_000
TERMS = 500
CANDIDATES = 4_000
#: Different contexts a term needs, and how much more often toxic than clean.
SUPPORT = 8
RATIO = 12.0
STEMS = range(4, 8)
#: Terms at least this long are also found with one edit.
FUZZY = 5
WINDOW = 5
REMEMBERED = 200_000
#: States of the automata a task keeps.
STATES = 100_000

WORD = re.compile(r"[^\W_](?:[\w*@$!]*[^\W_])?|[\"«»“”„‟]")
MARKS = frozenset("\"«»“”„‟")
# Second-person words of the languages covered.
AIMED = frozenset("you your yours youre du dich dir dein deine ihr euch sie tu toi te vous votre tes ton ta "
                  "usted ustedes tú ti tus vosotros".split())
FEATURES = ["exact", "misspelled", "stems", "fuzzy_stems", "quoted", "aimed", "rate"]


def tokens(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class State:
    """Places in the trie with the least edits that lead there, where to go on from them by
    character, and the closest term that ends in one of them."""
    __slots__ = ("places", "term", "steps")

    def __init__(self, places: dict[int, int], ends: list[str | None]):
        self.places, self.steps = places, {}
        self.term = min(((e, ends[n]) for n, e in places.items() if ends[n] is not None), default=(0, None))[1]


class Trie:
    """Terms by character, read by the Levenshtein automata of all terms at once.

    A word is read once: a state holds every (node, edits) that the characters read so far can
    stand for. States and their steps are kept when first met, so a word costs one look-up a
    character however many terms there are; characters of no term share one step.
    """

    def __init__(self, terms: Iterable[str], edits: int = 1):
        self.terms, self.edits = list(terms), edits
        self.below: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        for term in self.terms:
            node = 0
            for c in term:
                if c not in self.below[node]:
                    self.below[node][c] = len(self.below)
                    self.below.append({})
                    self.ends.append(None)
                node = self.below[node][c]
            self.ends[node] = term
        self.alphabet = {c for below in self.below for c in below}
        self.forget()

    def __reduce__(self):
        return Trie, (self.terms, self.edits)

    def forget(self) -> None:
        self.states: dict[frozenset, State] = {}
        self.start = self.state({0: 0})

    def state(self, places: dict[int, int]) -> State:
        """The state of these places and of those that terms reach by characters a word leaves out."""
        for used in range(self.edits):
            for node in [n for n, e in places.items() if e == used]:
                for child in self.below[node].values():
                    if places.get(child, self.edits + 1) > used + 1:
                        places[child] = used + 1
        key = frozenset(places.items())
        if key not in self.states:
            self.states[key] = State(places, self.ends)
        return self.states[key]

    def step(self, state: State, char: str) -> State:
        char = char if char in self.alphabet else ""
        after = state.steps.get(char)
        if after is None:
            places: dict[int, int] = {}
            for node, e in state.places.items():
                for c, child in self.below[node].items():
                    cost = e + (c != char)
                    if cost <= self.edits and cost < places.get(child, self.edits + 1):
                        places[child] = cost
                if e < self.edits and e + 1 < places.get(node, self.edits + 1):
                    places[node] = e + 1
            after = state.steps[char] = self.state(places)
        return after

    def read(self, word: str) -> Iterator[State]:
        """The states after each character, until no term is within reach."""
        if len(self.states) > STATES:
            self.forget()
        state = self.start
        for c in word:
            state = self.step(state, c)
            if not state.places:
                return
            yield state

    def near(self, word: str) -> str | None:
        """The closest term within the edits, the first by name among equals."""
        n, state = 0, self.start
        for n, state in enumerate(self.read(word), 1):
            pass
        return state.term if n == len(word) else None


class Lexicon:
    """Words and stems, and what words met so far turned out to be: two generations of at most
    ``REMEMBERED`` words, of which the older leaves when the younger is full."""

    def __init__(self, words: frozenset = frozenset(), stems: frozenset = frozenset()):
        self.words, self.stems = words, stems
        self.trie = Trie(sorted(w for w in words if len(w) >= FUZZY))
        self.stem_trie = Trie(sorted(s for s in stems if len(s) >= FUZZY))
        self.stem_sizes = sorted({len(s) for s in stems})
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def __reduce__(self):
        return Lexicon, (self.words, self.stems)

    def kind(self, word: str) -> int:
        """0 none, 1 a term, 2 a misspelled term, 3 a stem begins it, 4 a misspelled stem does."""
        found = self.known.get(word)
        if found is None:
            found = self.older.get(word)
            if found is None:
                found = self.look_up(word)
            if len(self.known) >= REMEMBERED:
                self.known, self.older = {}, self.known
            self.known[word] = found
        return found

    def look_up(self, word: str) -> int:
        if word in self.words:
            return 1
        if any(word[:n] in self.stems for n in self.stem_sizes if n <= len(word)):
            return 3
        if self.trie.near(word):
            return 2
        if self.stem_sizes:
            for n, state in enumerate(self.stem_trie.read(word[:min(len(word) - 1, self.stem_sizes[-1])]), 1):
                if n >= FUZZY and n in self.stem_sizes and state.term is not None:
                    return 4
        return 0

    def features(self, text: str | None) -> list[float]:
        words = tokens(text)
        kind = self.kind
        hits = [(i, k) for i, w in enumerate(words) if (k := kind(w))]
        if not hits:
            return [0.0] * len(FEATURES)
        counts = [0.0] * 5
        quoted = aimed = 0
        for i, k in hits:
            before, after = words[max(0, i - WINDOW):i], words[i + 1:i + 1 + WINDOW]
            if not MARKS.isdisjoint(before) and not MARKS.isdisjoint(after):
                quoted += 1
            else:
                counts[k] += 1
                aimed += not AIMED.isdisjoint(before) or not AIMED.isdisjoint(after)
        return [*(float(np.log1p(c)) for c in (*counts[1:], quoted, aimed)),
                float(np.log1p(100 * sum(counts) / len(words)))]


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-(self.bias + np.dot(self.weights, self.lexicon.features(text))))))


def terms_of(words: list[str]) -> Iterator[tuple[str, str]]:
    """Words and stems (marked by a star) with the words around them."""
    for i, w in enumerate(words):
        if w in MARKS:
            continue
        context = f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}"
        yield w, context
        for n in STEMS:
            if n < len(w):
                yield w[:n] + "*", context


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        rows: int = ROWS, terms: int = TERMS) -> Model:
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")) \
                  .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        share = 1.0 if 1 in sizes else 0.0
        return Model(Lexicon(), np.zeros(len(FEATURES)), 50.0 if share else -50.0)
    place = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) / (1 << 30)
    share = F.when(F.col("label") == 1, rows / sizes[1]).otherwise(rows / sizes[0])
    # About `rows` of each class: small enough to broadcast whatever the corpus.
    drawn = stage(id_and_text(docs, id_col, text_col).join(F.broadcast(known.filter(place < share)), "doc_id")
                  .groupBy("text").agg(F.max("label").alias("label")), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                found.update((label, t) for t in {t for t, _ in terms_of(tokens(text))})
        yield pa.RecordBatch.from_arrays([pa.array([k[1] for k in found], pa.string()), pa.array([k[0] for k in found], pa.int32()),
                                          pa.array(list(found.values()), pa.int64())], ["term", "label", "n"])

    n1 = drawn.filter("label = 1").count() + 1
    n0 = drawn.filter("label = 0").count() + 1
    pairs = drawn.mapInArrow(count, "term string, label int, n long").groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("n0"))
    ratio = ((F.col("n1") + 0.5) / n1) / ((F.col("n0") + 0.5) / n0)
    first = {r.term for r in pairs.filter((F.col("n1") >= SUPPORT) & (ratio >= RATIO))
             .orderBy(F.desc("n1"), "term").limit(CANDIDATES).collect()}

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {(t, label, c) for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist())
                     for t, c in terms_of(tokens(text)) if t in first}
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate(
                (pa.string(), pa.int32(), pa.string()))], ["term", "label", "context"])

    around = drawn.mapInArrow(contexts, "term string, label int, context string").distinct().groupBy("term").agg(
        F.count_if(F.col("label") == 1).alias("c1"), F.count_if(F.col("label") == 0).alias("c0")).collect()
    lexicon = choose({r.term: (r.c1, r.c0) for r in around}, n1, n0, terms)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([lexicon.features(t) for t in batch.column("text").to_pylist()],
                                                 pa.list_(pa.float64()))], ["label", "x"])

    sample = drawn.mapInArrow(features, "label int, x array<double>").collect()
    weights, bias = logistic(np.asarray([r.x for r in sample]), np.asarray([r.label for r in sample], float))
    return Model(lexicon, weights, bias)


def choose(contexts: dict[str, tuple[int, int]], n1: int, n0: int, limit: int) -> Lexicon:
    """Terms by their contexts; a stem is taken if no single word accounts for most of it, the
    shortest that tells the classes apart, made longer as long as it keeps its contexts; words under a taken stem are left out."""
    def tells(c1: int, c0: int) -> bool:
        return c1 >= SUPPORT and ((c1 + 0.5) / n1) / ((c0 + 0.5) / n0) >= RATIO

    good = {t: c for t, c in contexts.items() if tells(*c)}
    words = {t: c for t, c in good.items() if not t.endswith("*")}
    best_word: Counter = Counter()
    for w, (c1, _) in words.items():
        for n in STEMS:
            best_word[w[:n] + "*"] = max(best_word[w[:n] + "*"], c1)
    stems: list[str] = []
    for t, (c1, _) in sorted(((t, c) for t, c in good.items() if t.endswith("*")), key=lambda x: (len(x[0]), x[0])):
        if best_word[t] >= 0.6 * c1 or any(t.startswith(s) for s in stems):
            continue
        longer = [u for u, c in good.items() if u.endswith("*") and u.startswith(t[:-1]) and c[0] >= 0.98 * c1]
        stems.append(max(longer, key=lambda u: (len(u), u))[:-1])
    kept = {w: c for w, c in words.items() if not any(w.startswith(s) for s in stems)}
    ranked = sorted([(c[0], w) for w, c in kept.items()] + [(good[s + "*"][0], s) for s in stems], reverse=True)[:limit]
    chosen = {t for _, t in ranked}
    return Lexicon(frozenset(w for w in kept if w in chosen), frozenset(s for s in stems if s in chosen))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 60) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton's method, both classes of equal weight."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    mass = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    keep = np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (mass * p * (1 - p))[:, None]).T @ a + np.diag(keep), a.T @ (mass * (p - y)) + keep * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for keys, values in texts(batches, 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([own.score(v) for v in values], pa.float64())],
                                             ["doc_id", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
