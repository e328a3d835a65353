import random

from pyspark.sql import functions as F

from flowguard.llm import langid, queries, toxicity
from tests.conftest import SF
from tests.llm.helpers import frame

SMALL = SF.replace("sf0.001", "sf0.01")


def test_words_hold_letters_only():
    assert langid.words_of("½ ② ² Ⅷ 12 _ a2b x² Ωμ 東京") == ["a", "b", "x", "ωμ", "東京"]
    assert all(bool(langid.words_of(c)) == any(x.isalpha() for x in c.lower()) for c in map(chr, [*range(0x3000), *range(0x1F000, 0x1F300)]))


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    got = queries.QUERIES["op7_language"](spark, SMALL).join(docs, "doc_id")
    row = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert row[0] > 0.97 and row[1] >= 0 and row[2] <= 1


def test_words_first_then_shorter_grams(spark):
    train = frame(spark, [])
    rows = [(i, "the house of the king", "en", 1, True, "") for i in range(5)] + [(9 + i, "das haus des kaisers", "de", 1, True, "") for i in range(5)]
    model = langid.fit(spark.createDataFrame(rows, train.schema))
    assert model.places("house")[1] == 0 and 1 <= model.places("houses")[1] <= 3 and model.places("漢") == ([], 0)
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(frame(spark, [(1, None), (2, "12 !"), (3, "the kings"), (4, "des hauses")]), model).collect()}
    assert found[1] == found[2] == ("und", 0.0) and found[3][0] == "en" and found[4][0] == "de"
    nothing = langid.fit(train)
    assert [r.lang_pred for r in langid.predict(frame(spark), nothing).collect()] == ["und"] * 8
    assert langid.predict(train, model).count() == 0 and langid.predict(frame(spark), model).count() == 8


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_on_trie_equals_edit_distance():
    rng = random.Random(1)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(4, 7))) for _ in range(25)})
    trie = toxicity.Trie(terms)
    for _ in range(600):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 8)))
        near = sorted((d, t) for t in terms if (d := distance(word, t)) <= 1)
        assert trie.near(word) == (near[0][1] if near else None)


def test_misspelled_and_quoted_terms():
    lexicon = toxicity.Lexicon(frozenset(["stupid", "moron"]), frozenset(["lostra"]))
    assert [lexicon.kind(w) for w in ("stupid", "st*pid", "stupidd", "lostraung", "lostzaung", "table")] == [1, 2, 2, 3, 4, 0]
    plain, quoted = (lexicon.features(t) for t in ("you stupid man", 'he said "stupid" and left'))
    at = toxicity.FEATURES.index
    assert plain[at("exact")] > 0 and plain[at("aimed")] > 0 and plain[at("quoted")] == 0
    assert quoted[at("exact")] == 0 and quoted[at("quoted")] > 0 and quoted[at("rate")] == 0


def test_toxicity_of_learned_and_unlearned_rows(spark):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "bdfghk" for b in ("an", "er", "ol", "ist", "um")]
    rows, labels = [], []
    for i in range(400):
        w = [rng.choice(words) for _ in range(30)]
        if i % 2:
            for _ in range(3):
                w[rng.randrange(30)] = rng.choice(["nastyword", "vileword"])
        rows.append((i, " ".join(w)))
        labels.append((i, i % 2))
    known = spark.createDataFrame(labels + [(None, 1), (7, None), (3, 1)], "doc_id long, toxic int")
    model = toxicity.fit(frame(spark, rows), known.filter((F.col("doc_id") < 200) | F.col("doc_id").isNull()))
    assert model.lexicon.words == {"nastyword", "vileword"}
    got = {r.doc_id: r.score for r in toxicity.score(frame(spark, rows), model).collect()}
    assert all((got[i] >= 0.5) == (i % 2 == 1) for i in range(400))
    edge = toxicity.score(frame(spark), model).collect()
    assert len(edge) == 8 and all(0 <= r.score < 0.5 for r in edge)
    assert toxicity.score(frame(spark, []), model).count() == 0
    alone = toxicity.fit(frame(spark, rows), known.filter("toxic = 1"))
    assert all(r.score > 0.99 for r in toxicity.score(frame(spark), alone).collect())
    none = toxicity.fit(frame(spark, rows), known.filter("false"))
    assert all(r.score < 0.01 for r in toxicity.score(frame(spark), none).collect())
