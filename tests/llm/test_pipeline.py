import hashlib
import re

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from flowguard.llm import quality, surrogates
from tests.conftest import SF
from tests.llm import test_decontaminate, test_jaccard
from tests.llm.helpers import frame


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    judged = quality.quality_rules(docs)
    rows = [(r.doc_id, r.text) for r in judged.filter("kept").collect()]
    classes = test_jaccard.brute(rows)
    rows = [(i, t) for i, t in rows if classes[i][1] == i]
    spans = {r[1]: r[3] for r in test_decontaminate.brute(rows, items)}
    rows = [(i, t) for i, t in rows if not spans[i]]
    assert sorted(got) == sorted(i for i, _ in rows)
    clean = docs.filter(F.col("doc_id").isin([i for i, _ in rows]))
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in surrogates.replace_entities(clean, "example key").collect():
        ids = lib.encode(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_stages_keep_columns_and_take_edge_rows(spark):
    docs = frame(spark).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    bench = [s for n, s in corpus_pipeline.STAGES]
    for step in bench[:-1]:
        out = step(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= 8
        assert step(spark, docs.limit(0), SF).count() == 0
    assert bench[-1](spark, docs, SF).count() == 8
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII",
                                                      "SentencePiece encoding and decoding"]
    assert all(re.search(r"\w", n) for n, _ in corpus_pipeline.STAGES)
