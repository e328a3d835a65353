"""A corpus made ready for training: stages over ``documents``, each by one operator.

A stage takes (spark, docs, sf_dir) and gives a DataFrame that is written to the shared folder
and read again as the docs of the next. All but the last return the columns of ``documents``.
Rows without an id pass the stages that compare documents; rows of one id count as one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm import decontaminate, jaccard, pieces, quality, surrogates
from flowguard.llm.common import stage
from flowguard.llm.queries import SURROGATE_KEY, vocabulary
from flowguard.llm.registry import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near copies."""
    least = jaccard.similar_documents(docs, count_links=False).filter("doc_id IS NOT NULL") \
                   .groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("kept"))
    return jaccard.without(docs, stage(least.filter("NOT kept").select("doc_id"), "near-copies"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a phrase of a benchmark item."""
    found = decontaminate.match_phrases(decontaminate.build_index(docs), table(spark, sf_dir, "benchmark"))
    hit = found.filter(F.size("spans") > 0).select("doc_id").distinct()
    return docs.join(stage(hit, "contaminated"), "doc_id", "left_anti").select(*docs.columns)


def surrogate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced; the length column follows the text."""
    return surrogates.replace_entities(docs, SURROGATE_KEY).withColumn("n_chars", F.char_length("text").cast("long"))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    return pieces.digests(pieces.encode_pieces(docs, vocabulary("piece_bpe_32k.model")))


STAGES = [("quality rules", quality_stage), ("n-gram Jaccard join", jaccard_stage),
          ("benchmark decontamination", decontamination_stage), ("PII", surrogate_stage),
          ("SentencePiece encoding and decoding", piece_stage)]

#: The last stage has no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
