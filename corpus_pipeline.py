"""From raw documents to token ids, as stages of the operators in ``riskflow.llm``.

Each stage takes (spark, docs, sf_dir) and works on what its predecessor kept; its
result is written as Parquet and read again as the next one's ``docs``.  All but
the last return the columns of ``documents``, whatever they are.

A document without doc_id goes through the stages like any other as long as its
text is new: of equal texts one row stays, whatever the ids, and one with an id
before one without; near copies of a document without id are not looked for.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskflow.llm import byte_bpe, decontaminate, exact_dedup, near_dedup, quality
from riskflow.llm.common import table, written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.drop_junk(docs)


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id."""
    return exact_dedup.drop_duplicates(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near_dedup.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(spark, docs, vocabulary, public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", classify),
    ("exact_dedup", dedup_exact),
    ("minhash_near_dedup", dedup_near),
    ("decontamination", drop_leaks),
    ("byte_bpe", tokenise),
]

#: SQL can express neither the classifier nor the tokens; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
