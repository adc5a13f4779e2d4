"""A training corpus from raw documents: language, exact copies, near copies, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes what a stage kept
and the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import byte_bpe, decontaminate, exact_dedup, language, simhash_near
from tessera.llm.common import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in whose text a language is recognised; the model learns as in op9."""
    model = language.fit(docs, train=~language.held_out())
    return language.drop_unknown(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group joined by a Jaccard similarity of 0.8 or more of five-word shingles the document with the smallest id.

    op8's three words and 2 bits reach only copies that are almost identical; this compares op8's way within a wider radius and verifies.
    """
    return simhash_near.drop_near_copies(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a phrase of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes decoded from them."""
    import public_tokenizers

    ids = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, checked=True)
    return ids.select("doc_id", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("byte_bpe", tokens),
]

#: Trained models and hash-based fingerprints are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
