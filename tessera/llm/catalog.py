"""Queries op1 to op10 by name, with SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontaminate, exact_dedup, language, line_dedup, quality, sharding, simhash, suffix_dedup, token_blocks
from .common import work_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.digests(decontaminate.matches(_documents(spark, sf_dir), benchmark))


_WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
items AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT item_id, w, least(10, len(w)) AS size FROM items WHERE len(w) > 0),
phrases AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT size FROM phrases),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
found AS (SELECT p.doc_id, p.i, p.size, q.item_id FROM places p JOIN phrases q ON p.phrase = q.phrase AND p.size = q.size),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, list(DISTINCT CAST(item_id AS VARCHAR)) AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
       sha256(coalesce(array_to_string(list_sort(ids), ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.digests(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_blocks.read_files(token_blocks.write_files(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = quality.fit(docs, labels, train_rows=~quality.held_out())
    scored = quality.score(docs, machine)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(_documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the shard that holds it after compaction."""
    store = sharding.ShardStore(spark, work_path(spark, "shards"))
    store.append(_documents(spark, sf_dir))
    store.compact()
    store.vacuum()
    stored = store.read(file_col="shard_file")
    if stored is None:
        stored = _documents(spark, sf_dir).limit(0).withColumn("shard_file", F.lit(""))
    placed = stored.join(store.shards(), "shard_file")
    return placed.select("doc_id", "shard", "shard_rows", "shard_bytes", "merged_from", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.decisions(_documents(spark, sf_dir))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(_documents(spark, sf_dir))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = language.fit(docs, train=~language.held_out())
    return language.predict(docs, model).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "languages")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(_documents(spark, sf_dir))


OP10_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


def queries() -> dict:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_token_blocks": op3_token_blocks,
        "op4_quality": op4_quality,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_sharding": op6_sharding,
        "op7_line_dedup": op7_line_dedup,
        "op8_simhash": op8_simhash,
        "op9_language": op9_language,
        "op10_exact_dedup": op10_exact_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": OP1_SQL, "op10_exact_dedup": OP10_SQL}
