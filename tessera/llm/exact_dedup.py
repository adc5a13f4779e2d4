"""Exact dedup by skew-safe combining.

Texts are deduplicated inside each map task, the survivors are merged within (digest, salt)
groups, and the salt winners are combined globally. Text is a grouping key of all three
aggregations, so equal digests never stand in for equal content. A hot text reaches the
last step with at most `salts` rows, however many documents carry it.

Defined cases: null text counts as empty; a null id loses against any id (a group of null
ids only keeps null); rows that repeat an id and its text share one decision and each count
in group_size; an empty table gives no rows; columns of other names are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SALTS = 8


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def combine(docs: DataFrame, id_col: str, text_col: str, salts: int = SALTS, digest=sha256_hex) -> DataFrame:
    """One row per distinct text: dx (digest), tx (text), keep_id (largest id), group_size."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("ix"), text.alias("tx"), digest(text).alias("dx"))
    # The salt is the map task's, so the local step leaves one row of a text in a task.
    local = rows.withColumn("sx", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = local.groupBy("dx", "sx", "tx").agg(F.max("ix").alias("ix"), F.count(F.lit(1)).alias("nx"))
    return salted.groupBy("dx", "tx").agg(F.max("ix").alias("keep_id"), F.sum("nx").alias("group_size"))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest=sha256_hex) -> DataFrame:
    """Per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    winners = written(combine(docs, id_col, text_col, salts, digest).select("dx", "keep_id", "group_size"), "exact-winners", codec="none")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("tx"), digest(text).alias("dx"))
    clashes = winners.groupBy("dx").count().where("count > 1").select("dx")
    if clashes.isEmpty():
        joined = rows.join(winners, "dx")
    else:
        # Different texts of one digest: those digests, and only those, are joined by content.
        clashing = docs.withColumn("dx", digest(text)).join(clashes, "dx", "left_semi")
        by_text = combine(clashing, id_col, text_col, salts, digest)
        alone = rows.join(winners.join(clashes, "dx", "left_anti"), "dx")
        joined = alone.unionByName(rows.join(by_text, ["dx", "tx"]).select(alone.columns))
    sha = F.col("dx") if digest is sha256_hex else sha256_hex(F.col("tx"))
    return joined.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id").eqNullSafe(F.col("keep_id")), F.lit(False)).alias("kept"), sha.alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """docs with one row of each text, that of the largest id, all columns kept.

    The combining steps carry the row along, so what they end with is the result and the
    documents are read once. Of rows that repeat an id the other columns decide.
    """
    others = [id_col, *(c for c in docs.columns if c not in (id_col, text_col))]
    text = F.coalesce(docs[text_col], F.lit(""))
    row = F.struct(*[docs[c].alias(f"r{i}") for i, c in enumerate(others)], docs[text_col].isNotNull().alias("given"))
    rows = docs.select(text.alias("tx"), sha256_hex(text).alias("dx"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("sx"), row.alias("rx"))
    salted = rows.groupBy("dx", "sx", "tx").agg(F.max("rx").alias("rx"))
    whole = salted.groupBy("dx", "tx").agg(F.max("rx").alias("rx"))
    back = {c: F.col(f"rx.r{i}") for i, c in enumerate(others)} | {text_col: F.when(F.col("rx.given"), F.col("tx"))}
    return whole.select(*[back[c].alias(c) for c in docs.columns])
