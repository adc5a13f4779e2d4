"""Labels of candidate pairs and how much of the truth blocking keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_labels(cands: DataFrame, links: DataFrame) -> DataFrame:
    """cands with label 1 where the pair is a true link."""
    hit = links.select("q_id", "c_id").distinct().withColumn("hit", F.lit(1))
    return cands.join(hit, ["q_id", "c_id"], "left").withColumn("label", F.coalesce("hit", F.lit(0))).drop("hit")


def with_key_labels(cands: DataFrame, keys: DataFrame) -> DataFrame:
    """with_labels where links are equal keys of (id, src, key): no link but those of the candidates is made."""
    of = keys.where("key IS NOT NULL").groupBy("id", "src").agg(F.collect_set("key").alias("own"))
    q, c = of.where("src = 1").select(F.col("id").alias("q_id"), F.col("own").alias("_q")), of.where("src > 1").select(F.col("id").alias("c_id"), F.col("own").alias("_c"))
    both = cands.join(q, "q_id", "left").join(c, "c_id", "left")
    return both.withColumn("label", F.coalesce(F.arrays_overlap("_q", "_c").cast("int"), F.lit(0))).select(*cands.columns, "label")


def linked(keys: DataFrame, queries: bool = True) -> DataFrame:
    """id, n: records of the other side with one of its keys, for records that have any; pairs are counted by key.

    Only pairs of records that both have several keys, as repeated ids have, are made, to count them once.
    """
    rows = keys.where("key IS NOT NULL").select("id", (F.col("src") == 1).alias("q"), "key").distinct()
    own, other = rows.where(F.col("q") == queries).drop("q"), rows.where(F.col("q") != queries).drop("q")
    sums = own.join(other.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key").select("id", "n")

    def several(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(F.col("id").alias(name)).agg(F.collect_list("key").alias("key")).where(F.size("key") > 1).select(name, F.explode("key").alias("key"))

    again = several(own, "id").join(several(other, "other"), "key").groupBy("id", "other").agg((F.count(F.lit(1)) - 1).alias("twice"))
    sums = sums.groupBy("id").agg(F.sum("n").alias("n")).join(again.groupBy("id").agg(F.sum("twice").alias("twice")), "id", "left")
    return sums.select("id", (F.col("n") - F.coalesce("twice", F.lit(0))).alias("n"))


def key_sizes(entities: DataFrame, keys: DataFrame) -> DataFrame:
    """truth_sizes of links that are equal keys."""
    sizes = linked(keys).select(F.col("id").alias("q_id"), F.col("n").alias("t_size"))
    return entities.join(sizes, "q_id", "left").withColumn("t_size", F.coalesce("t_size", F.lit(0)))


def truth_sizes(entities: DataFrame, links: DataFrame) -> DataFrame:
    """Every entity (q_id, country) with t_size, 0 for those without a link."""
    sizes = links.groupBy("q_id").agg(F.count_distinct("c_id").alias("t_size"))
    return entities.join(sizes, "q_id", "left").withColumn("t_size", F.coalesce("t_size", F.lit(0)))


def blocking_recall(labelled: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row: micro and macro recall (an entity without truth counts 1), entities fully found and not found at all."""
    found = labelled.groupBy("q_id").agg(F.sum("label").alias("found"), F.count(F.lit(1)).alias("n_cand"))
    per = sizes.join(found, "q_id", "left").select("t_size", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("n_cand", F.lit(0)).alias("n_cand"))
    recall = F.when(F.col("t_size") == 0, 1.0).otherwise(F.col("found") / F.col("t_size"))
    return per.agg(
        F.count(F.lit(1)).alias("entities"),
        F.sum("n_cand").alias("pairs"),
        F.round(F.sum("found") / F.sum("t_size"), 6).alias("micro_recall"),
        F.round(F.avg(recall), 6).alias("macro_recall"),
        F.count_if((F.col("t_size") > 0) & (F.col("found") == F.col("t_size"))).alias("full_recall"),
        F.count_if((F.col("t_size") > 0) & (F.col("found") == 0)).alias("zero_recall"),
    )


def channel_attribution(labelled: DataFrame) -> DataFrame:
    """Per channel mask: pairs and true pairs; a mask of one bit is what that channel alone finds."""
    return labelled.groupBy("mask").agg(F.count(F.lit(1)).alias("pairs"), F.sum("label").alias("true_pairs"))


def candidate_stats(cands: DataFrame, n_index: DataFrame) -> DataFrame:
    """One row: pairs, entities, mean and most candidates, share of the cross product that blocking skips."""
    per = cands.groupBy("q_id").agg(F.count(F.lit(1)).alias("n"))
    stats = per.agg(F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("entities"), F.round(F.avg("n"), 6).alias("mean_candidates"), F.max("n").alias("most_candidates"))
    return stats.join(n_index).select("pairs", "entities", "mean_candidates", "most_candidates", F.round(1.0 - F.col("pairs") / (F.col("n_q") * F.col("n_c")), 6).alias("reduction"))


def referenced(index: DataFrame, cands: DataFrame) -> DataFrame:
    """Index records that some pair names."""
    return index.join(cands.select(F.col("c_id").alias("id")), "id", "left_semi")


def missing_entities(entities: DataFrame, predictions: DataFrame) -> DataFrame:
    return entities.join(predictions.select("q_id"), "q_id", "left_anti")


def truth_structure(sizes: DataFrame) -> DataFrame:
    """Histogram of truth sizes with the cumulative share of entities."""
    from pyspark.sql import Window

    hist = sizes.groupBy("t_size").agg(F.count(F.lit(1)).alias("entities"))
    running = F.sum("entities").over(Window.orderBy("t_size").rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("entities").over(Window.partitionBy())
    return hist.select("t_size", "entities", F.round(running / whole, 6).alias("cumulative_share"))


def disjointness(links: DataFrame) -> DataFrame:
    """One row: linked records, those of several entities, the most entities of one."""
    return reuse(links.groupBy("c_id").agg(F.count_distinct("q_id").alias("n")))


def reuse(per: DataFrame) -> DataFrame:
    """The row of `disjointness` from n, the entities of each linked record."""
    return per.agg(F.count(F.lit(1)).alias("linked"), F.count_if(F.col("n") > 1).alias("reused"), F.max("n").alias("max_reuse"))
