"""Competition of entities for a record and corroboration between an entity's candidates: windows alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import config

NONE_LOGIT = -30.0
FULL = (Window.unboundedPreceding, Window.unboundedFollowing)


def logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1.0 - 1e-6))
    return F.log(q / (1.0 - q))


def group_stats(df: DataFrame, group: str, value: str, tie: str) -> DataFrame:
    """Adds n, rank (from 0), best and second of `value` in each group; second is null in groups of one."""
    ordered = Window.partitionBy(group).orderBy(F.col(value).desc(), tie)
    whole = ordered.rowsBetween(*FULL)
    return df.select("*", F.count(F.lit(1)).over(whole).alias("n"), (F.row_number().over(ordered) - 1).alias("rank"), F.max(value).over(whole).alias("best"), F.nth_value(value, 2).over(whole).alias("second"))


def competition(scored: DataFrame, cfg: config.Graph = config.Graph()) -> DataFrame:
    """q_id, c_id, p1, p1_logit and the six compete_ columns."""
    base = group_stats(scored.select("q_id", "c_id", F.col("p").alias("p1"), logit(F.col("p")).alias("p1_logit")), "c_id", "p1_logit", "q_id")
    lg, best = F.col("p1_logit"), F.col("best")
    margin = F.when(F.col("n") == 1, F.lit(-NONE_LOGIT)).when(F.col("rank") == 0, lg - F.greatest(F.col("second"), F.lit(NONE_LOGIT))).otherwise(lg - best)
    ratio = F.when(best == 0, 1.0).otherwise(lg / best)
    z = F.exp(F.greatest(F.lit(-60.0), F.least(F.lit(0.0), (lg - best) / cfg.tau)))
    step = base.withColumn("z", z)
    null = F.exp(F.greatest(F.lit(-60.0), F.least(F.lit(30.0), (F.lit(cfg.null_logit) - best) / cfg.tau)))
    soft = F.col("z") / (F.sum("z").over(Window.partitionBy("c_id")) + null)
    return step.select(
        "q_id",
        "c_id",
        "p1",
        "p1_logit",
        F.col("n").alias("compete_count"),
        F.col("rank").alias("compete_rank"),
        (F.col("rank") == 0).cast("int").alias("compete_is_best"),
        margin.alias("compete_margin"),
        F.greatest(F.lit(-10.0), F.least(F.lit(10.0), ratio)).alias("compete_ratio"),
        soft.alias("compete_softmax"),
    )


def entity_profile(scored: DataFrame) -> DataFrame:
    """q_id, c_id and the eight entity_ columns; scored has src."""
    q = Window.partitionBy("q_id")
    own = Window.partitionBy("q_id", "src")
    order = [F.col("p").desc(), F.col("c_id")]
    return scored.select(
        "q_id",
        "c_id",
        F.count(F.lit(1)).over(q).alias("entity_cand_count"),
        (F.row_number().over(q.orderBy(*order)) - 1).alias("entity_p_rank"),
        F.max("p").over(q).alias("entity_p_max"),
        F.sum("p").over(q).alias("entity_p_sum"),
        (F.col("p") - F.max("p").over(q)).alias("entity_p_margin_to_max"),
        F.avg("p").over(q).alias("entity_p_mean"),
        (F.row_number().over(own.orderBy(*order)) - 1).alias("entity_rank_in_source"),
        F.max("p").over(own).alias("entity_source_p_max"),
    )


def corroboration(scored: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Per key: candidates of the same entity with an equal, non-empty key, and the best p among them.

    The best of the others is the second best where a row is itself the best.
    """
    # Dealt by the entity once, which serves the windows of all keys.
    out, columns = scored.select("q_id", "c_id", "p", *dict.fromkeys(keys.values())).repartition("q_id"), ["q_id", "c_id"]
    for name, key in keys.items():
        has = F.col(key) != ""
        own = Window.partitionBy("q_id", key)
        ordered = own.orderBy(F.col("p").desc(), "c_id")
        out = out.select(
            "*",
            F.row_number().over(ordered).alias("_rk"),
            F.count(F.lit(1)).over(own).alias("_n"),
            F.max("p").over(own).alias("_p1"),
            F.nth_value("p", 2).over(ordered.rowsBetween(*FULL)).alias("_p2"),
        )
        others = F.when(has, F.col("_n") - 1).otherwise(0)
        best = F.when(has & (F.col("_n") > 1), F.when(F.col("_rk") == 1, F.col("_p2")).otherwise(F.col("_p1"))).otherwise(0.0)
        out = out.withColumn(f"corr_{name}_count", others).withColumn(f"corr_{name}_best_other_p", best).drop("_rk", "_n", "_p1", "_p2")
        columns += [f"corr_{name}_count", f"corr_{name}_best_other_p"]
    return out.select(*columns)


def other_source(scored: DataFrame) -> DataFrame:
    """q_id, c_id, other_source_best_p and other_source_count: the entity's candidates of the other index sources."""
    q = Window.partitionBy("q_id")
    own = Window.partitionBy("q_id", "src")
    sums = scored.select("q_id", "c_id", "src", F.count(F.lit(1)).over(q).alias("n"), F.count(F.lit(1)).over(own).alias("n_own"), *[F.max(F.when(F.col("src") == s, F.col("p"))).over(q).alias(f"m{s}") for s in (2, 3)])
    best = F.when(F.col("src") == 2, F.col("m3")).otherwise(F.col("m2"))
    return sums.select("q_id", "c_id", F.coalesce(best, F.lit(0.0)).alias("other_source_best_p"), (F.col("n") - F.col("n_own")).alias("other_source_count"))


def graph_features(scored: DataFrame, keys: dict[str, str], cfg: config.Graph = config.Graph()) -> DataFrame:
    """All 24 columns, NaN as 0 and infinities as +-30; scored has q_id, c_id, src, p and the keys."""
    pair = ["q_id", "c_id"]
    whole = competition(scored, cfg).join(entity_profile(scored), pair).join(corroboration(scored, keys), pair).join(other_source(scored), pair)
    clean = [F.greatest(F.lit(NONE_LOGIT), F.least(F.lit(-NONE_LOGIT), F.nanvl(F.col(c).cast("double"), F.lit(0.0)))).alias(c) for c in whole.columns if c not in pair and not c.endswith(("_count", "_rank"))]
    kept = [F.col(c) for c in whole.columns if c in pair or c.endswith(("_count", "_rank"))]
    return whole.select(*kept, *clean)


def disjoint_repair(selected: DataFrame) -> DataFrame:
    """Of the entities that claim a record, the one with the highest p keeps it."""
    claim = Window.partitionBy("c_id").orderBy(F.col("p").desc(), "q_id")
    return selected.withColumn("_rn", F.row_number().over(claim)).where("_rn = 1").drop("_rn")
