"""Scores, histograms, reliability, ranking metrics and validation reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def f_beta(tp: Column, k: Column, truth: Column, beta: float = 0.5) -> Column:
    """1 if nothing is emitted and nothing true, 0 without a hit."""
    b2 = beta * beta
    return F.when((k == 0) & (truth == 0), 1.0).when(tp == 0, 0.0).otherwise((1 + b2) * tp / (b2 * truth + k))


def verdict(tp: Column, k: Column, truth: Column) -> Column:
    return (
        F.when((truth == 0) & (k == 0), "singleton_ok")
        .when(truth == 0, "false_merge_on_singleton")
        .when(tp == 0, F.when(k == 0, "missed_all").otherwise("false_merge_on_matched"))
        .when((tp == k) & (tp == truth), "exact")
        .otherwise("partial")
    )


def entity_counts(sizes: DataFrame, selected: DataFrame) -> DataFrame:
    """Every entity with t_size, k (emitted) and tp; selected has q_id, c_id, label. Entities without a prediction emit nothing."""
    per = selected.groupBy("q_id").agg(F.count(F.lit(1)).alias("k"), F.sum("label").alias("tp"))
    return sizes.join(per, "q_id", "left").withColumn("k", F.coalesce("k", F.lit(0))).withColumn("tp", F.coalesce("tp", F.lit(0)))


def entity_f05(counts: DataFrame) -> DataFrame:
    k, tp, t = F.col("k"), F.col("tp"), F.col("t_size")
    return counts.select(
        "q_id",
        "country",
        "t_size",
        "k",
        "tp",
        f_beta(tp, k, t).alias("f05"),
        F.when(k == 0, (t == 0).cast("double")).otherwise(tp / k).alias("precision"),
        F.when(t == 0, (k == 0).cast("double")).otherwise(tp / t).alias("recall"),
        verdict(tp, k, t).alias("verdict"),
    )


def macro(per_entity: DataFrame, *by: str) -> DataFrame:
    """Mean F, precision and recall over entities, and the mean number emitted."""
    return per_entity.groupBy(*by).agg(
        F.count(F.lit(1)).alias("entities"),
        F.round(F.avg("f05"), 6).alias("macro_f05"),
        F.round(F.avg("precision"), 6).alias("macro_precision"),
        F.round(F.avg("recall"), 6).alias("macro_recall"),
        F.round(F.avg("k"), 6).alias("mean_k"),
    )


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("entities"))


def reliability(scored: DataFrame, bins: int = 15, by: str | None = None) -> DataFrame:
    """Per bin: n, mean p, mean label; with `by`, also over all groups together (null group)."""
    binned = scored.withColumn("bin", F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("int"))
    cols = [F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 6).alias("mean_p"), F.round(F.avg("label"), 6).alias("mean_y")]
    if by is None:
        return binned.groupBy("bin").agg(*cols)
    return binned.groupingSets([["bin"], ["bin", by]], "bin", by).agg(*cols)


def ece_brier(scored: DataFrame, bins: int = 15) -> DataFrame:
    """One row: expected calibration error over equal bins, Brier score, rows."""
    binned = scored.withColumn("bin", F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)))
    error = (F.col("p") - F.col("label")) * (F.col("p") - F.col("label"))
    per = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("mp"), F.avg("label").alias("my"), F.sum(error).alias("se"))
    return per.agg(F.round(F.sum(F.col("n") * F.abs(F.col("mp") - F.col("my"))) / F.sum("n"), 6).alias("ece"), F.round(F.sum("se") / F.sum("n"), 6).alias("brier"), F.sum("n").alias("n"))


def _by_score(scored: DataFrame, p: str, label: str, *by: str) -> DataFrame:
    """Rows and positives of every distinct score, so ties are one row and windows run over scores only."""
    return scored.groupBy(*by, F.col(p).alias("v")).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"))


def roc_auc(scored: DataFrame, p: str = "p", label: str = "label", by: str | None = None) -> DataFrame:
    """auc by average ranks, n_pos, n_neg; null if a class is missing."""
    keys = [by] if by else []
    scores = _by_score(scored, p, label, *keys)
    below = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = scores.withColumn("less", F.coalesce(F.sum("n").over(below), F.lit(0)))
    rank = F.col("less") + (F.col("n") + 1) / 2.0
    sums = ranked.groupBy(*keys).agg(F.sum(F.col("pos") * rank).alias("r"), F.sum("pos").alias("n_pos"), F.sum(F.col("n") - F.col("pos")).alias("n_neg"))
    auc = (F.col("r") - F.col("n_pos") * (F.col("n_pos") + 1) / 2.0) / (F.col("n_pos") * F.col("n_neg"))
    return sums.select(*keys, F.round(F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), auc), 6).alias("auc"), "n_pos", "n_neg")


def average_precision(scored: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    """ap: sum over distinct scores of the recall gained times the precision there."""
    scores = _by_score(scored, p, label)
    down = Window.orderBy(F.col("v").desc()).rowsBetween(Window.unboundedPreceding, 0)
    run = scores.withColumn("tp", F.sum("pos").over(down)).withColumn("k", F.sum("n").over(down))
    return run.agg(F.round(F.sum(F.col("pos") * F.col("tp") / F.col("k")) / F.sum("pos"), 6).alias("ap"), F.sum("pos").alias("n_pos"))


def feature_separation(features: DataFrame, names: list[str], label: str = "label") -> DataFrame:
    """Per feature: mean of positives and negatives and its single-feature AUC."""
    long = features.select(label, F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).cast("double").alias("x")) for n in names])).alias("s")).select(label, "s.feature", "s.x")
    means = long.groupBy("feature").agg(F.round(F.avg(F.when(F.col(label) == 1, F.col("x"))), 6).alias("pos_mean"), F.round(F.avg(F.when(F.col(label) == 0, F.col("x"))), 6).alias("neg_mean"))
    return means.join(roc_auc(long, "x", label, "feature").select("feature", "auc"), "feature")


def ev_calibration(per_entity: DataFrame, bins: int = 10) -> DataFrame:
    """Expected against realised F in equal bins; per_entity has expected_f and f05."""
    binned = per_entity.withColumn("bin", F.least(F.floor(F.round(F.col("expected_f"), 6) * bins), F.lit(bins - 1)).cast("int"))
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("expected_f"), 6).alias("mean_expected"), F.round(F.avg("f05"), 6).alias("mean_realised"))


def f05_ceiling_curve(spark) -> DataFrame:
    """The F of perfect precision at recall .50, .52, ... 1.00."""
    r = F.round(F.lit(0.5) + F.col("id") * 0.02, 2)
    return spark.range(26).select(r.alias("recall"), F.round(1.25 * r / (0.25 + r), 6).alias("ceiling"))


def profile(records: DataFrame) -> DataFrame:
    """Per source: rows, empty names and addresses, countries."""
    return records.groupBy("src").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.trim("business_name") == "").alias("empty_name"),
        F.count_if(F.trim("business_address") == "").alias("empty_address"),
        F.count_distinct("country").alias("countries"),
    )


def country_mix(records: DataFrame) -> DataFrame:
    return records.groupBy("src", "country").agg(F.count(F.lit(1)).alias("rows"))


def ablation(rules: DataFrame, chosen: str) -> DataFrame:
    """rules (rule, macro_f05) with the difference from the chosen rule."""
    base = rules.where(F.col("rule") == chosen).select(F.col("macro_f05").alias("base"))
    return rules.join(base).select("rule", "macro_f05", F.round(F.col("macro_f05") - F.col("base"), 6).alias("delta"))
