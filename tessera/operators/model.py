"""Two-stage matchers on MLlib and calibration by isotonic regression."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOW, HIGH = 1e-6, 1 - 1e-6


def split_by_entity(pairs: DataFrame, val_percent: int = 20, entity: str = "q_id") -> DataFrame:
    """Adds is_val; all pairs of an entity go to one side, chosen by the hash of its id."""
    return pairs.withColumn("is_val", F.pmod(F.xxhash64(entity), F.lit(100)) < val_percent)


def holdout_country(pairs: DataFrame, country: str) -> DataFrame:
    return pairs.withColumn("is_val", F.col("country") == country)


def case_control(pairs: DataFrame, most: int) -> DataFrame:
    """All positives and, by the hash of the pair, negatives up to the room left (a tenth of `most` at least)."""
    n = pairs.groupBy("label").count().collect()
    counts = {r["label"]: r["count"] for r in n}
    room = max(most - counts.get(1, 0), most // 10)
    share = min(1.0, room / max(1, counts.get(0, 0)))
    keep = F.pmod(F.xxhash64("q_id", "c_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    return pairs.where((F.col("label") == 1) | keep)


def _classifier(kind: str, seed: int):
    if kind == "gbt":
        return GBTClassifier(labelCol="label", featuresCol="features", maxDepth=5, maxIter=20, stepSize=0.1, seed=seed)
    if kind == "forest":
        return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=30, maxDepth=6, seed=seed)
    if kind == "logistic":
        return LogisticRegression(labelCol="label", featuresCol="features", regParam=0.01)
    raise ValueError(f"no such matcher: {kind}")


def fit(train: DataFrame, features: list[str], kind: str = "gbt", seed: int = 7) -> PipelineModel:
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), _classifier(kind, seed)]).fit(train)


def score(model: PipelineModel, pairs: DataFrame, into: str = "p1") -> DataFrame:
    done = model.transform(pairs).withColumn(into, vector_to_array("probability")[1])
    return done.drop("features", "rawPrediction", "probability", "prediction")


def ensemble(train: DataFrame, pairs: DataFrame, features: list[str], kinds: tuple[str, ...] = ("gbt", "forest", "logistic"), into: str = "p1") -> DataFrame:
    """The mean of the members' ranks, each scaled to 0..1 over the pairs."""
    out = pairs
    for kind in kinds:
        out = score(fit(train, features, kind), out, f"_{kind}").withColumn(f"_{kind}", F.round(f"_{kind}", 6))
        out = rank_norm(out, f"_{kind}", f"_r_{kind}")
    mean = sum((F.col(f"_r_{k}") for k in kinds), F.lit(0.0)) / len(kinds)
    return out.withColumn(into, mean).drop(*[f"{x}{k}" for k in kinds for x in ("_", "_r_")])


def save_bundle(model: PipelineModel, path: str, features: list[str], **meta) -> None:
    """A fitted model with its feature list and metadata, in a folder; an existing one stays and is an error."""
    spark = SparkSession.getActiveSession()
    model.save(f"{path}/model")
    spark.createDataFrame([(json.dumps({"features": features, "meta": meta}),)], "value string").coalesce(1).write.text(f"{path}/about")


def load_bundle(path: str) -> tuple[PipelineModel, list[str], dict]:
    """(model, features, metadata) as `save_bundle` left them."""
    about = json.loads(SparkSession.getActiveSession().read.text(f"{path}/about").first()["value"])
    return PipelineModel.load(f"{path}/model"), about["features"], about["meta"]


def importances(model: PipelineModel, features: list[str]) -> list[tuple[str, float]]:
    weights = model.stages[-1].featureImportances.toArray()
    total = float(weights.sum()) or 1.0
    return sorted(((f, float(w) / total) for f, w in zip(features, weights, strict=True)), key=lambda x: -x[1])


def n_parameters(model: PipelineModel) -> int:
    last = model.stages[-1]
    return sum(t.numNodes for t in last.trees) if hasattr(last, "trees") else last.numFeatures + 1


def rank_norm(df: DataFrame, value: str, into: str = "rank_norm") -> DataFrame:
    """Average rank scaled to [0, 1]; over distinct values, so that no task holds all rows."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    below = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.withColumn("_less", F.coalesce(F.sum("_n").over(below), F.lit(0))).withColumn("_all", F.sum("_n").over(Window.partitionBy()))
    ranks = ranks.select(value, F.when(F.col("_all") == 1, 0.0).otherwise((F.col("_less") + (F.col("_n") - 1) / 2.0) / (F.col("_all") - 1)).alias(into))
    return df.join(ranks, value)


def isotonic_knots(df: DataFrame, x: str, y: str) -> tuple[list[float], list[float]]:
    """Boundaries and values of an isotonic fit; few, whatever the rows."""
    rows = VectorAssembler(inputCols=[x], outputCol="_x").transform(df.select(F.col(x).cast("double"), F.col(y).cast("double")))
    model = IsotonicRegression(featuresCol="_x", labelCol=y).fit(rows)
    return list(model.boundaries.toArray()), list(model.predictions.toArray())


def interpolate(value: Column, knots: tuple[list[float], list[float]]) -> Column:
    """Linear between knots, level beyond them."""
    xs, ys = knots
    if not xs:
        return value
    x_arr, y_arr = F.array(*map(F.lit, xs)), F.array(*map(F.lit, ys))
    i = F.aggregate(x_arr, F.lit(0), lambda acc, x: acc + (x <= value).cast("int"))
    left_x, right_x, left_y, right_y = F.get(x_arr, i - 1), F.get(x_arr, i), F.get(y_arr, i - 1), F.get(y_arr, i)
    between = left_y + (right_y - left_y) * F.when(right_x == left_x, 0.0).otherwise((value - left_x) / (right_x - left_x))
    return F.when(i == 0, ys[0]).when(i >= len(xs), ys[-1]).otherwise(between)


def group_calibrate(train: DataFrame, pairs: DataFrame, group: str = "country", least: int = 5000, p: str = "p", into: str = "p_cal") -> DataFrame:
    """Isotonic calibration by group; a group with too few rows or one class uses the pooled fit."""
    pooled = isotonic_knots(train, p, "label")
    out = interpolate(F.col(p), pooled)
    for row in train.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).orderBy(group).collect():
        if row["n"] >= least and 0 < row["pos"] < row["n"]:
            knots = isotonic_knots(train.where(F.col(group) == row[group]), p, "label")
            out = F.when(F.col(group) == row[group], interpolate(F.col(p), knots)).otherwise(out)
    return pairs.withColumn(into, F.least(F.greatest(out, F.lit(LOW)), F.lit(HIGH)))


#: Candidate counts at which missing mass is fitted apart.
MASS_EDGES = (1, 8, 20, 36, 10000)


def missing_mass_fitted(train: DataFrame, entities: DataFrame, least: int = 2000, scale: float = 1.0) -> DataFrame:
    """entities (n_cand, p_sum) with missing_mass = max(E[t_size] - p_sum, 0) * scale, at most 10; train also has t_size."""
    out = interpolate(F.col("p_sum"), isotonic_knots(train, "p_sum", "t_size"))
    for low, high in zip(MASS_EDGES[:-1], MASS_EDGES[1:], strict=True):
        own = train.where((F.col("n_cand") >= low) & (F.col("n_cand") < high))
        if own.count() >= least:
            out = F.when((F.col("n_cand") >= low) & (F.col("n_cand") < high), interpolate(F.col("p_sum"), isotonic_knots(own, "p_sum", "t_size"))).otherwise(out)
    return entities.withColumn("expected_truth", out).withColumn("missing_mass", F.least(F.greatest(F.col("expected_truth") - F.col("p_sum"), F.lit(0.0)) * scale, F.lit(10.0)))


def adopt(stage1_ap: float, stage2_ap: float) -> bool:
    """The second stage counts only if it ranks at least as well."""
    return stage2_ap >= stage1_ap
