"""The read-only service surface as methods that return DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import __version__, config
from tessera.functions.text import with_address_parts, with_name_parts
from tessera.operators import decide, evaluate
from tessera.sources import io

MOST_ROWS = 200


class Engine:
    """scored: pairs (q_id, c_id, p, label, src); sizes: entities (q_id, country, t_size); store: records with normalised views."""

    def __init__(self, spark: SparkSession, scored: DataFrame, sizes: DataFrame, store: DataFrame):
        self.spark, self.scored, self.sizes, self.store = spark, scored, sizes, store

    def capabilities(self) -> dict:
        return {"version": __version__, "spark": self.spark.version, "rules": ["expected_f", "global_threshold", "top1", "topk"]}

    def normalise(self, name: str, address: str) -> DataFrame:
        row = self.spark.createDataFrame([(name, address)], "business_name string, business_address string")
        return with_address_parts(with_name_parts(row, scripts=True), scripts=True)

    def preview(self, limit: int = 50, offset: int = 0) -> DataFrame:
        return self.store.orderBy("id").offset(offset).limit(min(limit, MOST_ROWS))

    def country_mix(self) -> DataFrame:
        return evaluate.country_mix(self.store)

    def per_entity(self, cfg: config.Decision = config.Decision(), repair: bool = True) -> DataFrame:
        """Every entity with k, tp, f05, verdict and the expected F of its decision."""
        picked = decide.apply(self.scored, cfg, repair).join(self.scored.select("q_id", "c_id", "label"), ["q_id", "c_id"])
        scores = evaluate.entity_f05(evaluate.entity_counts(self.sizes, picked))
        expected = decide.decide(self.scored, cfg).select("q_id", "n_cand", "k", "expected_f").withColumnRenamed("k", "k_star")
        return scores.join(expected, "q_id", "left").withColumn("n_cand", F.coalesce("n_cand", F.lit(0))).withColumn("k_star", F.coalesce("k_star", F.lit(0))).withColumn("expected_f", F.coalesce("expected_f", F.lit(1.0)))

    def simulate(self, cfg: config.Decision, repair: bool = True) -> dict[str, DataFrame]:
        """The aggregates of one decision setting."""
        per = self.per_entity(cfg, repair).persist()
        return {
            "macro": evaluate.macro(per),
            "by_country": evaluate.macro(per, "country"),
            "verdicts": evaluate.histogram(per, "verdict"),
            "k": evaluate.histogram(per, "k"),
            "truth": evaluate.histogram(per, "t_size"),
            "ev_calibration": evaluate.ev_calibration(per),
        }

    def entities(self, verdict: str | None = None, country: str | None = None, text: str | None = None, sort: str = "f05", descending: bool = False, page: int = 0, size: int = 50) -> DataFrame:
        """A page of entities; sort by f05, n_cand, k_star or q_id."""
        if sort not in ("f05", "n_cand", "k_star", "q_id"):
            raise ValueError(f"cannot sort by {sort}")
        per = self.per_entity()
        per = per if verdict is None else per.where(F.col("verdict") == verdict)
        per = per if country is None else per.where(F.col("country") == country)
        per = per if text is None else per.where(F.contains(F.lower("q_id"), F.lit(text.lower())))
        size = min(size, MOST_ROWS)
        return per.orderBy(F.col(sort).desc() if descending else F.col(sort), "q_id").offset(page * size).limit(size)

    def entity(self, q_id: str) -> DataFrame:
        """An entity's candidates by descending probability."""
        return self.scored.where(F.col("q_id") == q_id).orderBy(F.col("p").desc(), "c_id")

    def ev_curve(self, q_id: str) -> DataFrame:
        """k and the expected F of emitting the first k, without pruning or missing mass."""
        lists = decide.ranked(self.scored.where(F.col("q_id") == q_id)).select(F.transform("items", lambda x: -x["np"]).alias("ps"))

        @F.pandas_udf("array<double>")
        def whole(ps):
            import numpy as np

            return ps.map(lambda x: decide.expected_f(np.asarray(x, float), config.Decision()).tolist())

        return lists.select(F.posexplode(whole("ps")).alias("k", "expected_f"))

    def validate(self, lists: DataFrame) -> DataFrame:
        required = self.sizes.select("q_id")
        return io.validate_lists(required, lists, self.store.where("src > 1").select("id"))

    def ceiling(self) -> DataFrame:
        return evaluate.f05_ceiling_curve(self.spark)
