"""The decision layer: which candidates of an entity to emit.

`expected_f` picks the prefix of the candidates by probability that has the largest expected
F; with independent matches no other subset does better. The fold `pmf` and the curve of a short
list stay in the JVM; `decide` runs the exact rule for lists of up to 64 in an Arrow UDF with prefix
and suffix distributions.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import config


def pmf(probabilities: Column) -> Column:
    """Distribution of the number of successes of independent trials: array of n + 1."""

    def step(acc: Column, p: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(acc)), lambda i: F.coalesce(F.get(acc, i), F.lit(0.0)) * (F.lit(1.0) - p) + F.coalesce(F.get(acc, i - 1), F.lit(0.0)) * p)

    return F.aggregate(probabilities, F.array(F.lit(1.0)), step)


def f_beta(k: Column, t: Column, missed: Column, beta: float = 0.5) -> Column:
    """F of k emitted, t of them right, `missed` true ones not emitted; 1 if there is nothing at all."""
    b2 = beta * beta
    return F.when((k == 0) & (missed == 0), 1.0).when(t == 0, 0.0).otherwise((1 + b2) * t / (b2 * (t + missed) + k))


def curve(probabilities: Column, beta: float = 0.5) -> Column:
    """Expected F of emitting the first 0, 1, ... n of a descending list; nested folds, for short lists."""

    def at(k: Column) -> Column:
        head, tail = pmf(F.slice(probabilities, 1, k)), pmf(F.slice(probabilities, k + 1, F.size(probabilities)))

        def by_hits(acc: Column, t: Column) -> Column:
            inner = F.aggregate(F.sequence(F.lit(0), F.size(tail) - 1), F.lit(0.0), lambda s, f: s + F.get(tail, f) * f_beta(k, t, f, beta))
            return acc + F.get(head, t) * inner

        return F.aggregate(F.sequence(F.lit(0), F.size(head) - 1), F.lit(0.0), by_hits)

    return F.transform(F.sequence(F.lit(0), F.size(probabilities)), at)


def _trial(dist: np.ndarray, p: float) -> np.ndarray:
    out = np.zeros(len(dist) + 1)
    out[:-1] = dist * (1 - p)
    out[1:] += dist * p
    return out


def expected_f(probabilities: np.ndarray, cfg: config.Decision) -> np.ndarray:
    """Expected F of every prefix of a descending list; -1 beyond max_emit."""
    n, b2 = len(probabilities), cfg.beta**2
    mass = cfg.missing_mass if cfg.unclamped_mass else min(1.0, max(0.0, cfg.missing_mass))
    tails = [np.ones(1)]
    for p in probabilities[::-1]:
        tails.append(_trial(tails[-1], float(p)))
    tails.reverse()
    out, head = np.full(n + 1, -1.0), np.ones(1)
    for k in range(min(n, cfg.max_emit) + 1):
        if k:
            head = _trial(head, float(probabilities[k - 1]))
        tail = _trial(tails[k], mass) if mass else tails[k]
        t, missed = np.arange(len(head))[:, None], np.arange(len(tail))[None, :]
        with np.errstate(invalid="ignore", divide="ignore"):
            table = np.where(t == 0, 0.0, (1 + b2) * t / (b2 * (t + missed) + k))
        if k == 0:
            table = (missed == 0).astype(float)
        out[k] = head @ table @ tail
    return out


def choose(probabilities: np.ndarray, cfg: config.Decision) -> tuple[int, float]:
    """(how many of a descending list to emit, expected F) by the rule of cfg; rules without an expectation give 0."""
    n = len(probabilities)
    if n == 0:
        return 0, 1.0
    p = np.clip(probabilities, 0, 1) ** cfg.power if cfg.power != 1 else probabilities
    if cfg.rule == "top1":
        return int(p[0] >= cfg.threshold), 0.0
    if cfg.rule == "topk":
        return min(cfg.fixed_k, n), 0.0
    if cfg.rule == "global_threshold":
        return min(int((p >= cfg.threshold).sum()), cfg.max_emit), 0.0
    if cfg.rule != "expected_f":
        raise ValueError(f"no such rule: {cfg.rule}")
    keep = min(int((p >= cfg.epsilon).sum()) if cfg.epsilon > 0 else n, cfg.longest)
    # What is pruned may still be true: it is missing mass.
    from dataclasses import replace

    values = expected_f(p[:keep], replace(cfg, missing_mass=cfg.missing_mass + float(p[keep:].sum())))
    # Expectations that agree to nine decimals are a tie, which the shorter list wins.
    k = int(np.round(values, 9).argmax())
    return k, float(values[k])


def ranked(scored: DataFrame) -> DataFrame:
    """q_id, items: the entity's (p, c_id) by descending p, then c_id."""
    items = F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("np"), F.col("c_id"))))
    return scored.groupBy("q_id").agg(items.alias("items"))


def decide(scored: DataFrame, cfg: config.Decision = config.Decision()) -> DataFrame:
    """q_id, n_cand, k, expected_f and selected (ids, best first)."""

    @F.pandas_udf("k int, expected_f double")
    def rule(lists: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([choose(np.asarray(x, float), cfg) for x in lists], columns=["k", "expected_f"])

    lists = ranked(scored).withColumn("ps", F.transform("items", lambda x: -x["np"]))
    done = lists.withColumn("r", rule("ps"))
    return done.select("q_id", F.size("items").alias("n_cand"), "r.k", "r.expected_f", F.transform(F.slice("items", 1, F.col("r.k")), lambda x: x["c_id"]).alias("selected"))


def decide_threshold(scored: DataFrame, threshold: float, max_emit: int = 25) -> DataFrame:
    """q_id, k: the native form of the threshold rule."""
    return scored.groupBy("q_id").agg(F.least(F.count_if(F.col("p") >= threshold), F.lit(max_emit)).alias("k"))


def apply(scored: DataFrame, cfg: config.Decision = config.Decision(), repair: bool = True) -> DataFrame:
    """q_id, c_id, p of what is emitted; with repair every record has one entity."""
    from tessera.operators.graph import disjoint_repair

    picked = decide(scored, cfg).select("q_id", F.explode("selected").alias("c_id"))
    out = picked.join(scored.select("q_id", "c_id", "p"), ["q_id", "c_id"])
    return disjoint_repair(out) if repair else out


def missing_mass_heuristic(per_entity: DataFrame, recall: float) -> DataFrame:
    """Adds missing_mass: what blocking at this recall is expected to have missed, 0 to 8; per_entity has n_cand and p_sum."""
    factor = (1 - recall) / recall
    raw = F.when(F.col("n_cand") == 0, F.greatest(F.col("p_sum") * factor, F.lit(factor))).otherwise(F.col("p_sum") * factor)
    return per_entity.withColumn("missing_mass", F.least(F.greatest(raw, F.lit(0.0)), F.lit(8.0)))


def brute_force(probabilities: list[float], missing_mass: float = 0.0, beta: float = 0.5) -> float:
    """The best expected F of any subset, by enumeration; for tests."""
    n, b2, best = len(probabilities), beta * beta, 0.0
    for size in range(n + 1):
        for chosen in combinations(range(n), size):
            total = 0.0
            for world in range(1 << n):
                weight = np.prod([p if world >> i & 1 else 1 - p for i, p in enumerate(probabilities)])
                t = sum(world >> i & 1 for i in chosen)
                for extra, mass in ((0, 1 - missing_mass), (1, missing_mass)):
                    truth = world.bit_count() + extra
                    value = 1.0 if size == 0 and truth == 0 else 0.0 if t == 0 else (1 + b2) * t / (b2 * truth + size)
                    total += weight * mass * value
            best = max(best, total)
    return best
