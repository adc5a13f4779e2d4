"""The decision layer against enumeration."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera import config
from tessera.operators import decide


def test_pmf_against_enumeration(spark):
    ps = [0.1, 0.2, 0.7]
    got = spark.range(1).select(decide.pmf(F.array(*map(F.lit, ps))).alias("x")).first()["x"]
    want = [0.0] * 4
    for world in itertools.product([0, 1], repeat=3):
        want[sum(world)] += float(np.prod([p if w else 1 - p for p, w in zip(ps, world, strict=True)]))
    assert got == pytest.approx(want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0, 1).map(lambda x: round(x, 3)), min_size=1, max_size=6), st.sampled_from([0.0, 0.15, 0.4]))
def test_best_prefix_is_best_subset(probabilities, mass):
    p = np.sort(np.array(probabilities))[::-1]
    curve = decide.expected_f(p, config.Decision(missing_mass=mass))
    assert curve.max() == pytest.approx(decide.brute_force(list(p), mass), abs=1e-9)


def test_nothing_emitted_is_right_if_nothing_is_true():
    p = np.array([0.3, 0.2])
    assert decide.expected_f(p, config.Decision())[0] == pytest.approx(0.7 * 0.8)


def test_native_curve_equals_arrow_curve(spark):
    random.seed(3)
    for n in (1, 2, 4):
        p = sorted((round(random.random(), 3) for _ in range(n)), reverse=True)
        native = spark.range(1).select(decide.curve(F.array(*map(F.lit, p))).alias("x")).first()["x"]
        assert native == pytest.approx(list(decide.expected_f(np.array(p), config.Decision())))


def test_rules():
    p = np.array([0.9, 0.6, 0.4, 0.2])
    assert decide.choose(p, config.Decision(rule="top1"))[0] == 1
    assert decide.choose(p, config.Decision(rule="topk"))[0] == 3
    assert decide.choose(p, config.Decision(rule="global_threshold"))[0] == 2
    assert decide.choose(np.array([]), config.Decision()) == (0, 1.0)
    with pytest.raises(ValueError):
        decide.choose(p, config.Decision(rule="other"))


def test_pruned_probability_is_missing_mass():
    p = np.array([0.9, 0.009, 0.009])
    k, value = decide.choose(p, config.Decision())
    assert (k, value) == (1, pytest.approx(decide.expected_f(p[:1], config.Decision(missing_mass=0.018))[1]))


def test_missing_mass_above_one_is_clamped():
    p = np.array([0.5])
    clamped = decide.expected_f(p, config.Decision(missing_mass=2.5))
    assert clamped == pytest.approx(decide.expected_f(p, config.Decision(missing_mass=1.0)))
    assert (clamped >= 0).all()


def test_repair_gives_a_record_one_entity(spark):
    rows = [("q1", "c1", 0.9, 1), ("q2", "c1", 0.9, 0), ("q2", "c2", 0.8, 1)]
    scored = spark.createDataFrame(rows, "q_id string, c_id string, p double, label int")
    got = {(r.q_id, r.c_id) for r in decide.apply(scored, config.Decision(rule="topk")).collect()}
    assert got == {("q1", "c1"), ("q2", "c2")}


def test_equal_expectations_take_the_shorter_list():
    assert decide.choose(np.array([0.5 + 1e-12]), config.Decision())[0] == 0


def test_the_query_looks_at_every_candidate(spark, monkeypatch):
    """Seventy candidates, more than the 64 of the default setting."""
    from tessera.plans import catalog

    p = np.linspace(0.9, 0.1, 70)
    scored = spark.createDataFrame([("q", f"c{i:02d}", float(x)) for i, x in enumerate(p)], "q_id string, c_id string, p double")
    monkeypatch.setattr(catalog, "_unlabelled", lambda s, d: scored)
    row = catalog.queries()["decide_expected_f"](spark, "").first()
    want = decide.expected_f(p, config.Decision())
    assert (row.k, row.expected_f) == (int(want.argmax()), pytest.approx(want.max(), abs=1e-6))
