"""Operators on small tables against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tessera import config
from tessera.functions import fuzzy
from tessera.operators import alias, blocking, evaluate, graph, labels, model
from tessera.sources import adapter, io


def test_union_against_dictionary(spark):
    random.seed(7)
    rows = [[(f"q{q}", f"c{c}", round(random.random(), 3)) for q in range(6) for c in random.sample(range(20), 8)] for _ in range(2)]
    channels = [(spark.createDataFrame(r, "q_id string, c_id string, score double"), bit) for r, bit in zip(rows, (1, 2), strict=True)]
    got = {(r.q_id, r.c_id): (r.score, r.mask, r.cand_rank) for r in blocking.union(channels, 5).collect()}
    best = {}
    for r, bit in zip(rows, (1, 2), strict=True):
        for q, c, score in r:
            old = best.get((q, c), (0.0, 0))
            best[q, c] = max(old[0], score), old[1] | bit
    want = {}
    for q in {k[0] for k in best}:
        mine = sorted(((-v[0], k[1], v[1]) for k, v in best.items() if k[0] == q))[:5]
        want |= {(q, c): (-s, m, i) for i, (s, c, m) in enumerate(mine)}
    assert got == want


def test_caps_remove_common_tokens(spark):
    df = spark.createDataFrame([("x", "wabc", 401), ("x", "wabd", 400), ("x", "nabc", 8000), ("x", "nabd", 8001)], "country string, token string, df long")
    sizes = spark.createDataFrame([("x", 10000)], "country string, n long")
    kept = {r.token for r in blocking.idf(df, sizes, config.NAME_CHANNEL).collect()}
    assert kept == {"wabd", "nabc"}


def test_corroboration_leaves_the_row_out(spark):
    rows = [("q", "a", 2, 0.9, "x"), ("q", "b", 3, 0.7, "x"), ("q", "c", 3, 0.5, "x"), ("q", "d", 2, 0.4, ""), ("r", "a", 2, 0.3, "x")]
    df = spark.createDataFrame(rows, "q_id string, c_id string, src int, p double, key string")
    got = {(r.q_id, r.c_id): (r.corr_k_count, r.corr_k_best_other_p) for r in graph.corroboration(df, {"k": "key"}).collect()}
    assert got == {("q", "a"): (2, 0.7), ("q", "b"): (2, 0.9), ("q", "c"): (2, 0.9), ("q", "d"): (0, 0.0), ("r", "a"): (0, 0.0)}
    other = {(r.q_id, r.c_id): (r.other_source_best_p, r.other_source_count) for r in graph.other_source(df).collect()}
    assert other["q", "a"] == (0.7, 2) and other["q", "b"] == (0.9, 2) and other["r", "a"] == (0.0, 0)


def test_graph_features_are_complete_and_finite(spark):
    rows = [("q1", "a", 2, 1.0, "x"), ("q2", "a", 2, 0.0, "x"), ("q1", "b", 3, 0.5, "")]
    df = spark.createDataFrame(rows, "q_id string, c_id string, src int, p double, k string")
    whole = graph.graph_features(df, {"postal": "k", "digit": "k", "skel": "k"})
    assert len(whole.columns) == 2 + 24
    by = {(r.q_id, r.c_id): r for r in whole.collect()}
    assert by["q1", "b"].compete_margin == 30.0 and by["q1", "a"].compete_is_best == 1 and by["q2", "a"].compete_margin < 0


def test_auc_and_ap_with_ties(spark):
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0), (0.1, 1), (0.1, 0)]
    df = spark.createDataFrame(rows, "p double, label int")
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(df).first()["auc"] == pytest.approx(want, abs=1e-6)
    ap, tp, k = 0.0, 0, 0
    for v in sorted({p for p, _ in rows}, reverse=True):
        hit = sum(y for p, y in rows if p == v)
        tp, k = tp + hit, k + sum(p == v for p, _ in rows)
        ap += hit * tp / k / len(pos)
    assert evaluate.average_precision(df).first()["ap"] == pytest.approx(ap, abs=1e-6)


def test_one_class_has_no_auc(spark):
    assert evaluate.roc_auc(spark.createDataFrame([(0.5, 1)], "p double, label int")).first()["auc"] is None


def test_verdicts(spark):
    rows = [("a", 0, 0, 0), ("b", 0, 1, 0), ("c", 2, 0, 0), ("d", 2, 1, 0), ("e", 2, 2, 2), ("f", 2, 1, 1)]
    df = spark.createDataFrame([(q, "x", t, k, tp) for q, t, k, tp in rows], "q_id string, country string, t_size int, k int, tp int")
    got = {r.q_id: (r.verdict, round(r.f05, 4)) for r in evaluate.entity_f05(df).collect()}
    assert got == {"a": ("singleton_ok", 1.0), "b": ("false_merge_on_singleton", 0.0), "c": ("missed_all", 0.0), "d": ("false_merge_on_matched", 0.0), "e": ("exact", 1.0), "f": ("partial", round(1.25 / (0.5 + 1), 4))}


def test_fuzzy_definitions():
    assert fuzzy.ratio("abcd", "abxd") == pytest.approx(0.75)
    assert fuzzy.token_sort("b a", "a b") == 1.0 and fuzzy.token_set("a b c", "a b") == 1.0
    assert fuzzy.partial("abc", "xxabcxx") == 1.0 and fuzzy.ratio("", "a") == 0.0
    assert fuzzy.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert fuzzy.alignment(["abcd", "xy"], ["abcd"]) == (1.0, 0.0)


def test_isotonic_knots_interpolate(spark):
    df = spark.createDataFrame([(float(i) / 10, float(y)) for i, y in enumerate([0, 0, 1, 0, 1, 1, 1, 0, 1, 1])], "p double, label double")
    knots = model.isotonic_knots(df, "p", "label")
    assert all(a <= b for a, b in zip(knots[1], knots[1][1:], strict=False))
    low, high = spark.range(1).select(model.interpolate(F.lit(-1.0), knots), model.interpolate(F.lit(2.0), knots)).first()
    assert (low, high) == (knots[1][0], knots[1][-1])


def test_aliases(spark):
    pairs = spark.createDataFrame([(f"q{i}", f"c{i}", ["texas"], ["tx"]) for i in range(20)], "q_id string, c_id string, xs array<string>, ys array<string>")
    found = alias.alias_pairs(pairs)
    assert [(r.a, r.b, r.n, r.score) for r in found.collect()] == [("texas", "tx", 20, 1.0)]
    spark.sparkContext.setCheckpointDir("/tmp/checkpoints")
    freq = spark.createDataFrame([("texas", 5), ("tx", 9)], "token string, freq long")
    assert [(r.token, r.canonical) for r in alias.alias_map(found, freq).collect()] == [("texas", "tx")]


def test_sources_tolerate_bad_bytes_and_rows(spark, tmp_path):
    file = tmp_path / "s.tsv"
    file.write_bytes(b"entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-00001\tAc\xccme\t1 Main St\tUS\r\nS1-2\tshort\nS1-x\ta\tb\tc\nS1-3\t\t\tUS\textra\n")
    got = {r.id: (r.num, r.business_name, r.country) for r in io.read_records(spark, str(file), 1).collect()}
    assert got == {"S1-00001": (1, "Ac�me", "US"), "S1-3": (3, "", "US")}
    assert io.malformed(spark, str(file)).first().asDict() == {"rows": 4, "malformed": 2}


def test_submission_round_trip(spark, tmp_path):
    required = spark.createDataFrame([("S1-1",), ("S1-2",)], "q_id string")
    predicted = spark.createDataFrame([("S1-1", "S2-5"), ("S1-1", "S2-5"), ("S1-1", "S9-1")], "q_id string, c_id string")
    io.write_submission(io.submission_rows(required, predicted), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert text == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-5\nS1-2\t\n"
    lists = io.read_id_lists(spark, str(tmp_path / "out"))
    assert {r.q_id: (r.ids, r.has_tab) for r in lists.collect()} == {"S1-1": (["S2-5"], True), "S1-2": ([], True)}
    report = io.validate_lists(required, lists, spark.createDataFrame([("S2-5",)], "id string")).first().asDict()
    assert not any(v for k, v in report.items() if k != "empty_lists")


def test_store_guards(spark, tmp_path, sf_dir):
    store = adapter.store(spark, sf_dir)
    io.write_store(store, str(tmp_path / "store"))
    assert io.read_store(spark, str(tmp_path / "store"), country="de").count() == store.where("country = 'de'").count()
    with pytest.raises(Exception):
        io.write_store(store, str(tmp_path / "store"))
    with pytest.raises(ValueError, match="0 rows"):
        io.write_store(store.limit(0), str(tmp_path / "none"), exist_ok=True)


def test_dataset_discovery(tmp_path):
    (tmp_path / "__MACOSX").mkdir()
    (tmp_path / "real").mkdir()
    for place, size in (("__MACOSX/a.tsv", 5000), ("real/._a.tsv", 5000), ("a.tsv", 100), ("real/a.tsv", 3000)):
        (tmp_path / place).write_bytes(b"x" * size)
    assert io.find_dataset(str(tmp_path), ["a.tsv", "b.tsv"]) == {"a.tsv": str(tmp_path / "real/a.tsv")}


def test_labels_and_truth(spark):
    links = spark.createDataFrame([("q", "c"), ("q", "c"), ("q", "d")], "q_id string, c_id string")
    cands = spark.createDataFrame([("q", "c"), ("q", "e")], "q_id string, c_id string")
    assert {(r.c_id, r.label) for r in labels.with_labels(cands, links).collect()} == {("c", 1), ("e", 0)}
    sizes = labels.truth_sizes(spark.createDataFrame([("q", "x"), ("r", "x")], "q_id string, country string"), links)
    assert {(r.q_id, r.t_size) for r in sizes.collect()} == {("q", 2), ("r", 0)}


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    from tessera.streaming import normalise

    records = adapter.records(spark, sf_dir).drop("text")
    records.write.parquet(str(tmp_path / "in"))
    stream = normalise.normalised(normalise.read_records(spark, str(tmp_path / "in")))
    normalise.write(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {(r.id, r.name_skel, r.addr_skel) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r.id, r.name_skel, r.addr_skel) for r in adapter.store(spark, sf_dir).collect()}
    assert got == want


def test_service(spark, sf_dir):
    from tessera.plans import catalog
    from tessera.service import Engine

    scored = catalog._pairs(spark, sf_dir)
    engine = Engine(spark, scored, catalog._sizes(spark, sf_dir), adapter.store(spark, sf_dir))
    assert engine.normalise("Acme Ltd", "1 Main St").first()["core"] == ["acme"]
    macro = engine.simulate(config.Decision(rule="global_threshold"))["macro"].first()
    assert macro["entities"] == catalog._sizes(spark, sf_dir).count()
    q = scored.first()["q_id"]
    assert engine.ev_curve(q).count() == engine.entity(q).count() + 1
    assert engine.entities(sort="k_star", size=5).count() == 5


def test_long_alias_chain_is_one_group(spark):
    spark.sparkContext.setCheckpointDir("/tmp/checkpoints")
    names = [f"t{(i * 7919) % 1000:04d}" for i in range(200)]
    pairs = spark.createDataFrame(list(zip(names, names[1:])), "a string, b string")
    freq = spark.createDataFrame([(names[57], 9)], "token string, freq bigint")
    got = {r.token: r.canonical for r in alias.alias_map(pairs, freq).collect()}
    assert got == {n: names[57] for n in names if n != names[57]}
    with pytest.raises(RuntimeError):
        alias.alias_map(pairs, freq, rounds=2)


@pytest.mark.parametrize(
    ("x", "y", "wanted"),
    [("tx", "texas", True), ("t", "texas", False), ("12", "123", False), ("12", "a12b", False), ("a1", "ab12", True), ("mysore", "mysuru", True), ("ab", "ba", False), ("st", "saint", True), ("a.c", "abc", True), ("no", "north", True), ("(a", "abc", False), ("abc", "xbc", False)],
)
def test_plausible(spark, x, y, wanted):
    df = spark.createDataFrame([(x, y), (y, x)], "x string, y string")
    assert [r[0] for r in df.select(alias.plausible(df["x"], df["y"])).collect()] == [wanted, wanted]


def test_matches_outside_candidates(spark):
    lists = lambda rows: spark.createDataFrame(rows, "q_id string, ids array<string>")
    found = io.matches_outside_candidates(lists([("S1-1", ["S2-1", "S3-9"]), ("S1-2", ["S2-2"]), ("S1-3", [])]), lists([("S1-1", ["S2-1"]), ("S1-2", ["S2-2", "S2-3"])]))
    assert [tuple(r) for r in found.collect()] == [("S1-1", ["S3-9"])]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.concat(F.lit("S1-"), "id").alias("q_id"), (F.col("id") % 2).alias("country"))
    one, two = (sorted(r.q_id for r in io.sample_entities(x, 20, "country").collect()) for x in (df, df.repartition(9)))
    assert one == two and len(one) == 40
    assert io.sample_entities(df, 7).count() == 7 and io.sample_entities(df, 7, seed=8).exceptAll(io.sample_entities(df, 7)).count() > 0


def test_bundle_ensemble_and_counts(spark, tmp_path):
    rows = [(i, float(i % 10), float(i % 3), int(i % 10 > 4)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, x double, z double, label int")
    fitted = model.fit(df, ["x", "z"], "logistic")
    model.save_bundle(fitted, str(tmp_path / "b"), ["x", "z"], auc=0.5)
    again, names, meta = model.load_bundle(str(tmp_path / "b"))
    assert names == ["x", "z"] and meta == {"auc": 0.5}
    first, second = ([r.p1 for r in model.score(m, df).orderBy("id").collect()] for m in (fitted, again))
    assert first == second and model.n_parameters(again) == 3
    mixed = model.ensemble(df, df, ["x", "z"], ("logistic", "forest")).collect()
    assert min(r.p1 for r in mixed if r.label) > max(r.p1 for r in mixed if not r.label) and all(0 <= r.p1 <= 1 for r in mixed)
    assert sum(v for _, v in model.importances(model.fit(df, ["x", "z"], "forest"), ["x", "z"])) == pytest.approx(1)
    df.write.parquet(str(tmp_path / "t"))
    assert io.count_rows(spark, str(tmp_path / "t")) == 300
    (tmp_path / "f.txt").write_text("\n".join(map(str, range(40))))
    assert io.head(spark, str(tmp_path / "f.txt")) == [str(i) for i in range(11)]
