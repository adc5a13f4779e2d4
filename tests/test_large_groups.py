"""Candidates and labels of large groups: right against joins that make every pair, without shuffling those pairs."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera import config
from tessera.operators import blocking, labels


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    """Small tables are joined as large ones are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


FIELDS = "id string, src int, country string, core array<string>, name_skel string, name_nospace string"


def shuffled(spark, act):
    """Rows that the stages of `act` write to shuffles."""
    gateway = spark.sparkContext._gateway
    store, bus = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jsc.sc().listenerBus()

    def rows():
        bus.waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}

    before = rows()
    act()
    return sum(n for stage, n in rows().items() if stage not in before)


def records(n, words, seed=5):
    random.seed(seed)
    out = []
    for i in range(n):
        core = random.choices(words, k=3) + [random.choice(words) + str(random.randrange(n))]
        out.append((f"S{1 + i % 3}-{i}", 1 + i % 3, random.choice(["x", "x", "y"]), core, "".join(core)[:30], "".join(core)))
    return out


def joined(store, channel):
    """Every product as a row of a join."""
    posts = blocking.channel_postings(store, channel)
    q = posts.where("src = 1").select(F.col("id").alias("q_id"), "country", "token", F.col("w").alias("qw"))
    c = posts.where("src > 1").select(F.col("id").alias("c_id"), "country", "token", F.col("w").alias("cw"))
    scores = q.join(c, ["country", "token"]).groupBy("q_id", "c_id").agg(F.round(F.sum(F.col("qw") * F.col("cw")), 6).alias("score"))
    best = Window.partitionBy("q_id").orderBy(F.col("score").desc(), "c_id")
    return scores.where(F.col("score") >= channel.min_score).withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= channel.top_k).drop("rn")


def as_rows(df):
    return sorted((r.q_id, r.c_id, round(r.score, 6)) for r in df.collect())


@pytest.mark.parametrize("slice_size, block", [(262144, (1024, 65536)), (40, (8, 16))])
def test_cells_equal_the_join(spark, monkeypatch, slice_size, block):
    monkeypatch.setattr(blocking, "SLICE", slice_size)
    monkeypatch.setattr(blocking, "BLOCK", block)
    rows = records(600, [a + b for a in "abcdefgh" for b in "stuvwxyz"])
    # A repeated id in two countries, a country without queries, null and no tokens.
    rows += [("S1-0", 1, "y", ["as", "bt"], "asbt", "asbt"), ("S2-1", 2, "y", ["as", "bt"], "asbt", "asbt"), ("S2-1", 2, "x", ["as"], "as", "as"), ("S2-9001", 2, "z", ["as"], "as", "as"), ("S1-9000", 1, None, ["as"], "as", "as"), ("S1-9003", 1, "x", [], "", "")]
    store = spark.createDataFrame(rows, FIELDS)
    assert as_rows(blocking.channel_candidates(store, config.NAME_CHANNEL)) == as_rows(joined(store, config.NAME_CHANNEL))


def test_products_are_not_shuffled(spark):
    store = spark.createDataFrame([(f"S{1 + i % 3}-{i}", 1 + i % 3, "x", ["same", "word"], "", "") for i in range(1500)], FIELDS)
    found = blocking.channel_candidates(store, config.NAME_CHANNEL)
    # 500 x 1000 pairs have a score.
    assert shuffled(spark, lambda: found.write.format("noop").mode("overwrite").save()) < 100_000
    assert found.count() == 500 * config.NAME_CHANNEL.top_k


def links_of(keys):
    q, c = keys.where("src = 1").select(F.col("id").alias("q_id"), "key"), keys.where("src > 1").select(F.col("id").alias("c_id"), "key")
    return q.join(c, "key").select("q_id", "c_id")


def test_keys_equal_the_links(spark):
    random.seed(2)
    rows = [(f"S{1 + i % 3}-{i}", 1 + i % 3, random.choice([None, "a", "b", "b", f"o{i}"])) for i in range(200)]
    # Repeated ids: the same key again, and pairs with two keys in common.
    rows += [("S1-0", 1, k) for k in "abcb"] + [("S2-1", 2, k) for k in "abb"] + [("S3-2", 3, "c")]
    keys = spark.createDataFrame(rows, "id string, src int, key string")
    links = links_of(keys)
    entities = keys.where("src = 1").select(F.col("id").alias("q_id"), F.lit("x").alias("country")).distinct()
    sizes = {r.q_id: r.t_size for r in labels.key_sizes(entities, keys).collect()}
    assert sizes == {r.q_id: r.t_size for r in labels.truth_sizes(entities, links).collect()}
    assert labels.reuse(labels.linked(keys, queries=False)).collect() == labels.disjointness(links).collect()
    cands = entities.select("q_id").crossJoin(keys.where("src > 1").select(F.col("id").alias("c_id")).distinct())
    got, want = labels.with_key_labels(cands, keys), labels.with_labels(cands, links)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_links_of_a_large_group_are_not_made(spark):
    keys = spark.createDataFrame([(f"S{1 + i % 3}-{i}", 1 + i % 3, "k") for i in range(1500)], "id string, src int, key string")
    entities = keys.where("src = 1").select(F.col("id").alias("q_id"), F.lit("x").alias("country"))
    sizes = labels.key_sizes(entities, keys)
    assert {r.t_size for r in sizes.collect()} == {1000}
    cands = entities.select("q_id", F.lit("S2-1").alias("c_id"))
    both = [sizes, labels.with_key_labels(cands, keys)]
    assert shuffled(spark, lambda: [x.write.format("noop").mode("overwrite").save() for x in both]) < 50_000
