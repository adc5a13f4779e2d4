"""The pipeline's near-duplicate stage against brute force on Jaccard similarity."""

import random

import pytest

from tessera.llm import simhash_near


def expected(docs):
    """Ids that stay, by comparing every pair."""
    own = [simhash_near.distinct_shingles((t or "").encode()) for _, t in docs]
    root = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if root[a] != root[b] and 10 * len(own[a] & own[b]) >= 8 * len(own[a] | own[b]):
                x, y = root[a], root[b]
                root = [y if r == x else r for r in root]
    least = {}
    for (i, _), r in zip(docs, root, strict=True):
        least[r] = min(least.get(r, i), i)
    return sorted(i for (i, _), r in zip(docs, root, strict=True) if i == least[r])


def changed(rng, text, n):
    words = text.split()
    for i in rng.sample(range(len(words)), min(n, len(words))):
        words[i] = rng.choice(["other", "words", "instead"]) + str(rng.randrange(1000))
    return " ".join(words)


@pytest.mark.parametrize(("seed", "frequent"), [(5, 2), (6, 10**9)])
def test_near_copies_equal_brute_force(spark, monkeypatch, seed, frequent):
    import corpus_pipeline

    monkeypatch.setattr(simhash_near, "FREQUENT", frequent)
    rng = random.Random(seed)
    common = " ".join(f"c{i}" for i in range(30))
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.choice([1, 4, 6, 12, 40, 150, 300]))) for _ in range(30)]
    texts = [None, "", " \t", "one", "ONE  "]
    for text in base:
        texts.append(text)
        # From well above to well below the bound, and some longer by a line that many share.
        for _ in range(rng.randrange(1, 6)):
            copy = changed(rng, text, rng.randrange(1 + len(text.split()) // 25))
            texts.append(rng.choice([copy, copy.upper(), copy + " " + common, common + "\n" + copy]))
    # One large group, whose sizes differ.
    hub = " ".join(f"h{i}" for i in range(200))
    texts += [changed(rng, hub, 2) + " tail" * rng.randrange(3) for _ in range(40)]
    ids = rng.sample(range(10_000), len(texts))
    docs = list(zip(ids, texts, strict=True))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, df, "").collect())
    want = expected(docs)
    assert got == want and len(want) < len(docs) - 80


def test_three_changed_words_of_300_are_near(spark):
    import corpus_pipeline

    words = [f"w{i}" for i in range(300)]
    other = [*words[:50], "x", *words[51:150], "y", *words[151:250], "z", *words[251:]]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other)), (None, "a b c"), (None, "a b c"), (3, "a b c")], "doc_id bigint, text string")
    assert sorted((r.doc_id for r in corpus_pipeline.near_copies(spark, df, "").collect()), key=str) == [1, 3, None, None]
    assert corpus_pipeline.near_copies(spark, df.limit(0), "").count() == 0


def test_possible_never_rules_out_a_similar_pair():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 300))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        b = a.copy()
        change = rng.integers(0, n, int(rng.integers(0, n // 8 + 1)))
        b[change] = rng.integers(0, 1 << 63, len(change), dtype=np.uint64)
        b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, int(rng.integers(0, n // 8 + 1)), dtype=np.uint64)]))
        a = np.unique(a)
        known = np.sort(rng.choice(a, n // 2).view(np.int64))
        counts = rng.integers(5, 50, len(known))
        sets = [set(x.tolist()) for x in (a, b)]
        similar = len(sets[0] & sets[1]) >= 0.8 * len(sets[0] | sets[1])
        prefixes = [simhash_near.first_shingles(x, known, counts, 0.8) for x in (a, b)]
        heads = np.full((2, simhash_near.HEAD), np.iinfo(np.int64).max)
        for row, own in zip(heads, prefixes):
            row[: min(len(own), simhash_near.HEAD)] = own[: simhash_near.HEAD]
        fits = simhash_near.possible(*simhash_near.ranked(heads), np.array([len(a), len(b)]), np.array([0]), np.array([1]), 0.8)[0]
        assert fits or not similar
        assert not similar or set(prefixes[0].tolist()) & set(prefixes[1].tolist())


def test_rows_grow_with_texts_and_not_with_pairs(spark, monkeypatch):
    """Texts that share most words, no two similar enough, but for some: the pairs are compared and none is a row."""
    rows = {}
    write = simhash_near.written

    def counted(df, name, *args, **how):
        out = write(df, name, *args, **how)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(simhash_near, "written", counted)
    passage = " ".join(f"p{i}" for i in range(27))
    texts = [f"{passage} x{i} y{i} z{i}" for i in range(200)] + [f"{passage} x{i} y{i} other" for i in range(0, 200, 50)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = sorted(r.doc_id for r in simhash_near.drop_near_copies(df).collect())
    assert got == expected(list(enumerate(texts))) == list(range(200))
    assert rows["near-apart"] <= len(texts)


def test_links_of_the_last_turn_alone(spark, monkeypatch):
    """Without turns of leaders the last passes find every group that the leaders left apart."""
    monkeypatch.setattr(simhash_near, "LEADERS", 0)
    rng = random.Random(9)
    hub = " ".join(f"h{i}" for i in range(150))
    texts = [changed(rng, hub, rng.randrange(1, 5)) for _ in range(80)] + [changed(rng, " ".join(f"s{i}" for i in range(40)), 1) for _ in range(40)]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    assert sorted(r.doc_id for r in simhash_near.drop_near_copies(df).collect()) == expected(docs)


def test_bounds_never_rule_out_a_similar_pair_and_a_pair_is_met_once():
    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        b = np.unique(np.concatenate([a[int(rng.integers(0, n // 6 + 1)) :], rng.integers(0, 1 << 63, int(rng.integers(0, n // 6 + 1)), dtype=np.uint64)]))
        a = np.unique(a)
        similar = len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
        bits = np.frombuffer(simhash_near.parity(a) + simhash_near.parity(b), np.uint64).reshape(2, -1)
        one, two = np.array([0]), np.array([1])
        assert simhash_near.few_differ(bits, np.array([len(a), len(b)]), one, two, 0.8)[0] or not similar
        heads = np.full((2, simhash_near.HEAD), np.iinfo(np.int64).max)
        prefixes = [simhash_near.first_shingles(x, np.zeros(0, np.int64), np.zeros(0, np.int64), 0.8)[: simhash_near.HEAD] for x in (a, b)]
        for row, own in zip(heads, prefixes):
            row[: len(own)] = own
        both = sorted(set(prefixes[0].tolist()) & set(prefixes[1].tolist()))
        met = [simhash_near.first_met(heads, np.array([k, k]), one, two)[0] for k in both]
        assert met == [k == both[0] for k in both]


def test_texts_that_are_not_similar_stay_where_they_are(spark):
    """Texts that share shingles without being near take no room in a shuffle."""
    gateway = spark.sparkContext._gateway
    store, bus = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jsc.sc().listenerBus()

    def written_bytes():
        bus.waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}

    rng = random.Random(8)
    # Passages of three texts, which is not yet frequent.
    passages = [" ".join(f"{rng.getrandbits(400):0100x}" for _ in range(200)) for _ in range(10)]
    texts = [" ".join([passages[i % 10], *(f"{rng.getrandbits(400):0100x}" for _ in range(400))]) for i in range(30)]
    texts.append(texts[0] + " tail")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    df = df.localCheckpoint()
    before = written_bytes()
    links = simhash_near.groups(df)
    assert sorted((r.doc_id, r.component_id) for r in links.collect()) == [(0, 0), (30, 0)]
    moved = sum(n for stage, n in written_bytes().items() if stage not in before)
    assert moved < sum(map(len, texts)) / 2
