"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, decontaminate, exact_dedup, language, line_dedup, quality, sharding, simhash, suffix_dedup, token_blocks
from tessera.llm.common import work_path

P = pytest.importorskip("public_tokenizers")
RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, th bigint, fp string, key string, tx string, dx int, sx int, rx int, bucket int, label_x int, shard_file string"
LONG = "word%d " * 40000 % tuple(range(40000))


def rows():
    texts = [
        (1, "The quick brown fox. Jumps over\nthe lazy dog", "en"),
        (2, None, "en"),
        (3, "", None),
        (4, LONG, "en"),
        (5, "The quick brown fox. Jumps over\nthe lazy dog", None),
        (5, "The quick brown fox. Jumps over\nthe lazy dog", "en"),
        (5, "other text 123 \x00 \t\r\n ", "de"),
        (None, "no id here", "en"),
        (None, None, None),
        (6, "😀 é ́ 日本語", "ja"),
    ]
    return [(i, t, lang, None, None if t is None else len(t), 1, "x", "y", "z", 1, 1, 1, 1, 1, "f") for i, t, lang in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(7, "Quick, BROWN fox"), (7, "Quick, BROWN fox"), (8, None), (9, ""), (None, "lazy dog"), (10, "dog")], "item_id bigint, text string")


def language_rows(d):
    return language.predict(d, language.fit(d))


def quality_rows(d):
    labels = d.sparkSession.createDataFrame([(1, 1), (4, 0), (5, 1), (5, 1), (99, 1), (None, 1), (6, None)], "doc_id bigint, quality int")
    return quality.score(d, quality.fit(d, labels))


OPERATORS = {
    "op1": lambda d, b: decontaminate.digests(decontaminate.matches(d, b)),
    "op2": lambda d, b: byte_bpe.digests(d, RANKS, P.PATTERN),
    "op3": lambda d, b: token_blocks.read_files(token_blocks.write_files(d, WORDS)),
    "op4": lambda d, b: quality_rows(d),
    "op5": lambda d, b: suffix_dedup.repeats(d),
    "op7": lambda d, b: line_dedup.decisions(d),
    "op8": lambda d, b: simhash.near_copies(d),
    "op9": lambda d, b: language_rows(d),
    "op10": lambda d, b: exact_dedup.decisions(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_a_document(docs, benchmark, name):
    got = [r.doc_id for r in OPERATORS[name](docs, benchmark).collect()]
    key = lambda x: (x is not None, x or 0)
    assert sorted(got, key=key) == sorted((r[0] for r in rows()), key=key)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, benchmark, name):
    assert OPERATORS[name](docs.limit(0), benchmark).collect() == []


def test_empty_benchmark(docs, benchmark):
    assert not any(r.contaminated for r in decontaminate.digests(decontaminate.matches(docs, benchmark.limit(0))).collect())


def test_filters_keep_all_columns(docs, benchmark):
    model = language.fit(docs)
    for kept in (language.drop_unknown(docs, model), exact_dedup.drop_copies(docs), simhash.drop_near_copies(docs), decontaminate.drop_contaminated(docs, benchmark)):
        assert kept.columns == docs.columns and kept.schema.simpleString() == docs.schema.simpleString()
        kept.collect()


def test_drop_copies_keeps_one_of_each_text(docs):
    kept = [(r.doc_id, r.text) for r in exact_dedup.drop_copies(docs).collect()]
    # Null counts as empty: of ids 2, 3 and null the largest stays.
    assert len(kept) == len({t or "" for _, t in kept}) == 6
    assert (5, rows()[0][1]) in kept and (3, "") in kept


def test_encode_keeps_columns(docs):
    out = byte_bpe.encode(docs, RANKS, P.PATTERN, checked=True)
    assert out.columns[: len(docs.columns)] == docs.columns
    back = byte_bpe.decode(out.select("doc_id", "text", "token_ids"), RANKS, P.PATTERN)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())


def test_store_takes_any_rows(spark, docs):
    store = sharding.ShardStore(spark, work_path(spark, "edge"), target_bytes=1 << 20)
    store.append(docs.limit(0))
    store.append(docs, rows=2)
    store.compact()
    kept = store.read()
    assert store.manifest()["version"] >= 2
    assert sum(s["rows"] for s in store.manifest()["shards"]) == len(rows())
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    if "shard_file" in docs.columns:
        with pytest.raises(ValueError):
            store.read(file_col="shard_file")


def test_vacuum_leaves_an_append_that_is_under_way(spark):
    store = sharding.ShardStore(spark, work_path(spark, "race"))
    df = spark.range(20).withColumn("shard_file", F.lit("own"))
    store.append(df.where("id < 10"))
    commit = store.commit

    def vacuum_first(*args):
        sharding.ShardStore(spark, store.root).vacuum()
        return commit(*args)

    store.commit = vacuum_first
    store.append(df.where("id >= 10"))
    store.compact()
    assert sorted(r.id for r in store.read().collect()) == list(range(20))
    assert {r.shard_file for r in store.read().collect()} == {"own"}
    other = sharding.ShardStore(spark, store.root)
    with pytest.raises(sharding.Conflict):
        other.commit(store.version() - 1, None, [])
    # A writer that failed takes its intent back, so its files go.
    store.commit = lambda *args: (_ for _ in ()).throw(RuntimeError())
    with pytest.raises(RuntimeError):
        store.append(df)
    assert store.vacuum() > 0 and store.read().count() == 20


def test_query_of_shards_does_not_shuffle_texts(spark, sf_dir):
    from tessera.llm import catalog

    df = catalog.op6_sharding(spark, sf_dir)
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString() and "BuildRight" in df._jdf.queryExecution().executedPlan().toString()
    shards = {}
    for r in df.collect():
        shards.setdefault(r.shard, []).append(r)
    for own in shards.values():
        assert len(own) == own[0].shard_rows and len({(r.shard_rows, r.shard_bytes, r.merged_from) for r in own}) == 1


def test_lines_of_edge_texts(docs):
    got = {(r.doc_id, r.n_lines, tuple(r.dropped)) for r in line_dedup.decisions(docs).collect()}
    assert (2, 1, ()) in got and (3, 1, ()) in got
    assert (1, 2, ()) in got and (5, 2, (0, 1)) in got


def test_suffix_long_text_in_pieces(spark):
    from tessera.llm import suffix_core

    text = "".join(chr(97 + x) for x in np.random.default_rng(3).integers(0, 26, 5000))
    old = suffix_core.CHUNK
    try:
        suffix_core.CHUNK = 700
        df = spark.createDataFrame([(1, text + text[1000:1500]), (2, text[100:400])], "doc_id bigint, text string")
        got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeats(df).collect()}
    finally:
        suffix_core.CHUNK = old
    assert got == {1: (500, 1, hashlib.sha256(text.encode()).hexdigest()), 2: (300, 1, hashlib.sha256(b"").hexdigest())}


def test_exact_dedup_survives_digest_collisions(spark):
    rows_ = [(i, "abcdef"[i % 6] * (1 + i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows_, "doc_id bigint, text string").repartition(4)
    weak = exact_dedup.decisions(df, digest=lambda t: F.left(F.sha2(t, 256), F.lit(1)))
    true = exact_dedup.decisions(df)
    assert sorted(map(tuple, weak.collect())) == sorted(map(tuple, true.collect()))


def test_lines_of_repeated_rows_and_clashing_names(spark):
    line = " ".join(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(60))
    rows = [(1, line, "a")] * 4 + [(1, line + "\n" + line, "b"), (None, line, "c"), (None, line, "c"), (2, None, "d"), (3, "", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, gone_lines string").withColumns({c: F.lit(c) for c in ("gone_id", "gone_th", "id_x", "dropped_x", "th", "norm")})
    got = sorted((r.doc_id or 0, r.n_lines, tuple(r.dropped)) for r in line_dedup.decisions(df).collect())
    assert got == [(0, 1, ()), (0, 1, ()), (1, 1, (0,)), (1, 1, (0,)), (1, 1, (0,)), (1, 1, (0,)), (1, 2, (0, 1)), (2, 1, ()), (3, 1, ())]
    kept = line_dedup.drop_lines(df)
    assert kept.columns == df.columns
    assert sorted((r.gone_lines or "", r.text) for r in kept.collect()) == [("", ""), ("a", ""), ("a", ""), ("a", ""), ("a", ""), ("b", ""), ("c", line), ("c", line), ("d", None)]
