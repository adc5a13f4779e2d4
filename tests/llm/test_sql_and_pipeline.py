"""Queries with SQL against it, and the pipeline against its stages by brute force."""

import duckdb
import pytest

from tessera.llm import byte_bpe, catalog, simhash_near

P = pytest.importorskip("public_tokenizers")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df, found = catalog.queries()[name](spark, sf_dir), con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(found.fetchall())


def test_pipeline(spark, sf_dir):
    import corpus_pipeline
    import tiktoken

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    alive = {i for i, t in docs.items() if any(c.isalpha() for c in t)}
    last = {}
    for i in sorted(alive):
        last[docs[i]] = i
    ids = sorted(last.values())
    own = {i: simhash_near.distinct_shingles(docs[i].encode()) for i in ids}
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if root[b] < root[a] and 10 * len(own[a] & own[b]) >= 8 * len(own[a] | own[b]):
                    root[a], changed = root[b], True
    ids = [i for i in ids if root[i] == i]
    leaks = {r.doc_id for r in catalog.op1_decontaminate(spark, sf_dir).where("contaminated").collect()}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    got = {r.doc_id: list(r.token_ids) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == {i: encoding.encode_ordinary(docs[i]) for i in ids if i not in leaks}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe"]
