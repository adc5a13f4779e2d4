"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from tessera.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(data, columns, order):
    at = [columns.index(c) for c in order]
    return sorted(tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else repr(r[i]) for i in at) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = catalog.queries()[name](spark, sf_dir)
    found = duck.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.collect(), df.columns, sorted(names)) == rows(found.fetchall(), names, sorted(names))


@pytest.mark.parametrize("name", ["feat_fuzzy", "design_matrix"])
def test_rows_only_queries_run(spark, sf_dir, name):
    assert catalog.queries()[name](spark, sf_dir).count() > 0
