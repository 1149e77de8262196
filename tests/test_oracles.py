"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from tessera.plans import queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def norm(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(repr(tuple(norm(r[c]) for c in columns)) for r in df.collect())
    got = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    theirs = sorted(repr(tuple(norm(row[names.index(c)]) for c in columns)) for row in got.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() >= 0


def test_flagship(spark):
    assert queries.flagship(spark, DATA).count() > 0
