"""What SQL can say of the operators' results, against DuckDB."""

import duckdb
import pytest

from tessera.llm import companions

from .conftest import DATA


@pytest.mark.parametrize("name", sorted(companions.QUERIES))
def test_same_rows(spark, name):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    rows = companions.QUERIES[name](spark, DATA)
    columns = sorted(rows.columns)
    ours = sorted(repr(tuple(r[c] for c in columns)) for r in rows.collect())
    got = duck.execute(companions.ORACLES[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    assert ours == sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in got.fetchall())
