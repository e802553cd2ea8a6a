"""Every registered query against DuckDB on the smallest tables."""

from __future__ import annotations

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from oracle.queries import ORACLE_SQL  # noqa: E402
from perilframe.registry import QUERIES  # noqa: E402
from perilframe.sources.testdata import BASE_TABLES  # noqa: E402

SPARK_TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "INTEGER": "int", "DOUBLE": "double"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in BASE_TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    rows = frame.collect()
    result = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLE_SQL[name]}").fetchall()}
    assert sorted(names) == sorted(frame.columns)
    assert {c: SPARK_TYPES.get(t, t.lower()) for c, t in types.items()} == dict(frame.dtypes)
    order = sorted(names)

    def text(rows, columns):
        at = [columns.index(c) for c in order]
        return sorted(tuple(str(r[i]) for i in at) for r in rows)

    assert rows, "a query without rows proves nothing"
    assert text(rows, frame.columns) == text(expected, names)
