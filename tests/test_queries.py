"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest
from conftest import SF_DIR

from wardgrid.workloads import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables to read")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{SF_DIR}/{name}.parquet"):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.sql(ORACLES[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    expected_types = dict(zip(theirs.columns, map(str, theirs.types), strict=True))
    assert {c: TYPES[t] for c, t in ours.dtypes} == expected_types

    def ordered(rows):
        return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])

    got = ordered(tuple(row[c] for c in columns) for row in ours.collect())
    wanted = ordered(theirs.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert len(got) > 0
    assert got == wanted
