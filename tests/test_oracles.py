"""Every registered query against its SQL statement on DuckDB, whole tables."""

import duckdb
import pytest
from helpers import SMALL, plain

import __spark_entry__ as entry_point
from freightmill.registry import QUERIES
from oracles import ORACLES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 49
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    frame = entry_point.queries()[name](spark, SMALL)
    columns = sorted(frame.columns)
    result = duck.execute(entry_point.oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert kinds == {c: KINDS[t] for c, t in frame.dtypes}
    order = [list(kinds).index(c) for c in columns]
    expected = sorted(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    actual = sorted(tuple(plain(row[c]) for c in columns) for row in frame.collect())
    assert actual == expected
    assert actual


def test_entry_is_the_flagship(spark):
    frame = entry_point.entry(spark)
    assert frame.count() == 8
    assert "actual_otif_pct" in frame.columns
