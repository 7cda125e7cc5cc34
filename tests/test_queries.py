"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    table = queries()[name](spark, FOLDER)
    columns = sorted(table.columns)
    rows = [tuple(row[c] for c in columns) for row in table.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    relation = duck.sql(sql)
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    assert ordered(rows) == ordered(tuple(row[i] for i in at) for row in relation.fetchall())


def test_registration(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).columns == ["entity_text", "thickness_mm", "relative_price_eur_kg"]
