"""Every query with SQL gives the rows DuckDB gives on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck(sample_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sample_dir}/{table}.parquet'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
        return repr(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 28


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, sample_dir, name):
    frame = entry.queries()[name](spark, sample_dir)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert normal([tuple(r) for r in frame.collect()], frame.columns) == normal(result.fetchall(), columns)
