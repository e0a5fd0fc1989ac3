"""Every registered query against its SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from logstow.plans.queries import QUERIES

DATA = os.environ.get("LOGSTOW_TEST_DATA", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sql, name):
    df = entry.queries()[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    cursor = sql.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    want = cursor.fetchall()
    assert got, "no rows"
    assert sorted_rows(df.columns, got) == sorted_rows(columns, want)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.object_key.startswith(f"archive/{row.topic}/3_")
