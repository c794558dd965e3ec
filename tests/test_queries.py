"""Every registered query against its SQL twin on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, TWINS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, repr(float(value) + 0.0))
    if hasattr(value, "isoformat"):
        return (3, value.replace(tzinfo=None).isoformat() if hasattr(value, "hour") else value.isoformat())
    return (4, str(value))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_names():
    assert set(TWINS) <= set(QUERIES)
    assert len(QUERIES) >= 80


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    if name not in TWINS:
        assert got
        return
    cursor = duck.execute(TWINS[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    want = cursor.fetchall()
    assert len(got) == len(want)
    assert table(df.columns, got) == table(columns, want)
