import os

import duckdb
import pytest

import __spark_entry__ as entry
from fleetledger.queries import ORACLE, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    cursor = duck.execute(ORACLE[name])
    found = [c[0] for c in cursor.description]
    assert sorted(found) == columns
    places = [found.index(c) for c in columns]
    expected = [tuple(row[i] for i in places) for row in cursor.fetchall()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert got


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["celo_address", "date", "routes", "total_seconds", "total_distance"]
    assert df.count() > 0
