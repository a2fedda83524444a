import os

import duckdb
import pytest

import __spark_entry__ as entry
from lodestrata.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{FOLDER}/{f}'")
    return c


def plain(rows):
    def one(x):
        return round(x, 6) if isinstance(x, float) else x

    return sorted((tuple(map(one, r)) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_and_sql_agree(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    assert plain(df.select(*columns).collect()) == plain(want.select(*columns).fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLES)
