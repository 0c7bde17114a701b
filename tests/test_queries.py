"""Every registered query against its SQL twin, on the smallest folder."""

import datetime as dt
import math
import os

import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    """A value that compares and sorts alike from both engines."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, (int, float)):
        return f"n{float(value) + 0.0}"
    if isinstance(value, dt.datetime):
        return f"t{value.replace(tzinfo=None).isoformat()}"
    return f"{type(value).__name__}{value}"


@pytest.mark.parametrize("name", sorted(entry.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = entry.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    result = duck.execute(entry.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    assert got


def test_every_query_has_a_twin():
    assert set(entry.ORACLES) == set(entry.QUERIES)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "score" in df.columns
