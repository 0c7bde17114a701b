"""Tables with versions: switched as one, whole after failures, two versions at most."""

import os

import pytest
from pyspark.sql import functions as F

from surveyloom.sources import tables as io
from surveyloom.sources import versions

SCHEMA = "k string, v int"


def rows(spark, path):
    return sorted(tuple(r) for r in io.read_table(spark, path).collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    io.ensure_table(spark, path, spark.createDataFrame([], SCHEMA).schema, versioned=True)
    return path


def failing(df):
    """The frame, one row of which fails when it is written."""
    return df.withColumn("v", F.when(F.col("k") == "bad", F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("v")))


def test_writers_follow_the_pointer(spark, table):
    assert io.table_exists(spark, table) and rows(spark, table) == []
    make = lambda *pairs: spark.createDataFrame(list(pairs), SCHEMA)
    io.upsert_table(spark, table, make(("a", 1), ("b", 1)), ["k"])
    io.append_table(make(("c", 1)), table)
    io.upsert_table(spark, table, make(("a", 2), ("d", 2)), ["k"])
    assert rows(spark, table) == [("a", 2), ("b", 1), ("c", 1), ("d", 2)]
    io.rewrite_table(io.read_table(spark, table).filter("v = 2"), table)
    assert rows(spark, table) == [("a", 2), ("d", 2)]
    io.ensure_table(spark, table, spark.createDataFrame([], SCHEMA).schema, versioned=True)
    assert rows(spark, table) == [("a", 2), ("d", 2)]
    io.write_partitioned(make(("a", 1), ("b", 2)), table, "k")
    assert sorted((r.k, r.v) for r in io.read_table(spark, table).collect()) == [("a", 1), ("b", 2)]
    io.write_clustered(make(("z", 9)), table, "k")
    assert rows(spark, table) == [("z", 9)]
    assert io.Sources(spark, {"t": table}).read("t").first().k == "z"


def test_two_versions_at_most_and_old_readers_go_on(spark, table):
    for i in range(4):
        held = io.read_table(spark, table)
        n = held.count()
        io.append_table(spark.createDataFrame([("x", i)], SCHEMA), table)
        held = io.read_table(spark, table)
        io.rewrite_table(held.withColumn("v", F.col("v") + 100), table)
        assert held.count() == n + 1
        assert len(os.listdir(f"{table}/_versions")) == 2
    assert not [f for f in os.listdir(table) if f.startswith("_current-")]


def test_a_failed_write_leaves_the_table(spark, table):
    io.replace_table(spark.createDataFrame([("a", 1)], SCHEMA), table)
    name = versions.pointed(spark, table)
    bad = failing(spark.createDataFrame([("good", 1), ("bad", 2)], SCHEMA).repartition(2))
    for write in (lambda: io.replace_table(bad, table), lambda: io.rewrite_table(io.read_table(spark, table).unionByName(bad), table)):
        with pytest.raises(Exception, match="broken"):
            write()
        assert versions.pointed(spark, table) == name and rows(spark, table) == [("a", 1)]
    io.replace_table(spark.createDataFrame([("b", 1)], SCHEMA), table)
    assert rows(spark, table) == [("b", 1)] and len(os.listdir(f"{table}/_versions")) == 2


def test_a_failure_between_write_and_switch(spark, table, monkeypatch):
    io.replace_table(spark.createDataFrame([("a", 1)], SCHEMA), table)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "_move_pointer", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            io.replace_table(spark.createDataFrame([("b", 1)], SCHEMA), table)
    assert rows(spark, table) == [("a", 1)]


def test_a_second_writer_is_noticed(spark, table):
    df = spark.createDataFrame([("late", 1)], SCHEMA)

    def slow(folder):
        io.replace_table(spark.createDataFrame([("first", 1)], SCHEMA), table)
        df.write.parquet(folder)

    with pytest.raises(RuntimeError, match="another writer"):
        versions.switch(spark, table, slow)
    assert rows(spark, table) == [("first", 1)]


def test_plain_tables_stay_plain(spark, tmp_path):
    path = str(tmp_path / "plain")
    io.replace_table(spark.createDataFrame([("a", 1)], SCHEMA), path)
    io.rewrite_table(spark.read.parquet(path).withColumn("v", F.lit(2)), path)
    assert versions.pointed(spark, path) is None and spark.read.parquet(path).first().v == 2
