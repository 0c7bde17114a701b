import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import merging
from surveyloom.plans import scorecard
from surveyloom.session import shared_folder
from surveyloom.sources import tables as io

SCHEMA = "k string, d date, v string"
DAY = dt.date(2025, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_matches_null_with_null(spark):
    target = spark.createDataFrame([("a", DAY, "old"), (None, None, "old"), ("c", None, "old")], SCHEMA)
    source = spark.createDataFrame([(None, None, "new"), ("c", DAY, "new")], SCHEMA)
    assert rows(merging.upsert(target, source, ["k", "d"])) == sorted(
        [("a", DAY, "old"), (None, None, "new"), ("c", None, "old"), ("c", DAY, "new")], key=str
    )


def test_upsert_is_idempotent_and_no_nested_loop(spark):
    target = spark.createDataFrame([("a", DAY, "old"), (None, None, "old")], SCHEMA)
    source = spark.createDataFrame([(None, None, "new")], SCHEMA)
    once = merging.upsert(target, source, ["k", "d"])
    assert rows(merging.upsert(once, source, ["k", "d"])) == rows(once)
    assert "NestedLoop" not in once._jdf.queryExecution().executedPlan().toString()


def test_two_source_rows_on_one_target_row_fail(spark):
    target = spark.createDataFrame([("a", DAY, "old")], SCHEMA)
    twice = spark.createDataFrame([("a", DAY, "x"), ("a", DAY, "y")], SCHEMA)
    with pytest.raises(Exception, match="several source rows"):
        merging.upsert(target, twice, ["k", "d"]).collect()
    new = spark.createDataFrame([("b", DAY, "x"), ("b", DAY, "y")], SCHEMA)
    assert len(rows(merging.upsert(target, new, ["k", "d"]))) == 3
    latest = merging.upsert(target, twice, ["k", "d"], on_duplicate="latest", order_by="v")
    assert rows(latest) == [("a", DAY, "y")]


def test_a_late_batch_replaces_nothing_newer(spark):
    schema = "k string, ts int, v string"
    target = spark.createDataFrame([("a", 10, "newer"), ("b", 1, "older"), (None, None, "unknown")], schema)
    late = spark.createDataFrame([("a", 5, "late"), ("b", 5, "new"), (None, 1, "known")], schema)
    out = merging.upsert(target, late, ["k"], on_duplicate="latest", order_by="ts")
    assert rows(out) == sorted([("a", 10, "newer"), ("b", 5, "new"), (None, 1, "known")], key=str)


CARD = "fiscal_year string, fiscal_month string, banner string, country string, v string"


def card(spark, *values):
    return spark.createDataFrame(list(values), CARD)


def test_replace_by_key_null_parts(spark):
    target = card(spark, ("2025", "1", "A", None, "old"), ("2025", "1", "B", "X", "old"))
    batch = card(spark, ("2025", "1", "A", None, "new"))
    assert len(rows(scorecard.refresh_scorecard(target, batch))) == 2
    assert len(rows(scorecard.refresh_scorecard(target, batch, parity=True))) == 3


def test_replace_by_text_key_collides(spark):
    target = card(spark, ("2025", "1", "AB", "C", "old"))
    batch = card(spark, ("2025", "1", "A", "BC", "new"))
    assert len(rows(scorecard.refresh_scorecard(target, batch))) == 2
    assert len(rows(scorecard.refresh_scorecard(target, batch, parity=True))) == 1


def test_uncovered_days_are_reported(spark):
    schema = CARD + ", fiscal_date date"
    early, late = dt.date(2024, 12, 30), dt.date(2025, 1, 2)
    target = spark.createDataFrame([("2025", "1", "A", "X", "o", early), ("2025", "1", "A", "X", "o", late)], schema)
    batch = spark.createDataFrame([("2025", "1", "A", "X", "n", late)], schema)
    assert [r.fiscal_date for r in scorecard.uncovered_days(target, batch).collect()] == [early]


def test_replace_periods_touches_only_the_batch(spark, tmp_path):
    path = str(tmp_path / "card")
    keys, period = list(scorecard.KEYS), ["fiscal_year", "fiscal_month"]
    old = card(spark, ("2025", "1", "A", "X", "old"), ("2025", "1", "B", None, "old"), ("2025", "2", "A", "X", "old"))
    new = card(spark, ("2025", "1", "B", None, "new"), ("2025", "3", "A", "X", "new"))
    io.replace_periods(spark, path, old, keys, period)
    before = {p.name for p in (tmp_path / "card" / "fiscal_year=2025" / "fiscal_month=2").iterdir()}
    for _ in range(2):
        io.replace_periods(spark, path, new, keys, period)
    after = {p.name for p in (tmp_path / "card" / "fiscal_year=2025" / "fiscal_month=2").iterdir()}
    table = spark.read.schema(old.schema).parquet(path).select(*old.columns)
    assert before == after
    assert rows(table) == sorted(
        [("2025", "1", "A", "X", "old"), ("2025", "1", "B", None, "new"), ("2025", "2", "A", "X", "old"), ("2025", "3", "A", "X", "new")],
        key=str,
    )


@pytest.mark.parametrize("n", [3, 990, 5000])
def test_any_number_of_periods_is_one_partition_filter(spark, tmp_path, n):
    path = str(tmp_path / "t")
    spark.range(300).selectExpr("if(id % 100 = 7, null, cast(id % 100 AS int)) AS p", "id AS v").coalesce(1).write.partitionBy("p").parquet(path)
    batch = spark.range(n).selectExpr("if(id = 1, null, cast(id AS int)) AS p", "id AS v")
    found = io._in_periods(spark.read.schema("p int, v long").parquet(path), batch, ["p"])
    wanted = {None if i == 1 else i for i in range(n)}
    stored = [None if i % 100 == 7 else i % 100 for i in range(300)]
    assert found.count() == sum(p in wanted for p in stored)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [array_contains(" in plan.replace("Subquery subquery", "").replace("scalar-subquery", "")


def test_a_batch_with_other_columns_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 'a' AS k, 1 AS v, 'kept' AS extra, 2025 AS y").write.partitionBy("y").parquet(path)
    batch = spark.sql("SELECT 'a' AS k, 2 AS v, 2025 AS y")
    with pytest.raises(ValueError, match="extra"):
        io.upsert_periods(spark, path, batch, ["k", "y"], ["y"])
    assert spark.read.parquet(path).first().extra == "kept"


def test_upserts_leave_no_copies(spark, tmp_path):
    path = str(tmp_path / "t")
    shared = lambda: set(os.listdir(shared_folder(spark).removeprefix("file:")))
    before = shared()
    for i in range(3):
        io.upsert_table(spark, path, spark.createDataFrame([("a", i)], "k string, v int"), ["k"])
        io.replace_periods(spark, path + "p", spark.createDataFrame([("a", i)], "k string, v int"), ["k"], ["k"])
    assert shared() == before and spark.read.parquet(path).first().v == 2


def test_tables_on_disk(spark, tmp_path):
    path = str(tmp_path / "t")
    io.ensure_table(spark, path, io.CATEGORIES)
    assert spark.read.parquet(path).schema == io.CATEGORIES and spark.read.parquet(path).count() == 0
    row = spark.createDataFrame([("1", dt.datetime(2025, 1, 1), "c", "Other")], io.CATEGORIES)
    io.append_table(row, path)
    io.append_table(row, path)
    io.ensure_table(spark, path, io.CATEGORIES)
    assert spark.read.parquet(path).count() == 2
    io.upsert_table(spark, path, row.withColumn("comment", F.lit("d")), ["survey_h_hid", "invitation_date"])
    assert [r.comment for r in spark.read.parquet(path).collect()] == ["d"]
    io.upsert_table(spark, str(tmp_path / "fresh"), row, ["survey_h_hid"])
    assert spark.read.parquet(str(tmp_path / "fresh")).count() == 1


@pytest.fixture
def apart(spark):
    """Keep small partitions apart, so that a few rows give several files."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_clustered_files_hold_disjoint_sorted_ranges(spark, tmp_path, apart):
    path = str(tmp_path / "clustered")
    df = spark.range(4000).select((F.col("id") % 40).alias("k"), F.lit("hot").alias("b"), "id")
    io.write_clustered(df, path, "k")
    spans = (
        spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("k").alias("a"), F.max("k").alias("z")).orderBy("a", "z").collect()
    )
    assert len(spans) > 1 and all(x.z <= y.a for x, y in zip(spans, spans[1:]))
    io.write_clustered(df, str(tmp_path / "hot"), "b")
    assert spark.read.parquet(str(tmp_path / "hot")).select(F.input_file_name()).distinct().count() > 1


def test_bucketed_table_prunes(spark, tmp_path):
    path = str(tmp_path / "buckets")
    io.write_partitioned(spark.range(100).select("id", (F.col("id") % 20).alias("partition_int")), path, "partition_int")
    read = spark.read.parquet(path).filter("partition_int = 3")
    assert read.count() == 5
    assert "PartitionFilters: [isnotnull(partition_int" in read._jdf.queryExecution().toString()


def test_scratch_table_drop(spark, tmp_path):
    spark.range(1).write.option("path", str(tmp_path / "s")).saveAsTable("scratch_rows")
    io.drop_scratch(spark, "scratch_rows")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        io.drop_scratch(spark, "scratch_rows")
    io.drop_scratch(spark, "scratch_rows", if_exists=True)


def test_sources(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    spark.range(2).createOrReplaceTempView("two_rows")
    sources = io.Sources(spark, {"a": str(tmp_path / "t"), "b": "table:two_rows", "c": spark.range(1)})
    assert [sources.read(n).count() for n in "abc"] == [3, 2, 1]
    with pytest.raises(KeyError, match="no source named 'd'"):
        sources.read("d")


def test_batch_out_of_the_target_itself(spark):
    target = card(spark, ("2025", "1", "A", None, "old"), ("2025", "1", "B", "X", "old"))
    batch = target.filter("banner = 'A'").withColumn("v", F.lit("new"))
    assert rows(scorecard.refresh_scorecard(target, batch)) == [("2025", "1", "A", None, "new"), ("2025", "1", "B", "X", "old")]
    assert len(rows(merging.upsert(target, batch, ["banner", "country"]))) == 2
