"""A third of the rows under one key: the joins that rely on adaptive splitting do split."""

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import similarity
from surveyloom.operators.dimensions import left_join_sparse

# Sizes at which a few hundred thousand rows look large, and no broadcast.
SETTINGS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def small_sizes(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key in SETTINGS:
        spark.conf.unset(key)


def splits(df):
    df.tail(1)
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def hot(column):
    return F.when(F.col("id") % 3 == 0, "hot").otherwise(column.cast("string"))


def test_hot_header(small_sizes):
    spark = small_sizes
    surveys = spark.range(300_000).select(
        hot(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("v"), F.col("id").cast("string").alias("s")
    )
    headers = spark.range(1000).selectExpr("string(id) AS k", "1 AS w").unionByName(spark.sql("SELECT 'hot' AS k, 2 AS w"))
    joined = left_join_sparse(surveys.repartition(8), headers, "k", "s")
    assert splits(joined) and joined.filter("w = 2").count() == 100_000


def test_hot_bucket(small_sizes):
    buckets = small_sizes.range(300_000).select(
        F.col("id").alias("survey_id"),
        F.element_at(F.array(F.lit("c"), F.lit("d")), (F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2) + 1).cast("int")).alias("category"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 16).cast("int").alias("band"),
        hot((F.col("id") / 2).cast("long")).alias("bucket"),
    )
    led = similarity._with_leader(buckets.repartition(8))
    assert splits(led) and led.filter("bucket = 'hot'").count() == 99_999


def test_hot_star_centre(small_sizes):
    """Both steps over a component whose centre a third of the edges share."""
    edges = small_sizes.range(1, 300_001).select(
        F.col("id").alias("node"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") - 1).alias("root")
    )
    large = similarity._large_star(edges.repartition(8))
    assert splits(large)
    small = similarity._small_star(edges.select(F.col("root").alias("node"), (-F.col("node")).alias("root")).repartition(8))
    assert splits(small)
