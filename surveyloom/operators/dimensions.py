"""Joins of facts with dimensions.

A dimension read from a table needs no hint: Spark broadcasts it when its files are below
`spark.sql.autoBroadcastJoinThreshold`, and otherwise sorts and merges, where adaptive
execution splits skewed keys. A dimension that is itself a join is over-estimated, and the
fact would be shuffled for nothing; written as a table first, it has its true size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_KEY = "\u0000"


def with_banner(fact: DataFrame, brands: DataFrame, how: str = "inner") -> DataFrame:
    """Add `banner` by `brand_id`."""
    return fact.join(brands.select("brand_id", "banner"), "brand_id", how)


def with_fiscal_period(fact: DataFrame, calendar: DataFrame, date_col: str = "invitation_date") -> DataFrame:
    """Add the fiscal columns; days outside the calendar drop. Both sides compare as dates."""
    days = calendar.select(
        F.to_date("fiscal_date").alias("fiscal_date"), "fiscal_year", "fiscal_month"
    )
    return fact.join(days, F.to_date(fact[date_col]) == days["fiscal_date"], "inner")


def banner_prep(channels: DataFrame, countries: DataFrame, brand_types: DataFrame) -> DataFrame:
    """Distinct (region, country, organisation, banner, channel, type)."""
    return (
        channels.join(countries, "sales_organization")
        .join(brand_types, "distribution_channel")
        .select(
            "region",
            F.col("country_description").alias("country"),
            "sales_organization",
            F.col("brand").alias("banner"),
            "distribution_channel",
            "type",
        )
        .distinct()
    )


def spread_nulls(key: Column, *spread: Column | str) -> Column:
    """The key as text, with nulls replaced by many values that no real key can equal.

    Null never matches in a join, yet all null rows would go to one task.
    """
    piece = F.pmod(F.xxhash64(*spread), F.lit(4096)).cast("string")
    return F.coalesce(key.cast("string"), F.concat(F.lit(NO_KEY), piece))


def left_join_sparse(left: DataFrame, right: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join on a key that may be null on a large share of the left rows."""
    keyed = left.withColumn("_key", spread_nulls(left[key], spread))
    other = right.withColumnRenamed(key, "_other")
    return keyed.join(other, F.col("_key") == F.col("_other").cast("string"), "left").drop("_key", "_other")


def with_business_type(fact: DataFrame, brand_types: DataFrame) -> DataFrame:
    """Add `business_type` by banner; a banner of several types yields several rows."""
    types = brand_types.select(F.col("brand"), F.col("type").alias("business_type")).distinct()
    return fact.join(types, fact["banner"] == types["brand"], "left").drop("brand")


def with_sales_organization(fact: DataFrame, sites: DataFrame) -> DataFrame:
    """Add `sales_organization` by site number."""
    known = sites.select("site_number", "sales_organization")
    return fact.join(known, fact["source_site"] == known["site_number"], "left").drop("site_number")


def with_global_max(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the maximum of a column over the whole frame to each row.

    A scalar subquery: an aggregate that combines in each task, not a window that would
    gather all rows in one.
    """
    return df.withColumn(name, df.agg(F.max(column)).scalar())
