"""Integer buckets from the last two digits of an id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_partition_int(
    df: DataFrame, id_col: str = "survey_id", width: int = 5, tolerant: bool = False
) -> DataFrame:
    """Add `partition_int`. A suffix that is no number is an error, or null if tolerant."""
    suffix = F.right(F.col(id_col), F.lit(2))
    number = suffix.try_cast("bigint") if tolerant else suffix.cast("bigint")
    return df.withColumn("partition_int", F.floor(number / width).cast("bigint"))


def for_partition(df: DataFrame, part: int) -> DataFrame:
    """One bucket; on a table partitioned by the column, one directory."""
    return df.filter(F.col("partition_int") == part)
