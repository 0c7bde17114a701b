"""Running sums over a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveyloom.llm.chunks import partitions, written


def running(df: DataFrame, order: list[Column], sums: dict[str, str], group: str | None = None, label: str = "running") -> DataFrame:
    """`df` with, for each new name in `sums`, the sum of that column over all rows before, in the order.

    The rows are dealt out by ranges of the order, so that neither a hot group nor the whole table meets in one task; a
    written table keeps the ranges, and the sums before each range come from one row a range. With `group`, sums start
    anew in each of its values (nulls are one value), and the order must begin with it. Rows that tie in the order
    are taken in any, but fixed, order.
    """
    parts = partitions(df.sparkSession)
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    dealt = written(dealt, label)
    keys = ["_part"] + ([group] if group else [])
    totals = dealt.groupBy(*keys).agg(*[F.sum(column).alias(f"_{name}") for name, column in sums.items()])
    before = W.partitionBy(*([group] if group else [F.lit(0)])).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select(*keys, *[F.coalesce(F.sum(f"_{name}").over(before), F.lit(0)).alias(f"_{name}") for name in sums])
    inside = W.partitionBy(*keys).orderBy("_row").rowsBetween(W.unboundedPreceding, -1)
    out = dealt.select("*", *[F.coalesce(F.sum(column).over(inside), F.lit(0)).alias(f"_in_{name}") for name, column in sums.items()])
    same = out["_part"] == bases["_part"]
    if group:
        same &= out[group].eqNullSafe(bases[group])
    joined = out.join(bases, same)
    return joined.select(*[out[name] for name in df.columns], *[(out[f"_in_{name}"] + bases[f"_{name}"]).alias(name) for name in sums])
