"""Ranks inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffle_order(id_col: str, seed: str) -> Column:
    """A reproducible random order: the hex digest of id and seed."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(seed)))


def ranked(
    df: DataFrame,
    group: Sequence[str],
    id_col: str,
    seed: str = "",
    rank: str = "rank",
    digits: int = 3,
) -> DataFrame:
    """Number the rows of each group 1, 2, .. in `shuffle_order`.

    A group is first cut by the leading hex digits of the order (16 ** digits pieces), so
    no task has to hold a whole group. Pieces are numbered on their own and shifted by the
    number of rows in the pieces before, which is a sum over at most 16 ** digits counts.
    """
    cut = df.withColumn("_order", shuffle_order(id_col, seed)).withColumn(
        "_piece", F.substring("_order", 1, digits)
    )
    before = Window.partitionBy(*[f"_g{i}" for i in range(len(group))]).orderBy("_p").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = (
        cut.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_piece").alias("_p"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*group, "_piece").orderBy("_order", id_col)
    numbered = cut.withColumn("_row", F.row_number().over(inside))
    same = [numbered[g].eqNullSafe(sizes[f"_g{i}"]) for i, g in enumerate(group)]
    same.append(numbered["_piece"] == sizes["_p"])
    joined = numbered.join(sizes, reduce(lambda a, b: a & b, same))
    return joined.select(*df.columns, (F.col("_row") + F.col("_shift")).alias(rank))
