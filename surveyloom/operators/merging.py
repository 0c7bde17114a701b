"""Upsert, append and replace-by-key as plans over two frames."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys where null equals null; for semi and anti joins.

    The right keys are renamed first, so both sides may come from one table.
    """
    other = right.select(*[F.col(k).alias(f"_{k}") for k in keys])
    tests = [left[k].eqNullSafe(other[f"_{k}"]) for k in keys]
    return left.join(other, reduce(lambda a, b: a & b, tests), how)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> DataFrame:
    """Rows of `target` without a match in `source`, and all rows of `source`.

    Keys match null with null. Two source rows on one target row are an error, raised
    when the plan runs; unmatched duplicates are all inserted. With
    `on_duplicate="latest"` target and source together are reduced to the row with the
    greatest `order_by` per key, so late and repeated batches change nothing that is newer;
    a null `order_by` is older than any value.
    """
    if on_duplicate == "latest":
        if order_by is None:
            raise ValueError("on_duplicate='latest' needs order_by")
        return latest_per_key(target.unionByName(source), keys, order_by)
    if on_duplicate != "error":
        raise ValueError(f"unknown policy {on_duplicate!r}")
    # Grouped first: a key that fills a large share of the source meets the target once.
    counts = source.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count("*").alias("_n"))
    same = reduce(lambda a, b: a & b, [target[k].eqNullSafe(counts[f"_{k}"]) for k in keys])
    seen = target.join(counts, same, "left")
    failed = F.raise_error(F.lit("upsert: several source rows match one target row"))
    kept = seen.filter(F.when(F.col("_n") > 1, failed.cast("boolean")).otherwise(F.col("_n").isNull()))
    return kept.select(*[target[c] for c in target.columns]).unionByName(source)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One row per key, the one with the greatest `order_by`; ties go to the greatest row."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(order_by, *[c for c in rest if c != order_by])
    best = df.groupBy(*keys).agg(F.max(row).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    return target.unionByName(batch)


def replace_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the target rows whose key occurs in the batch, then add the batch.

    Columns are compared one by one and null equals null, so a re-run changes nothing.
    """
    present = batch.select(*keys).distinct()
    return join_null_safe(target, present, keys, "left_anti").unionByName(batch)


def replace_by_text_key(
    target: DataFrame, batch: DataFrame, key: Callable[[DataFrame], Column]
) -> DataFrame:
    """The same by one computed text key: a target row with a null key is never deleted."""
    present = batch.select(key(batch).alias("_key")).distinct()
    kept = target.join(present, key(target) == present["_key"], "left_anti")
    return kept.unionByName(batch)
