"""Calibrated confidence: what share of reviewed rows was right at a confidence, and where to cut for a target precision."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNTS = ("low", "high", "reviewed", "correct")


def pooled(low: Sequence, high: Sequence, n: Sequence, ok: Sequence) -> list[list]:
    """Pool neighbours until the shares ok/n strictly rise; the input is in ascending order.

    Shares are compared by their integer products, so equal shares always pool.
    """
    blocks: list[list] = []
    for a, z, m, k in zip(low, high, n, ok):
        block = [a, z, int(m), int(k)]
        while blocks and blocks[-1][3] * block[2] >= block[3] * blocks[-1][2]:
            before = blocks.pop()
            block = [before[0], block[1], before[2] + block[2], before[3] + block[3]]
        blocks.append(block)
    return blocks


def calibration(
    labelled: DataFrame, by: Sequence[str] = (), confidence: str = "confidence", correct: str = "is_correct"
) -> DataFrame:
    """Isotonic regression of correctness on confidence, overall or by columns: a row per block of confidences with
    `low`, `high`, `reviewed`, `correct` and `calibrated`, the block's share of correct rows.

    Rows are counted per confidence, sorted into ranges, and pooled in each range; the ranges' blocks are then pooled
    once more, which gives the same blocks as one pass over all. Blocks have different shares, and N rows can hold no
    more than about N ** (2/3) different shares, so the last step reads some ten thousand blocks for a million reviews
    and a million for a billion, per group at most. Rows without a confidence (null or NaN) or a verdict take no part.
    """
    by = list(by)
    value = F.col(confidence).cast("double")
    right = F.col(correct).cast("boolean")
    rows = labelled.select(*by, (value + F.lit(0.0)).alias("low"), right.cast("long").alias("_ok"))
    rows = rows.filter("low IS NOT NULL AND NOT isnan(low) AND _ok IS NOT NULL")
    counts = rows.groupBy(*by, "low").agg(F.count("*").alias("reviewed"), F.sum("_ok").alias("correct"))
    counts = counts.select(*by, "low", F.col("low").alias("high"), "reviewed", "correct")
    schema = counts.schema
    index = {name: i for i, name in enumerate(by)}

    def in_range(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, rest = None, []
        frame = lambda: pd.DataFrame([[*key, *b] for b in rest], columns=[*by, *COUNTS])
        for pdf in batches:
            keys = list(zip(*[pdf[c].astype(object).where(pdf[c].notna(), None) for c in by])) if by else [()] * len(pdf)
            start = 0
            for stop in range(1, len(pdf) + 1):
                if stop < len(pdf) and keys[stop] == keys[start]:
                    continue
                if rest and key != keys[start]:
                    yield frame()
                    rest = []
                key, part = keys[start], pdf.iloc[start:stop]
                columns = [[*[b[i] for b in rest], *part[c].tolist()] for i, c in enumerate(COUNTS)]
                rest = pooled(*columns)
                start = stop
        if rest:
            yield frame()

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("low")
        blocks = pd.DataFrame(pooled(*[pdf[c].tolist() for c in COUNTS]), columns=list(COUNTS))
        for name in by:
            blocks.insert(index[name], name, [pdf[name].iloc[0]] * len(blocks))
        return blocks[[*by, *COUNTS]]

    ranges = counts.repartitionByRange(*by, "low").sortWithinPartitions(*by, "low").mapInPandas(in_range, schema)
    blocks = ranges.groupBy(*by).applyInPandas(merged, schema)
    return blocks.withColumn("calibrated", F.col("correct") / F.col("reviewed"))


def wilson_bound(ok: Column, n: Column, z: float = 1.959964) -> Column:
    """The lower end of Wilson's interval for a share; null for no rows."""
    n = F.nullif(n.cast("double"), F.lit(0.0))
    share = ok / n
    middle = share + z * z / (2 * n)
    return (middle - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def calibrated_threshold(blocks: DataFrame, targets: Sequence[float], by: Sequence[str] = (), z: float = 1.959964) -> DataFrame:
    """Per target precision the lowest confidence to automate from: `threshold`, and of the reviewed rows at or above it
    their number, the correct ones and the lower bound of their precision.

    Cut-offs are the lower ends of the blocks of `calibration`. A cut-off does if the lower bound of the precision above it
    reaches the target; where none does, threshold and figures are null, and nothing may be automated. The window reads
    blocks, not rows.
    """
    by = list(by)
    above = Window.partitionBy(*by).orderBy(F.desc("low")).rowsBetween(Window.unboundedPreceding, 0)
    tails = blocks.withColumns({"_n": F.sum("reviewed").over(above), "_ok": F.sum("correct").over(above)})
    tails = tails.withColumn("_bound", wilson_bound(F.col("_ok"), F.col("_n"), z))
    best = [
        F.min_by(F.struct(F.col("low"), F.col("_n"), F.col("_ok"), F.col("_bound")), F.when(F.col("_bound") >= t, F.col("low"))).alias(f"_{i}")
        for i, t in enumerate(targets)
    ]
    lines = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("target"),
                F.col(f"_{i}.low").alias("threshold"),
                F.col(f"_{i}._n").alias("automated"),
                F.col(f"_{i}._ok").alias("correct"),
                F.round(f"_{i}._bound", 6).alias("lower_bound"),
            )
            for i, t in enumerate(targets)
        ]
    )
    return tails.groupBy(*by).agg(*best).select(*by, F.explode(lines).alias("l")).select(*by, "l.*")


def calibrated(rows: DataFrame, blocks: DataFrame, by: Sequence[str] = (), confidence: str = "confidence") -> DataFrame:
    """Add `calibrated`: the share of the last block that starts at or below the row's confidence, the first block's
    for lower ones; null without a confidence or for a group without blocks.

    The blocks go to the workers as sorted arrays; `calibration` states their bound.
    """
    by = list(by)
    table: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    found = blocks.select(*by, "low", "calibrated").orderBy("low").collect()
    grouped: dict[tuple, list] = {}
    for r in found:
        grouped.setdefault(tuple(r[c] for c in by), []).append((r["low"], r["calibrated"]))
    for key, pairs in grouped.items():
        table[key] = tuple(np.array(x) for x in zip(*pairs))
    places = {key: i for i, key in enumerate(table)}
    arrays = list(table.values())

    @F.pandas_udf(T.DoubleType())
    def looked_up(group: pd.Series, value: pd.Series) -> pd.Series:
        out = np.full(len(value), np.nan)
        x = value.to_numpy(dtype=float, na_value=np.nan)
        known = group.to_numpy(dtype=float, na_value=np.nan)
        for g in np.unique(known[~np.isnan(known)]).astype(int):
            at = np.flatnonzero((known == g) & ~np.isnan(x))
            low, share = arrays[g]
            out[at] = share[np.maximum(np.searchsorted(low, x[at], "right") - 1, 0)]
        return pd.Series(out).astype(object).where(~np.isnan(out), None)

    if not by:
        group = F.lit(0 if arrays else None).cast("int")
        return rows.withColumn("calibrated", looked_up(group, F.col(confidence).cast("double")))
    spark = rows.sparkSession
    schema = T.StructType([*[T.StructField(f"_{c}", blocks.schema[c].dataType) for c in by], T.StructField("_group", T.IntegerType())])
    groups = spark.createDataFrame([(*key, i) for key, i in places.items()], schema)
    same = F.lit(True)
    for c in by:
        same = same & rows[c].eqNullSafe(groups[f"_{c}"])
    joined = rows.join(groups, same, "left")
    return joined.withColumn("calibrated", looked_up(F.col("_group"), F.col(confidence).cast("double"))).select(*rows.columns, "calibrated")
