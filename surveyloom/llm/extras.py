"""Columns that an operator doesn't read, carried past it whatever their names."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def carried(docs: DataFrame, core: Sequence[str], apply: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of `docs` after `apply`, which sees those of `core` and one struct, `carried_columns`, with all others.

    So `apply` may add columns of any name. It has to keep the struct; what it adds is dropped.
    """
    quoted = {c: f"`{c.replace('`', '``')}`" for c in docs.columns}
    rest = [c for c in docs.columns if c not in core]
    if not rest:
        return apply(docs).select(*quoted.values())
    struct = F.struct(*[F.col(quoted[c]) for c in rest]).alias("carried_columns")
    out = apply(docs.select(*[quoted[c] for c in docs.columns if c in core], struct))
    return out.select(*[F.col(quoted[c]) if c in core else F.col(f"carried_columns.{quoted[c]}").alias(c) for c in docs.columns])
