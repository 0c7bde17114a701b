"""Fixed-size sketches of word sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2**31 - 1


def multipliers(n: int) -> list[tuple[int, int]]:
    """Pairs (a, b) of a multiplicative generator modulo `PRIME`, one per hash function."""
    values, x = [], 20240101
    for _ in range(2 * n):
        x = x * 48271 % PRIME
        values.append(x)
    return list(zip(values[::2], values[1::2]))


def word_hash(word: Column) -> Column:
    """A 31-bit hash out of the word's digest."""
    return F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint") % PRIME


def set_digest(words: Column) -> Column:
    """A digest of a set of words, whatever their order."""
    return F.sha2(F.concat_ws("\u0001", F.sort_array(words)), 256)
