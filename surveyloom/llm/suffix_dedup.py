"""Removal of repeated byte strings by a difference-cover filter and fingerprints.

A difference cover D of period v holds, for any two positions i and j, some step below v that takes both into D. So two
equal strings of `width` bytes hold an equal string of width - v + 1 bytes at sampled positions, wherever their
documents begin. The sampled strings are named by fingerprints, and the names counted over all documents. A window beside no name
that a second document has is unique. The others are named by fingerprints of their full width, and the
smallest doc_id of each name decides.

This is a filter and not a difference-cover suffix sort: no suffixes or triples are sorted, no ranks are recursed on, no sorted
samples are merged, and no neighbours compared. Whether a window of fixed width occurs in an earlier document needs equality
alone, no order, and names can be counted where they are dealt, without a global sort.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from surveyloom.llm import arrays
from surveyloom.llm.chunks import Chunk
from surveyloom.llm.repeats import Method, Samples, Units, removed

#: Perfect difference sets by period.
COVERS = {1: (0,), 3: (0, 1), 7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
SHORTEST_SAMPLE = 16
CHUNK_BYTES = 4 << 20  # a task holds some 30 bytes for each byte of a chunk


def cover_for(width: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves sampled strings of at least 16 bytes."""
    period = max((v for v in COVERS if width - v + 1 >= SHORTEST_SAMPLE), default=1)
    return period, COVERS[period]


def suffix_dedup(docs: DataFrame, width: int = 50) -> DataFrame:
    """Remove each byte covered by a string of `width` bytes that also starts in a document with a smaller doc_id.

    Takes doc_id and text; returns doc_id, n_units (bytes), spans (removed runs, as start and stop in bytes) and
    kept (binary, the remaining bytes). Overlaps count, strings are judged on the input, matches never cross
    documents. For nulls, repeated ids and empty input see `repeats.removed`. Strings are compared by 64-bit
    fingerprints: among n repeated strings some n * n / 2 ** 65 pairs of different ones are expected to look alike.
    """
    period, cover = cover_for(width)
    sampled = np.zeros(period, bool)
    sampled[list(cover)] = True
    short = width - period + 1

    def load(chunk: Chunk) -> Units:
        return Units(chunk, chunk.offsets, chunk.text)

    def sample(units: Units, live: np.ndarray) -> Samples:
        found = []
        for doc in np.flatnonzero(live & (np.diff(units.bounds) >= width)).tolist():
            start, stop = int(units.bounds[doc]), int(units.bounds[doc + 1])
            at = np.flatnonzero(np.resize(sampled, stop - start - short + 1)) + start
            found.append(at)
        if not found:
            none = np.empty(0, np.int64)
            return Samples(none.astype(arrays.U64), none, none, none)
        at = np.concatenate(found)
        docs = units.docs(at)
        names = arrays.byte_windows(units.values, at, short)
        first = np.maximum(at - (width - short), units.bounds[docs])
        return Samples(names, docs, first, np.minimum(at, units.bounds[docs + 1] - width))

    def fingerprint(units: Units, positions: np.ndarray):
        return arrays.byte_windows(units.values, positions, width), None

    def keep(units: Units, gone: np.ndarray) -> list[bytes]:
        bounds = units.bounds.tolist()
        return [units.values[a:b][~gone[a:b]].tobytes() for a, b in zip(bounds, bounds[1:])]

    return removed(docs, Method(width, load, sample, fingerprint, keep, "binary", CHUNK_BYTES))
