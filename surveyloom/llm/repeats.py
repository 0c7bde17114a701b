"""Removal of stretches that start in an earlier document too, for strings of bytes or words.

A window is `width` consecutive units of one document. A unit goes if a window that covers it also starts in a
document with a smaller doc_id, judged on the input. What differs between the operators is which samples
say that windows may repeat; from there on the work is the same:

1. copies of whole texts are found by digest; all their windows repeat, and nothing else needs to know them;
2. every chunk sends the names of its samples; a window with no sample that a second document has is unique;
3. the other windows are named by 64 or 128 bits at full width, and the smallest doc_id of each name decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm import arrays, chunks
from surveyloom.llm.chunks import Asked, Chunk


@dataclass
class Units:
    """A chunk's units: `bounds` of each document's (n + 1), their values, and their places in the text."""

    chunk: Chunk
    bounds: np.ndarray
    values: np.ndarray
    starts: np.ndarray | None = None
    stops: np.ndarray | None = None

    def docs(self, positions: np.ndarray) -> np.ndarray:
        return np.repeat(np.arange(len(self.chunk)), np.diff(np.searchsorted(positions, self.bounds)))


@dataclass
class Samples:
    """Names, their documents, and the first and last window start for which each speaks; all ascend but the names."""

    names: np.ndarray
    docs: np.ndarray
    first: np.ndarray
    last: np.ndarray


@dataclass
class Method:
    width: int
    load: Callable[[Chunk], Units]
    sample: Callable[[Units, np.ndarray], Samples]  # units and which documents to sample
    fingerprint: Callable[[Units, np.ndarray], tuple[np.ndarray, np.ndarray | None]]  # at ascending window starts
    keep: Callable[[Units, np.ndarray], list[bytes]]  # what is left of each document, by a mask of removed units
    kept_type: str  # "binary" or "string"
    chunk_bytes: int = chunks.CHUNK_BYTES


def _live(row: dict) -> np.ndarray:
    return ~np.frombuffer(row["copied"], bool)


def _ranked(names: np.ndarray, checks: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The first position of each distinct fingerprint, by ascending fingerprint, and the group of each position."""
    order = np.argsort(names, kind="stable") if checks is None else np.lexsort((np.arange(len(names)), checks, names))
    fresh = np.ones(len(order), bool)
    ranked = names[order]
    fresh[1:] = ranked[1:] != ranked[:-1]
    if checks is not None:
        ranked = checks[order]
        fresh[1:] |= ranked[1:] != ranked[:-1]
    group = np.empty(len(order), np.int32)
    group[order] = np.cumsum(fresh, dtype=np.int32) - 1
    return order[fresh], group


def _windows(row: dict, units: Units) -> np.ndarray:
    starts, stops = (arrays.unpack_ascending(row[name]).astype(np.int64) for name in ("zone_starts", "zone_stops"))
    return arrays.expand(starts, stops)


def removed(docs: DataFrame, method: Method) -> DataFrame:
    """Per row of `docs`: doc_id, n_units, spans (array of start and stop in units) and kept (the rest).

    A null text is empty. A null doc_id is larger than any other and stays null; rows of one doc_id never remove
    each other's units. Other columns are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    table = chunks.store(docs, method.chunk_bytes)
    base = table.join(chunks.copies(table), "chunk_id")
    bits = chunks.name_bits(table.agg(F.sum("n_bytes")).first()[0] or 1)

    def ask_samples(row):
        units = method.load(chunks.chunk_of(row))
        found = method.sample(units, _live(row))
        return Asked(*chunks.counted(found.names, found.docs, bits))

    def zones(batches: Iterator[pa.RecordBatch]):
        for row in chunks.rows_of(batches):
            units = method.load(chunks.chunk_of(row))
            found = method.sample(units, _live(row))
            names, _ = chunks.counted(found.names, found.docs, bits)
            shared = names[chunks.answer(row["replies"], "count") >= 2]
            some = chunks.members(found.names, shared, bits)
            starts, stops = arrays.merged(found.first[some], found.last[some] + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["chunk_id"]], pa.int64()),
                    pa.array([arrays.pack_ascending(starts)], pa.binary()),
                    pa.array([arrays.pack_ascending(stops)], pa.binary()),
                ],
                ["chunk_id", "zone_starts", "zone_stops"],
            )

    def ask_windows(row):
        units = method.load(chunks.chunk_of(row))
        positions = _windows(row, units)
        names, checks = method.fingerprint(units, positions)
        first, _ = _ranked(names, checks)
        ids = arrays.signed_to_unsigned(units.chunk.ids[units.docs(positions)[first]])
        return Asked(names[first], ids, None if checks is None else checks[first])

    def cut(batches: Iterator[pa.RecordBatch]):
        for row in chunks.rows_of(batches):
            units = method.load(chunks.chunk_of(row))
            positions = _windows(row, units)
            first, group = _ranked(*method.fingerprint(units, positions))
            ids = units.chunk.ids[units.docs(positions)]
            again = chunks.answer(row["replies"], "below").astype(bool)[group] | (ids > ids[first][group])
            gone = _covered(units, positions[again], method.width, ~_live(row))
            yield from _results(units, gone, method)

    replies = chunks.exchange(base, ask_samples, bits, "sum", "count")
    zone_rows = base.join(replies, "chunk_id", "left").mapInArrow(arrays.released(zones), "chunk_id long, zone_starts binary, zone_stops binary")
    base = base.join(chunks.written(zone_rows, "zones"), "chunk_id")
    replies = chunks.exchange(base, ask_windows, 64, "min", "below")
    schema = f"doc_id long, n_units long, spans array<struct<start:long,stop:long>>, kept {method.kept_type}"
    out = base.join(replies, "chunk_id", "left").mapInArrow(arrays.released(cut), schema)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(chunks.NO_ID), F.col("doc_id")))


def _covered(units: Units, windows: np.ndarray, width: int, copied: np.ndarray) -> np.ndarray:
    """A mask of the units that the windows cover, and all units of copied documents that have a window."""
    total = int(units.bounds[-1])
    lengths = np.diff(units.bounds)
    whole = np.flatnonzero(copied & (lengths >= width))
    out = np.zeros(total, bool)
    starts, stops = arrays.merged(windows, windows + width)
    out[arrays.expand(starts, stops)] = True
    out[arrays.expand(units.bounds[whole], units.bounds[whole + 1])] = True
    return out


def _results(units: Units, gone: np.ndarray, method: Method) -> Iterator[pa.RecordBatch]:
    kept = method.keep(units, gone)
    before = np.zeros(len(gone), bool)
    before[1:] = gone[:-1]
    before[units.bounds[:-1][np.diff(units.bounds) > 0]] = False  # a span never crosses documents
    after = np.zeros(len(gone), bool)
    after[:-1] = gone[1:]
    after[units.bounds[1:][np.diff(units.bounds) > 0] - 1] = False
    starts, stops = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
    cuts = np.searchsorted(starts, units.bounds)
    base = np.repeat(units.bounds[:-1], np.diff(cuts))
    spans = pa.ListArray.from_arrays(
        pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([pa.array(starts - base), pa.array(stops - base)], ["start", "stop"])
    )
    kind = pa.binary() if method.kept_type == "binary" else pa.string()
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(units.chunk.ids, pa.int64()),
            pa.array(np.diff(units.bounds), pa.int64()),
            spans,
            pa.array(kept, pa.binary()).cast(kind),
        ],
        ["doc_id", "n_units", "spans", "kept"],
    )
