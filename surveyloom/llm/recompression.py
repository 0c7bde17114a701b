"""Removal of repeated word sequences by recompression.

Recompression replaces, round by round, runs of one symbol and then pairs from a left and a right half of the alphabet
by new symbols. Here a symbol's name is a hash of what it replaces, and its half a bit of a hash of its name and the round,
so that all documents agree on both without asking each other. Equal stretches then have equal symbols inside; only
near their ends may the parse differ, where it depends on what stands beside. Each symbol carries the range of words
that settle it. A window of words speaks through the first symbol, on the highest level that has one, whose range
lies inside the window: equal windows choose the same symbol. Windows whose symbol no second document has are unique; the
others are verified by two independent 64-bit names of the whole window, each over its own word hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from surveyloom.llm import arrays
from surveyloom.llm.arrays import U64
from surveyloom.llm.chunks import Chunk
from surveyloom.llm.repeats import Method, Samples, Units, removed

ROUNDS = 6


@dataclass
class Level:
    """Symbols in order: names, and the words [first, last) that settle each.

    `begin` and `end` are the bounds of each symbol's document. `first` and `last` ascend.
    """

    names: np.ndarray
    first: np.ndarray
    last: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def _beside(level: Level) -> tuple[np.ndarray, np.ndarray]:
    """What the left and the right neighbour need. Beyond the document's ends, that is a word no window holds."""
    left, right = level.begin - 1, level.end + 1
    same = level.begin[1:] == level.begin[:-1]
    left[1:] = np.where(same, level.first[:-1], left[1:])
    right[:-1] = np.where(same, level.last[1:], right[:-1])
    return left, right


def _runs(level: Level, round: int) -> Level:
    """Name each maximal run of one symbol. A symbol is known to be no run, or where it ends, by its neighbours."""
    left, right = _beside(level)
    fresh = np.ones(len(level.names), bool)
    fresh[1:] = (level.names[1:] != level.names[:-1]) | (level.begin[1:] != level.begin[:-1])
    first = np.flatnonzero(fresh)
    sizes = np.diff(np.append(first, len(fresh)))
    last = first + sizes - 1
    names = level.names[first]
    long = sizes > 1
    names[long] = arrays.mix(names[long] ^ arrays.mix(sizes[long].astype(U64) ^ U64((round * 2 + 1) << 40)))
    return Level(names, left[first], right[last], level.begin[first], level.end[first])


def _pairs(level: Level, round: int) -> Level:
    """Name each pair of a left and a right symbol. A symbol left alone is known to be so by one neighbour."""
    left, right = _beside(level)
    half = (arrays.mix(level.names ^ U64((round * 2 + 2) << 40)) >> U64(17)) & U64(1) == 1
    joins = np.zeros(len(half), bool)  # with the next
    joins[:-1] = ~half[:-1] & half[1:] & (level.begin[1:] == level.begin[:-1])
    second = np.zeros(len(half), bool)
    second[1:] = joins[:-1]
    first = np.where(half, left, level.first)
    last = np.where(half, level.last, right)
    heads = np.flatnonzero(joins)
    first[heads], last[heads] = level.first[heads], level.last[heads + 1]
    names = level.names.copy()
    names[heads] = arrays.mix(arrays.mix(names[heads] + U64(0x51ED)) ^ level.names[heads + 1])
    stay = ~second
    return Level(names[stay], first[stay], last[stay], level.begin[stay], level.end[stay])


def levels(words: np.ndarray, bounds: np.ndarray, rounds: int = ROUNDS) -> list[Level]:
    """The words themselves and the symbols after each round. `bounds`: of the documents' words (n + 1)."""
    at, sizes = np.arange(len(words)), np.diff(bounds)
    out = [Level(words, at, at + 1, np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes))]
    for round in range(rounds if len(words) else 0):
        out.append(_pairs(_runs(out[-1], round), round))
    return out


def anchors(found: list[Level], windows: np.ndarray, width: int) -> np.ndarray:
    """The name that each window of words (ascending starts) speaks through."""
    names = np.zeros(len(windows), U64)
    open_ = np.arange(len(windows))
    for number in range(len(found) - 1, -1, -1):
        level = found[number]
        at = np.searchsorted(level.first, windows[open_])
        inside = at < len(level.first)
        inside[inside] = level.last[at[inside]] <= windows[open_[inside]] + width
        names[open_[inside]] = arrays.mix(level.names[at[inside]] ^ U64(number << 32))
        open_ = open_[~inside]
    return names


def recompression_dedup(docs: DataFrame, width: int = 50, rounds: int = ROUNDS) -> DataFrame:
    """Remove each word covered by a window of `width` words that also starts in a document with a smaller doc_id.

    Takes doc_id and text; words are runs of bytes other than 0x20 and 0x09-0x0D, unchanged. Returns doc_id, n_units
    (words), spans (removed runs, as start and stop in words) and kept (the remaining words joined by one blank).
    Windows are judged on the input. For nulls, repeated ids and empty input see `repeats.removed`.
    """

    def load(chunk: Chunk) -> Units:
        starts, stops, bounds = arrays.word_spans(chunk.text, chunk.offsets)
        return Units(chunk, bounds, arrays.word_hashes(chunk.text, starts, stops), starts, stops)

    def sample(units: Units, live: np.ndarray) -> Samples:
        lengths = np.diff(units.bounds)
        use = np.flatnonzero(live & (lengths >= width))
        words = arrays.expand(units.bounds[use], units.bounds[use + 1])
        doc = np.repeat(use, lengths[use])
        own = np.concatenate(([0], np.cumsum(lengths[use]))).astype(np.int64)
        found = levels(units.values[words], own, rounds)
        windows = arrays.expand(own[:-1], own[1:] - width + 1)
        names = anchors(found, windows, width)
        at = words[windows]
        return Samples(names, doc[windows], at, at)

    def fingerprint(units: Units, positions: np.ndarray):
        if not len(positions):
            return units.values[:0], units.values[:0]
        others = arrays.word_hashes(units.chunk.text, units.starts, units.stops, lane=1)
        return arrays.word_windows(units.values, positions, width), arrays.word_windows(others, positions, width, 0x5EED)

    def keep(units: Units, gone: np.ndarray) -> list[bytes]:
        out = []
        text = units.chunk.text.tobytes()
        starts, stops = units.starts, units.stops
        for a, b in zip(units.bounds.tolist(), units.bounds.tolist()[1:]):
            left = np.flatnonzero(~gone[a:b]) + a
            out.append(b" ".join([text[s:e] for s, e in zip(starts[left].tolist(), stops[left].tolist())]))
        return out

    return removed(docs, Method(width, load, sample, fingerprint, keep, "string"))
