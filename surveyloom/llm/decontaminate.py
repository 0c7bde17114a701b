"""Benchmark passages in documents: CGK walks, bit sampling, and exact edit distances.

The CGK embedding walks along a sequence: at step j it writes the current symbol and moves on or stays by a random bit
of (j, symbol). Two sequences at a small edit distance soon walk in step again, so that their embeddings are close in
Hamming distance, and a few sampled coordinates agree with good probability. Here symbols are words, in lower case. Every word
of a document starts a window as long as any item, and every word of an item a piece of it; a walk reads them alike, so one
key for each repetition serves windows of all sizes. A key that an item's piece has too gives a place for
the item; there the exact edit distance in words decides. How far walks go, how many steps are sampled and how often they are repeated
depends on the item's length (`WALKS`), such that the walks alone find at least nine of ten items at the allowed distance.

Walks can still miss a place, and items of fewer than eight words have none. So each item is also
cut into one run of words more than it may have edits. An edit touches one run, so a passage within the distance holds some run
as it is, and no place is missed whatever the item's length and wherever its edits are.

The benchmark is dealt into blocks of bounded size, each indexed by a task and written to the shared folder. One pass over the
documents loads block after block; documents never move. Places of a key that many items have are looked at in slices of
bounded size, and only those near a word that is rare in the part of the documents.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from surveyloom.llm import arrays
from surveyloom.llm.arrays import U64
from surveyloom.llm.chunks import shuffles_dropped
from surveyloom.session import new_folder, ship_package

PERCENT = 25  # words of an item that may be edited
BLOCK_WORDS = 100_000  # of the benchmark in one index, on average: bounds what a task holds of it
SLICE = 1 << 18  # places looked at together
_TOP = 22


@dataclass(frozen=True)
class Walk:
    """Walks of items of at least `words` words: sampled steps of all steps, and the words that a walk has to move on by."""

    words: int
    samples: int
    steps: int
    repetitions: int
    moves: int

    def sampled(self, repetition: int) -> list[int]:
        """The sampled steps of a repetition; the first always, so that a window is led by its first word."""
        order = np.argsort(arrays.seeded(100 + repetition, self.steps - 1))[: self.samples - 1]
        return [0, *sorted((order + 1).tolist())]


WALKS = (Walk(8, 3, 5, 6, 2), Walk(12, 4, 7, 8, 3), Walk(24, 5, 10, 6, 4))


def walk_of(n: int) -> int | None:
    """The number of the walks for an item of n words."""
    return max((i for i, walk in enumerate(WALKS) if walk.words <= n), default=None)


def walk_keys(words: np.ndarray, starts: np.ndarray, number: int, repetition: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sampled keys of the walks that move on far enough, their starts, and the last words they read."""
    walk = WALKS[number]
    bits = arrays.mix(words ^ U64(0xC6 + repetition))
    sampled = walk.sampled(repetition)
    last = len(words) - 1
    at = starts.copy()
    keys = np.full(len(starts), (number << 8) + repetition + 1, U64)
    for step in range(sampled[-1] + 1):
        if step in sampled:
            keys *= U64(0x9E3779B97F4A7C15)
            keys ^= words[at]
            keys ^= keys >> U64(29)
        if step < sampled[-1]:
            at += ((bits[at] >> U64(step)) & U64(1)).astype(at.dtype)
            np.minimum(at, last, out=at)
    far = at - starts >= walk.moves
    return arrays.mix(keys[far]), starts[far], at[far]


def _flags(hashes: np.ndarray) -> np.ndarray:
    """A table of the highest bits that any of the hashes has."""
    out = np.zeros(1 << _TOP, bool)
    out[hashes >> U64(64 - _TOP)] = True
    return out


@dataclass
class Index:
    """A block of the benchmark: items' words, and the keys of their pieces and runs, ascending, with item and offset."""

    numbers: list  # item ids
    copies: list[int]  # rows of the benchmark with this id and text
    words: list[np.ndarray]
    allowed: np.ndarray
    keys: np.ndarray
    items: np.ndarray
    offsets: np.ndarray
    widths: tuple[int, ...]  # of the runs
    walks: tuple[int, ...]

    def __post_init__(self):
        self.sizes = np.array([len(own) for own in self.words], np.int64)
        flat = np.concatenate([*self.words, np.empty(0, U64)])
        self.vocabulary, ids = np.unique(flat, return_inverse=True)
        pairs = np.repeat(np.arange(len(self.words)), self.sizes) * (len(self.vocabulary) + 1) + ids
        pairs, self.times = np.unique(pairs, return_counts=True)
        self.holders, self.held = np.divmod(pairs, len(self.vocabulary) + 1)  # distinct words of items
        self.seen, self.known = _flags(self.keys), _flags(self.vocabulary)

    def __reduce__(self):
        return Index, (self.numbers, self.copies, self.words, self.allowed, self.keys, self.items, self.offsets, self.widths, self.walks)

    def near(self, words: np.ndarray, at: np.ndarray) -> Near:
        """What the words at some ascending positions, all of those that items have among them, say of the items."""
        found = np.searchsorted(self.vocabulary, words)
        found[found == len(self.vocabulary)] = 0
        hit = self.vocabulary[found] == words
        found, at = found[hit], at[hit]
        counts = np.bincount(found, minlength=len(self.vocabulary))
        shared = np.bincount(self.holders, np.minimum(counts[self.held], self.times), len(self.words))
        possible = (shared >= self.sizes - self.allowed) & (self.sizes > 0)
        pairs = np.flatnonzero(possible[self.holders])
        pairs = pairs[np.lexsort((counts[self.held[pairs]], self.holders[pairs]))]
        holders, held = self.holders[pairs], self.held[pairs]
        items = np.arange(len(self.words) + 1)
        rare = np.arange(len(holders)) - np.searchsorted(holders, items)[holders] <= self.allowed[holders]
        holders, held = holders[rare], held[rare]
        asked = np.zeros(len(self.vocabulary), bool)
        asked[held] = True
        some = asked[found]
        span = int(at[-1]) + 2 if len(at) else 1
        return Near(self, possible, np.searchsorted(holders, items), held, np.sort(found[some] * span + at[some]), span)


@dataclass
class Near:
    """Which items a part of the documents can hold, and where it has their rarest words, one more than may be edited.

    An item within its distance keeps one of them, so a place that none of them is near to is none.
    """

    index: Index
    possible: np.ndarray
    cuts: np.ndarray  # of each item's rarest words
    held: np.ndarray
    where: np.ndarray  # word * span + position, ascending
    span: int

    def keeps(self, items: np.ndarray, first: np.ndarray) -> np.ndarray:
        allowed = self.index.allowed[items]
        low = np.clip(first - allowed, 0, self.span - 1)
        high = np.minimum(first + self.index.sizes[items] + allowed, self.span)
        out, left, turn = np.zeros(len(items), bool), np.arange(len(items)), 0
        where = np.append(self.where, np.iinfo(np.int64).max)
        while len(left):
            word = self.cuts[items[left]] + turn
            left, word = (x[word < self.cuts[items[left] + 1]] for x in (left, word))
            base = self.held[word] * self.span
            hit = where[np.searchsorted(self.where, base + low[left])] < base + high[left]
            out[left[hit]] = True
            left, turn = left[~hit], turn + 1
        return out


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    text, offsets = arrays.text_bytes(texts)
    starts, stops, bounds = arrays.word_spans(text, offsets)
    return arrays.word_hashes(text, starts, stops, lower=True), bounds


def build_index(numbers: list, texts: list[str], percent: int = PERCENT, walks: bool = True, runs: bool = True, copies: list[int] | None = None) -> Index:
    """The index of some items. Without `walks` or `runs`, the other's keys alone."""
    words, bounds = _words(pa.array(texts, pa.string()))
    items = [words[a:b] for a, b in zip(bounds, bounds[1:])]
    allowed = percent * np.diff(bounds) // 100
    keys, owners, offsets, widths, walked = [], [], [], set(), set()

    def add(item: int, found: np.ndarray, at: np.ndarray):
        keys.append(found)
        owners.append(np.full(len(at), item))
        offsets.append(at)

    for item, own in enumerate(items):
        if runs and len(own):
            cuts = np.arange(allowed[item] + 2) * len(own) // (allowed[item] + 1)
            widths.update(np.diff(cuts).tolist())
            for start, n in zip(cuts[:-1], np.diff(cuts).tolist()):
                add(item, _exact_keys(own, np.full(1, start), n), np.full(1, start))
        number = walk_of(len(own)) if walks else None
        if number is None:
            continue
        walked.add(number)
        padded = np.concatenate([own, np.zeros(1, U64)])
        for repetition in range(WALKS[number].repetitions):
            found, at, end = walk_keys(padded, np.arange(len(own)), number, repetition)
            add(item, found[end < len(own)], at[end < len(own)])
    none = np.empty(0, np.int64)
    keys, owners, offsets = (np.concatenate(x) if x else none for x in (keys, owners, offsets))
    order = np.argsort(keys, kind="stable")
    keys = keys[order].astype(U64)
    return Index(numbers, copies or [1] * len(numbers), items, allowed, keys, owners[order], offsets[order], tuple(sorted(widths)), tuple(sorted(walked)))


def _exact_keys(words: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    return arrays.mix(arrays.word_windows(words, starts, n, seed=n) ^ U64(n))


def _places(words: np.ndarray, bounds: np.ndarray, index: Index) -> Iterator[np.ndarray]:
    """Rows (document, item, first word of the item if its place is kept), some `SLICE` at a time."""
    starts = np.flatnonzero(index.known[words >> U64(64 - _TOP)])  # a key begins with a word of an item
    if not len(index.keys):
        return
    near = index.near(words[starts], starts)
    possible = near.possible[index.items]
    index_keys, items, offsets = index.keys[possible], index.items[possible], index.offsets[possible]
    if not len(index_keys):
        return
    doc_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))

    def look(keys: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
        maybe = np.flatnonzero(index.seen[keys >> U64(64 - _TOP)])
        low, high = (np.searchsorted(index_keys, keys[maybe], side) for side in ("left", "right"))
        some = high > low
        low, high, at = low[some], high[some], at[maybe[some]]
        ends = np.concatenate(([0], np.cumsum(high - low)))
        i = 0
        while i < len(low):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] + SLICE, "right")) - 1)
            rows = arrays.expand(low[i:j], high[i:j])
            place = np.repeat(at[i:j], (high - low)[i:j])
            item, first = items[rows], place - offsets[rows]
            kept = near.keeps(item, first)
            yield np.stack([doc_of[place[kept]], item[kept], first[kept]], axis=1)
            i = j

    padded = np.concatenate([words, np.zeros(1, U64)])
    for number in index.walks:
        for repetition in range(WALKS[number].repetitions):
            yield from look(*walk_keys(padded, starts, number, repetition)[:2])
    left = bounds[1:][doc_of[starts]] - starts
    for n in index.widths:
        at = starts[left >= n]
        if len(at):
            yield from look(_exact_keys(words, at, n), at)


def _sliced(places: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """The distinct rows of some `SLICE` or more together."""
    held, size = [], 0
    for rows in places:
        held.append(rows)
        size += len(rows)
        if size >= SLICE:
            yield _distinct(np.concatenate(held))
            held, size = [], 0
    if size:
        yield _distinct(np.concatenate(held))


def _distinct(rows: np.ndarray) -> np.ndarray:
    """The distinct rows, ascending."""
    rows = rows[np.lexsort(rows.T[::-1])]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return rows[fresh]


def _regions(words: np.ndarray, bounds: np.ndarray, index: Index, places: np.ndarray) -> list[list[int]]:
    """Rows (document, item, first word, stop) where an item may be: around its places that hold enough of its words, joined where they overlap."""
    doc, item, first = places.T
    allowed, sizes = index.allowed[item], index.sizes[item]
    low = np.maximum(bounds[doc], first - allowed)
    high = np.minimum(bounds[doc + 1], first + sizes + allowed)
    order = np.argsort(item, kind="stable")
    keep = np.zeros(len(places), bool)
    for some in np.split(order, np.flatnonzero(np.diff(item[order])) + 1) if len(order) else ():
        own, most = index.words[item[some[0]]], int(allowed[some[0]])
        span = np.arange(len(own) + 2 * most)
        distinct, times = np.unique(own, return_counts=True)
        step = max(1, (1 << 20) // len(span))
        for at in range(0, len(some), step):
            rows = some[at : at + step]
            inside = low[rows, None] + span
            held = np.where(inside < high[rows, None], words[np.minimum(inside, len(words) - 1)], U64(0))
            shared = np.zeros(len(rows), np.int64)
            for word, n in zip(distinct, times):
                shared += np.minimum((held == word).sum(axis=1), n)
            keep[rows] = shared >= len(own) - most
    doc, item, low, high = doc[keep], item[keep], low[keep], high[keep]
    if not len(doc):
        return []
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (low[1:] > high[:-1])
    begins = np.flatnonzero(fresh)
    return np.stack([doc[begins], item[begins], low[begins], np.maximum.reduceat(high, begins)], axis=1).tolist()


def edit_distance_within(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """The least number of word edits that turn the item into a substring of the region, and where the first such ends."""
    steps = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (region != word), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


def matches(texts: pa.Array, index: Index) -> list[tuple[int, int, int, int]]:
    """(document, item, distance, end), the best place of each item in each document; the first of equal ones."""
    return _matches(*_words(texts), index)


def _matches(words: np.ndarray, bounds: np.ndarray, index: Index) -> list[tuple[int, int, int, int]]:
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for places in _sliced(_places(words, bounds, index)):
        for doc, item, low, high in _regions(words, bounds, index, places):
            distance, end = edit_distance_within(index.words[item], words[low:high])
            if distance <= index.allowed[item]:
                found = distance, low + end - int(bounds[doc])
                best[doc, item] = min(found, best.get((doc, item), found))
    return [(doc, item, *found) for (doc, item), found in sorted(best.items())]


def _write_indexes(benchmark: DataFrame, percent: int) -> str:
    """The benchmark's indexes, one file a block, in the shared folder. Rows of one id and text are one item with copies."""
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    items = items.groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    words = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long"))).first()[0] or 0
    blocks = -(-words // BLOCK_WORDS) or 1

    def indexed(block: pa.Table) -> pa.Table:
        numbers, texts, copies = (block[name].to_pylist() for name in ("item_id", "text", "copies"))
        return pa.table({"index": pa.array([pickle.dumps(build_index(numbers, texts, percent, copies=copies))], pa.binary())})

    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    folder = new_folder(spark, "benchmark")
    with shuffles_dropped(spark):
        dealt.groupBy("block").applyInArrow(indexed, "index binary").write.option("maxRecordsPerFile", 1).parquet(folder)
    return folder


@arrays.stage_cache
def _index(folder: str, name: str) -> Index | None:
    files, _ = fs.FileSystem.from_uri(folder)
    with files.open_input_file(name) as file:
        rows = pq.read_table(file)["index"]
        return pickle.loads(rows[0].as_py()) if len(rows) else None


def _blocks(folder: str) -> list[str]:
    files, root = fs.FileSystem.from_uri(folder)
    return sorted(x.path for x in files.get_file_info(fs.FileSelector(root)) if x.base_name.startswith("part-"))


def _found(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    """Each part of the batches with (row, item_id, distance, end) of its matches. A single block stays in the worker for its stage."""
    arrays.release(_index)
    names = _blocks(folder)
    for part in arrays.parts(batches, "text"):
        words, bounds = _words(part.column("text"))
        found = []
        for index in (_index(folder, name) for name in names):
            if index is not None:
                found += [(doc, index.numbers[item], *place) for doc, item, *place in _matches(words, bounds, index) for _ in range(index.copies[item])]
        yield part, found
    arrays.release(_index)


def contamination(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row for each document and benchmark item in it: doc_id, item_id, distance (word edits), end_word.

    A document holds an item if some passage is within `percent` per cent of the item's words, rounded down, in word edits. So at
    25 per cent an item of fewer than 4 words must be there as it is. Of the passages at the least distance, the one that ends first
    gives end_word. Items without words, or null, never match, and null texts
    hold nothing. Rows that repeat a doc_id or an item_id are each looked at. Without items or documents there are no rows.
    """
    if not 0 <= percent < 100:
        raise ValueError(f"{percent} per cent of an item's words can't be edited")
    ship_package(docs.sparkSession)
    folder = _write_indexes(benchmark, percent)
    item_id = benchmark.schema["item_id"].dataType
    kind = to_arrow_type(item_id)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _found(batches, folder):
            ids = part.column("doc_id").take(pa.array([x[0] for x in found], pa.int64()))
            items = pa.array([x[1] for x in found], kind)
            columns = [ids, items, pa.array([x[2] for x in found], pa.int32()), pa.array([x[3] for x in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "distance", "end_word"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(search, f"doc_id long, item_id {item_id.simpleString()}, distance int, end_word long")


def decontaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that hold no benchmark item (see `contamination`), with all their columns. Null and empty texts stay."""
    if not 0 <= percent < 100:
        raise ValueError(f"{percent} per cent of an item's words can't be edited")
    ship_package(docs.sparkSession)
    folder = _write_indexes(benchmark, percent)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _found(batches, folder):
            hit = np.zeros(part.num_rows, bool)
            hit[[x[0] for x in found]] = True
            yield part.filter(pa.array(~hit))

    return docs.mapInArrow(clean, docs.schema)
