"""An interpolated, modified Kneser-Ney n-gram model, counted by Spark and read as memory-mapped sorted hash arrays.

1. Words are counted over all training documents. Each range of word hashes becomes one sorted array of hashes with its counts; a
   word's id is its place in the whole.
2. Every part of the text sends its distinct n-grams, as columns of ids with their counts, dealt out by the n-gram's hash. The task
   of a range folds them, writes hashes and counts as sorted arrays, and sends on, already folded, what the next lower order needs:
   to each suffix the number of different words before it, and to each context the sum and the classes of its counts.
3. So it goes on down to single words. What is frequent costs one entry a task and order, so no n-gram is hot.
4. A scoring task maps the arrays into memory and looks up its own n-grams, sorted, so that it walks through the files once a part.

A word or n-gram is known by a 64-bit hash. Contexts reach back to a start symbol in front of each document, at most one of them;
n-grams that begin with it keep their plain counts, as nothing else can stand before them.
"""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.llm import arrays
from surveyloom.llm.arrays import U64
from surveyloom.llm.chunks import partitions, rows_of, shuffles_dropped
from surveyloom.session import new_folder, scratch, ship_package

ORDER = 3
PART = 2 << 20  # bytes of text whose n-grams are in memory at a time
HELD = 1 << 20  # distinct n-grams that a task folds before it sends them
START, UNKNOWN = 0, np.uint32(0xFFFFFFFF)
END = U64(0xE4D0F7E87A11C0DE)  # the hash of the end of a document
SENT = "bucket int, columns array<binary>"
TABLE = "sent_bucket int, columns array<binary>, part int, path string, n long, n1 long, n2 long, n3 long, n4 long, total long"
_NAMES = [x.split()[0] for x in TABLE.split(", ")]
CELL = 16  # entries of a range to one of its directory
STATS = 4  # of a context: the sum of its counts, and how many of them are 1, 2, and 3 or more
_MAPS = 16384  # files that a task keeps mapped


def _sent(buckets: np.ndarray, columns: list[np.ndarray], edges: int) -> list[tuple[int, list[bytes]]]:
    """Columns cut by bucket, sorted by the first column there, and packed."""
    order = np.argsort(buckets.astype(U64) << U64(32) | columns[0].astype(U64) & U64(0xFFFFFFFF))
    cuts = np.searchsorted(buckets[order], np.arange(edges + 1))
    return [(b, _packed([c[order[cuts[b] : cuts[b + 1]]] for c in columns])) for b in np.flatnonzero(np.diff(cuts)).tolist()]


def _packed(columns: list[np.ndarray]) -> list[bytes]:
    """The columns' bytes; of a first column of ids, which ascends, the steps."""
    first = arrays.pack_ascending(columns[0]) if columns[0].dtype == np.uint32 else arrays.pack(columns[0].astype(U64))
    return [columns[0].dtype.char.encode() + first, *[arrays.pack(c.astype(U64)) for c in columns[1:]]]


def _unpacked(columns: list[bytes]) -> list[np.ndarray]:
    steps = columns[0][:1] == np.dtype(np.uint32).char.encode()
    return [(arrays.unpack_ascending if steps else arrays.unpack)(columns[0][1:]), *[arrays.unpack(c) for c in columns[1:]]]


def _bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    """The range of each hash among n equal ones: the whole part of hash * n / 2 ** 64."""
    high, low = (hashes >> U64(32)) * U64(n), (hashes & U64(0xFFFFFFFF)) * U64(n)
    return ((high + (low >> U64(32))) >> U64(32)).astype(np.int64)


def _gram_hashes(ids: np.ndarray) -> np.ndarray:
    """A hash of each row of ids."""
    out = np.full(len(ids), U64(ids.shape[1]))
    for column in ids.T:
        out = arrays.mix(out * U64(0x9E3779B97F4A7C15) + arrays.mix(column.astype(U64) + U64(1)))
    return out


def _folded(hashes: np.ndarray, sums: list[np.ndarray], kept: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Distinct hashes, ascending, with the sums of some columns and the first value of others."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    first = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1]) != 0) if len(ranked) else np.empty(0, np.int64)
    added = [np.add.reduceat(x[order], first) if len(first) else x[:0] for x in sums]
    return ranked[first], added, [x[order[first]] for x in kept]


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of each document's words, A-Z in lower case, and of its end; the bounds of the documents (n + 1)."""
    text, offsets = arrays.text_bytes(part.column("text"))
    starts, stops, bounds = arrays.word_spans(text, offsets)
    sizes = np.diff(bounds)
    out = np.full(len(starts) + len(sizes), END)
    out[np.arange(len(starts)) + np.repeat(np.arange(len(sizes)), sizes)] = arrays.word_hashes(text, starts, stops, lower=True)
    return out, bounds + np.arange(len(bounds))


def _sending(batches: Iterator[pa.RecordBatch], grams, buckets: int) -> Iterator[pa.RecordBatch]:
    """`grams` gives hashes, counts and further columns of a part's distinct names; they are folded up to `HELD` and sent."""
    held: list[tuple] = []

    def fold() -> tuple:
        hashes, counts, others = (np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]), list(map(np.concatenate, zip(*[x[2] for x in held]))))
        found, (counts,), others = _folded(hashes, [counts], others)
        return found, counts, others

    def rows():
        found, counts, others = fold()
        pieces = _sent(_bucket(found, buckets), [*(others or [found]), counts], buckets)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in pieces], pa.int32()), pa.array([c for _, c in pieces], pa.list_(pa.binary()))], ["bucket", "columns"])

    for part in arrays.parts(batches, "text", PART):
        held.append(grams(part))
        if sum(len(x[0]) for x in held) > HELD:
            held[:] = [fold()]
            if len(held[0][0]) > HELD // 2:
                yield rows()
    if held:
        yield rows()


def _save(folder: str, name: str, arrays_: list[np.ndarray]) -> str:
    """Arrays in one flat file, their bytes' numbers first, under a name of this attempt's own; a lost or repeated attempt leaves
    a file that no row names."""
    files, root = fs.FileSystem.from_uri(folder)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(path) as sink:
        sink.write(np.array([len(arrays_), *[x.nbytes for x in arrays_]], "<u8").tobytes())
        for x in arrays_:
            sink.write(np.ascontiguousarray(x).tobytes())
    return path


def _coded(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Columns of integers as one code a row: a byte for the 255 commonest rows of the range, whose values come next, then
    places and values of the others."""
    rows = np.stack([x.astype(U64) for x in columns], axis=1)
    if len(columns) == 1:
        other = np.flatnonzero(columns[0] >= 255)
        return [np.minimum(rows[:, 0], U64(255)).astype(np.uint8), np.arange(255, dtype="<u8"), other.astype("<u4"), rows[other, 0]]
    name = arrays.mix(rows @ (arrays.seeded(9, rows.shape[1]) | U64(1)))
    _, first, back, often = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
    common = np.argsort(-often, kind="stable")[:255]
    code = np.full(len(first), 255, np.uint8)
    same = (rows == rows[first][back]).all(axis=1)  # else two rows have one name, and the second is kept in full
    code[common] = np.arange(len(common))
    code = np.where(same, code[back], 255).astype(np.uint8)
    other = np.flatnonzero(code == 255)
    return [code, rows[first[common]].ravel(), other.astype("<u4"), rows[other].ravel()]


def _directory(hashes: np.ndarray, ranges: int) -> list[np.ndarray]:
    """A range's ascending hashes as a directory of cells and 32 bits of each.

    Within a range hash * ranges, modulo 2 ** 64, ascends too. Its top bits are the cell, the next 32 are kept: a hash that
    isn't there is taken for one of some `CELL` others in 1 of 2 ** 32 cases, at every size.
    """
    bits = max(0, (len(hashes) // CELL).bit_length() - 1)
    cells, rest = _cells(hashes, bits, ranges)
    return [np.searchsorted(cells, np.arange((1 << bits) + 1, dtype=U64)).astype("<u4"), rest.astype("<u4")]


def _cells(hashes: np.ndarray, bits: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    place = hashes * U64(ranges)
    cells = place >> U64(64 - bits) if bits else np.zeros(len(place), U64)
    return cells, (place >> U64(32 - bits)) & U64(0xFFFFFFFF)


def _row(part: int, path: str, n: int, counts: np.ndarray | None = None) -> list:
    """A range's own row: its files, its entries, how many have each count of 1 to 4, and the sum of the counts."""
    events = np.empty(0, U64) if counts is None else counts
    return [None, None, part, path, n, *[int((events == i).sum()) for i in range(1, 5)], int(events.sum())]


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.list_(pa.binary()), pa.int32(), pa.string(), *[pa.int64()] * 6]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _NAMES)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The columns of each bucket, joined; a task may hold several buckets, one after another."""
    bucket, held = None, []

    def joined():
        columns = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        return bucket, columns

    for row in rows_of(batches):
        if held and row["bucket"] != bucket:
            yield joined()
        bucket = row["bucket"]
        held.append(_unpacked(row["columns"]))
    if held:
        yield joined()


def _dealt(sent: DataFrame, buckets: int) -> DataFrame:
    return sent.repartitionById(buckets, F.col("bucket"))


def _sent_on(table: DataFrame) -> DataFrame:
    return table.where("path IS NULL").select(F.col("sent_bucket").alias("bucket"), "columns")


@dataclass
class Table:
    """The ranges of one order: the file of each and the entries before it, and numbers over all."""

    ranges: dict[int, tuple[str, int]]
    size: int
    counts: tuple[int, int, int, int]  # entries with a count of 1 to 4
    total: int


def _table(rows: DataFrame) -> Table:
    """One row a range comes to the driver: as many as there are shuffle partitions, whatever the corpus."""
    found = sorted(rows.where("path IS NOT NULL").drop("columns", "sent_bucket").collect(), key=lambda r: r["part"])
    before = np.concatenate(([0], np.cumsum([r["n"] for r in found]))).astype(int)
    counts = tuple(sum(r[f"n{i}"] for r in found) for i in range(1, 5))
    return Table({r["part"]: (r["path"], int(b)) for r, b in zip(found, before)}, int(before[-1]), counts, sum(r["total"] for r in found))


@dataclass
class Model:
    """Where the arrays are, and what belongs to the whole model."""

    folder: str
    order: int
    ranges: int
    words: Table
    grams: dict[int, Table]  # by order
    roots: tuple[int, int, int, int]  # the statistics of the empty context

    @property
    def discounts(self) -> dict[int, np.ndarray]:
        return {k: discounts(t.counts) for k, t in self.grams.items()}


def discounts(counts: tuple[int, int, int, int]) -> np.ndarray:
    """What is taken off counts of 0, 1, 2, and 3 or more, from how many n-grams have counts of 1 to 4.

    Where the estimates are undefined or leave their range, as in very small or repetitive corpora, 0.5, 1 and 1.5.
    """
    n1, n2, n3, n4 = counts
    plain = np.array([0, 0.5, 1.0, 1.5])
    if not (n1 and n2 and n3 and n4):
        return plain
    y = n1 / (n1 + 2 * n2)
    found = np.array([0, *[i - (i + 1) * y * b / a for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]])
    return found if all(0 < found[i] <= i for i in (1, 2, 3)) else plain


class Files:
    """Files of arrays, mapped into memory where the folder is a local one, as a mounted shared folder is."""

    def __init__(self, folder: str):
        self.files, _ = fs.FileSystem.from_uri(folder)
        self.map = functools.lru_cache(_MAPS)(self._map)

    def _map(self, path: str) -> np.ndarray:
        if isinstance(self.files, fs.LocalFileSystem):
            return np.memmap(path, np.uint8, "r")
        with self.files.open_input_file(path) as source:
            return np.frombuffer(source.read_buffer(), np.uint8)

    def arrays(self, path: str) -> list[np.ndarray]:
        """The arrays' bytes."""
        data = self.map(path)
        n = int(data[:8].view("<u8")[0])
        places = np.concatenate(([8 * (n + 1)], 8 * (n + 1) + np.cumsum(data[8 : 8 * (n + 1)].view("<u8").astype(np.int64))))
        return [data[a:b] for a, b in zip(places.tolist(), places.tolist()[1:])]

    def _ranges(self, table: Table, wanted: np.ndarray, ranges: int):
        """The ranges that ascending hashes lie in: a slice of them, the file's arrays, and the entries before."""
        cuts = np.searchsorted(_bucket(wanted, ranges), np.arange(ranges + 1)).tolist()
        for part, (path, base) in table.ranges.items():
            if cuts[part] < cuts[part + 1]:
                yield slice(cuts[part], cuts[part + 1]), self.arrays(path), base

    def words(self, table: Table, hashes: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
        """The id and the count of each word; UNKNOWN and 0 where it isn't there. Looked up in ascending order."""
        wanted, back = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(wanted), UNKNOWN), np.zeros(len(wanted), U64)
        for own, (known, held), base in self._ranges(table, wanted, ranges):
            known = known.view("<u8")
            at = np.searchsorted(known, wanted[own])
            at[at == len(known)] = 0
            hit = np.flatnonzero(known[at] == wanted[own])
            ids[own.start + hit] = at[hit] + base + 1
            counts[own.start + hit] = held.view("<u8")[at[hit]]
        return ids[back], counts[back]

    def grams(self, table: Table, hashes: np.ndarray, ranges: int, columns: int) -> list[np.ndarray]:
        """The first columns of each n-gram, 0 where it isn't there. Looked up in ascending order."""
        wanted, back = np.unique(hashes, return_inverse=True)
        out = [np.zeros(len(wanted), np.float64) for _ in range(columns)]
        for own, found, _ in self._ranges(table, wanted, ranges):
            directory, rest, code, common, places, others = (x.view(k) for x, k in zip(found, ("<u4", "<u4", "u1", "<u8", "<u4", "<u8")))
            cells, sought = _cells(wanted[own], len(directory).bit_length() - 1 if len(directory) > 2 else 0, ranges)
            low, high = directory[cells].astype(np.int64), directory[cells + U64(1)].astype(np.int64)
            ends = high.copy()
            while (open_ := low < high).any():
                middle = (low + high) >> 1
                less = (rest[np.minimum(middle, len(rest) - 1)] < sought) & open_
                low, high = np.where(less, middle + 1, low), np.where(open_ & ~less, middle, high)
            hit = np.flatnonzero(low < ends)
            hit = hit[rest[low[hit]] == sought[hit]]
            at = low[hit]
            kind = code[at]
            common, others = common.reshape(-1, columns), others.reshape(-1, columns)
            values = common[np.minimum(kind, len(common) - 1)] if len(common) else np.zeros((len(at), columns))
            odd = np.flatnonzero(kind == 255)
            values[odd] = others[np.searchsorted(places, at[odd])]
            for column, x in zip(out, values.T):
                column[own.start + hit] = x
        return [x[back] for x in out]


def _windows(ids: np.ndarray, bounds: np.ndarray, order: int) -> np.ndarray:
    """For each token the `order` ids up to it, with start symbols in front of the document's first."""
    at = np.arange(len(ids)) - np.repeat(bounds[:-1], np.diff(bounds))
    out = np.empty((len(ids), order), np.uint32)
    for back in range(order):
        column = out[:, order - 1 - back]
        column[:] = np.where(at >= back, np.roll(ids, back), START)
    return out


def fit(docs: DataFrame, learn: Column | None = None, order: int = ORDER) -> Model:
    """Count the model of `docs` (doc_id and text), or of those of which `learn`, a condition on doc_id, is true.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, with A-Z in lower case; one end is a token after each document, also
    after an empty or null text. No documents give a model in which every word is unknown. At most 2 ** 32 - 2 different words.
    """
    if order < 2:
        raise ValueError("the model needs an order of 2 at least")
    spark = docs.sparkSession
    ship_package(spark)
    folder, buckets = new_folder(spark, "model"), partitions(spark)
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    some = docs.where(learn) if learn is not None else docs
    texts = some.select(F.col("text").cast("string").alias("text"))

    def count_words(batches):
        def grams(part):
            hashes, counts = np.unique(_tokens(part)[0], return_counts=True)
            return hashes, counts.astype(U64), []

        return _sending(batches, grams, buckets)

    def save_words(batches):
        for bucket, (hashes, counts) in _by_bucket(batches):
            hashes, (counts,), _ = _folded(hashes, [counts], [])
            path = _save(folder, f"words-{bucket:06d}", [hashes.astype("<u8"), counts.astype("<u8")])
            yield _batch([_row(bucket, path, len(hashes), counts)])

    sent = texts.mapInArrow(arrays.released(count_words), SENT)
    with scratch_table(_dealt(sent, buckets).mapInArrow(arrays.released(save_words), TABLE), "words") as saved:
        words = _table(saved)
    if words.size >= UNKNOWN - 1:
        raise ValueError(f"{words.size} different words are too many")

    def count_grams(batches):
        source = Files(folder)

        def grams(part):
            hashes, bounds = _tokens(part)
            ids = _windows(source.words(words, hashes, buckets)[0], bounds, order)
            names = _gram_hashes(ids)
            found, (counts,), columns = _folded(names, [np.ones(len(names), U64)], list(ids.T))
            return found, counts, columns

        return _sending(batches, grams, buckets)

    sent = texts.mapInArrow(arrays.released(count_grams), SENT)
    tables, before = {}, contextlib.ExitStack()
    for k in range(order, 0, -1):
        with before:
            now = contextlib.ExitStack()
            saved = now.enter_context(scratch_table(_dealt(sent, buckets).mapInArrow(arrays.released(_saver(folder, k, order, buckets)), TABLE), f"grams{k}"))
        before, tables[k], sent = now, _table(saved), _sent_on(saved)
    with before:
        roots = [[int(arrays.unpack(bytes(x)).sum()) for x in r["columns"]] for r in sent.select("columns").toLocalIterator()]  # a row a range
    return Model(folder, order, buckets, words, tables, tuple(sum(x) for x in zip([0] * STATS, *roots)))


@contextlib.contextmanager
def scratch_table(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """A frame written to the shared folder and read back for the length of a block; its shuffle's files go with the write."""
    with shuffles_dropped(df.sparkSession):
        scratched = scratch(df, label)
        table = scratched.__enter__()
    try:
        yield table
    finally:
        scratched.__exit__(None, None, None)


def _saver(folder: str, k: int, order: int, buckets: int):
    """The task of a range of n-grams of order k: fold, save, and send on what order k - 1 needs.

    Comes in as k columns of ids, then the count, and below the highest order the statistics as a context.
    """

    def save(batches):
        for bucket, columns in _by_bucket(batches):
            ids = np.stack([x.astype(np.uint32) for x in columns[:k]], axis=1)
            hashes, sums, kept = _folded(_gram_hashes(ids), columns[k:], list(ids.T))
            ids, counts = np.stack(kept, axis=1), sums[0]
            short = (ids[:, 0] == START) & (ids[:, 1] == START) if k > 1 else np.zeros(len(ids), bool)  # a part of a lower order
            event = ~short & (counts > 0)
            path = _save(folder, f"grams{k}-{bucket:06d}", [*_directory(hashes, buckets), *_coded([np.where(event, counts, U64(0)), *sums[1:]])])
            rows = [_row(bucket, path, len(hashes), counts[event])]
            use = np.flatnonzero(counts > 0)
            suffixes = _gram_hashes(ids[use, 1:]) if k > 1 else np.empty(0, U64)
            added = np.where(short[use], counts[use], U64(1))
            events = np.flatnonzero(event)
            own = counts[events]
            stats = [own, *[x.astype(U64) for x in (own == 1, own == 2, own > 2)]]
            if k == 1:
                rows.append([0, [arrays.pack(np.array([int(x.sum())], U64)) for x in stats], *[None] * 8])
            else:
                contexts = _gram_hashes(ids[events, :-1])
                none = [np.zeros(len(use), U64)] * STATS
                names = np.concatenate([suffixes, contexts])
                sums = [np.concatenate(x) for x in zip([added, *none], [np.zeros(len(events), U64), *stats])]
                lower = [np.concatenate([ids[use, i + 1], ids[events, i]]) for i in range(k - 1)]
                names, sums, lower = _folded(names, sums, lower)
                rows += [[b, c, *[None] * 8] for b, c in _sent(_bucket(names, buckets), [*lower, *sums], buckets)]
            yield _batch(rows)

    return save


def log_probabilities(files: Files, model: Model, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token its training count and its log10 probability after the tokens before it."""
    ids, counts = files.words(model.words, hashes, model.ranges)
    windows = _windows(ids, bounds, model.order)
    at = np.arange(len(ids)) - np.repeat(bounds[:-1], np.diff(bounds))
    p = np.full(len(ids), 1 / (model.words.size + 1))
    context = [np.full(len(ids), x, np.float64) for x in model.roots]  # the empty one
    for k in range(1, model.order + 1):
        off = model.discounts[k]
        columns = 1 + (STATS if k < model.order else 0)
        reach = at >= k - 2  # at most one start symbol
        names = _gram_hashes(windows[:, model.order - k :])
        count, *own = files.grams(model.grams[k], names, model.ranges, columns)
        total = context[0]
        known = reach & (total > 0)
        left = (off[1] * context[1] + off[2] * context[2] + off[3] * context[3])[known] / total[known]
        p[known] = np.maximum(count[known] - off[np.minimum(count[known], 3).astype(int)], 0) / total[known] + left * p[known]
        if k < model.order:  # the n-gram up to the token before is the context of the next order
            starts = np.full((1, k), START, np.uint32)
            _, *first = files.grams(model.grams[k], _gram_hashes(starts), model.ranges, columns)
            begins = at == 0
            context = [np.where(begins, f[0], np.roll(x, 1)).astype(np.float64) for x, f in zip(own, first)]
    return counts, np.log10(p)


def lm_scores(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of `docs` and `n_tokens`, `n_known`, `base_score`, `score` and `perplexity`; earlier ones of these names are replaced.

    `score` is the model's log10 probability of the text with its end, `perplexity` 10 ** (-score / n_tokens). `base_score` is that of
    single words, each with its count plus a half. `n_known` counts tokens that training documents have. A null text is
    empty: its end alone. Rows that repeat an id are scored one by one. No rows give no rows.
    """
    added = {"n_tokens": T.LongType(), "n_known": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType(), "perplexity": T.DoubleType()}
    ship_package(docs.sparkSession)
    docs = docs.drop(*added).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in added.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(model.folder)
        tokens, words = model.words.total, model.words.size
        for part in arrays.parts(batches, "text", PART):
            hashes, bounds = _tokens(part)
            counts, logs = log_probabilities(files, model, hashes, bounds)
            base = np.log10((counts + 0.5) / (tokens + 0.5 * (words + 1)))
            sizes, first = np.diff(bounds), bounds[:-1]
            known, base, score = (np.add.reduceat(x, first) for x in ((counts > 0).astype(np.int64), base, logs))
            columns = [pa.array(sizes, pa.int64()), pa.array(known), pa.array(base), pa.array(score), pa.array(10 ** (-score / sizes))]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *added])

    return docs.mapInArrow(arrays.released(run), schema)
