"""Documents as compressed chunks, and counts or minima of names over all of them.

Three operators ask of each name in a document (a shingle, a string, a symbol) how often or in which
document it occurs first. Rows of single names would be far larger than the text, so a chunk of documents sends its
distinct names, sorted, as packed differences: one row for each chunk and range of names. What is frequent inside a chunk
is folded before it is sent; a name that a third of all documents holds costs one entry a chunk. The replies are arrays
in the order of the sent names, so they carry no names, and meet the text by chunk, in a bucketed table that isn't
shuffled again.
"""

from __future__ import annotations

import contextlib
import hashlib
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm import arrays
from surveyloom.session import new_folder, ship_package

CHUNK_BYTES = 8 << 20
CHUNK_DOCUMENTS = 60_000
NO_ID = np.iinfo(np.int64).max
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the writes inside go when each write has ended, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, label: str) -> DataFrame:
    """A frame that only feeds one later step, written to the shared folder and read back."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, label: str, key: str) -> DataFrame:
    """A frame written to the shared folder in buckets of the key, so that joins on it need no shuffle."""
    spark = df.sparkSession
    table = f"{label}_{uuid.uuid4().hex[:12]}"
    with shuffles_dropped(spark):
        df.write.format("parquet").option("path", new_folder(spark, label)).bucketBy(partitions(spark), key).saveAsTable(table)
    return spark.table(table)


@dataclass
class Chunk:
    """Some documents, by ascending doc_id; those without one come last, as NO_ID."""

    id: int
    ids: np.ndarray
    offsets: np.ndarray
    text: np.ndarray
    digests: np.ndarray  # two 64-bit halves a document

    def __len__(self) -> int:
        return len(self.ids)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        """The document of each byte position (ascending)."""
        return np.repeat(np.arange(len(self)), np.diff(np.searchsorted(positions, self.offsets)))


SCHEMA = "chunk_id long, n_docs long, n_bytes long, ids binary, lengths binary, digests binary, text binary"


def _chunk_row(number: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches)
    ids = table["doc_id"].combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(ids, kind="stable")
    text, offsets = arrays.text_bytes(table["text"].combine_chunks().cast(pa.large_string()).take(pa.array(order)))
    view = memoryview(np.ascontiguousarray(text))
    bounds = offsets.tolist()
    digests = b"".join(hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(bounds, bounds[1:]))
    row = (
        [TaskContext.get().partitionId() * (1 << 24) + number],
        [len(ids)],
        [len(text)],
        [arrays.pack_ascending(arrays.signed_to_unsigned(ids[order]))],
        [arrays.pack(np.diff(offsets).astype(arrays.U64))],
        [digests],
        [zstandard.ZstdCompressor(level=3).compress(view)],
    )
    kinds = [pa.int64()] * 3 + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], SCHEMA.replace(",", "").split()[::2])


def _chunk_rows(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    held, size, rows, number = [], 0, 0, 0
    for part in arrays.parts(batches, "text", limit // 4):
        for at in range(0, part.num_rows, CHUNK_DOCUMENTS // 4):
            piece = part.slice(at, CHUNK_DOCUMENTS // 4)
            n = len(arrays.text_bytes(piece.column("text"))[0])
            if held and (size + n > limit or rows + piece.num_rows > CHUNK_DOCUMENTS):
                yield _chunk_row(number, held)
                held, size, rows, number = [], 0, 0, number + 1
            held, size, rows = [*held, piece], size + n, rows + piece.num_rows
    if held:
        yield _chunk_row(number, held)


def store(docs: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """The documents' ids and texts as a bucketed table of chunks of some `size` bytes of text."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bucketed(rows.mapInArrow(arrays.released(lambda batches: _chunk_rows(batches, size)), SCHEMA), "chunks", "chunk_id")


def chunk_of(row: dict) -> Chunk:
    lengths = arrays.unpack(row["lengths"]).astype(np.int64)
    text = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"]), np.uint8) if row["text"] else np.empty(0, np.uint8)
    return Chunk(
        row["chunk_id"],
        arrays.unsigned_to_signed(arrays.unpack_ascending(row["ids"])),
        np.concatenate(([0], np.cumsum(lengths))).astype(np.int64),
        text,
        np.frombuffer(row["digests"], arrays.U64).reshape(-1, 2),
    )


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time, so that one chunk is in memory."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


@dataclass
class Asked:
    """Ascending distinct names below 2 ** bits, what is known of each, and maybe a second half of each name."""

    names: np.ndarray
    values: np.ndarray
    checks: np.ndarray | None = None


ASK_SCHEMA = "bucket int, chunk_id long, names binary, vals binary, checks binary"
REPLY_SCHEMA = "chunk_id long, bucket int, reply binary"


def _edges(bits: int, n: int) -> np.ndarray:
    return np.array([-(-b * (1 << bits) // n) for b in range(1, n)], arrays.U64)


def exchange(
    rows: DataFrame, ask: Callable[[dict], Asked], bits: int, combine: str, reply: str
) -> DataFrame:
    """Fold each name over all chunks, and answer every chunk.

    `combine` is "sum" or "min", over the chunks that ask. `reply` is "value", or "count" for a sum cut at 255 in a byte,
    or "below" for whether the minimum is below the chunk's own value. Returns chunk_id and `replies`, an array that
    `answer` reads.
    """
    buckets = partitions(rows.sparkSession)

    def asking(batches):
        edges = _edges(bits, buckets)
        for row in rows_of(batches):
            asked = ask(row)
            cuts = np.concatenate(([0], np.searchsorted(asked.names, edges), [len(asked.names)]))
            full = np.flatnonzero(np.diff(cuts))
            out = [[], [], [], [], []]
            for b in full.tolist():
                part = slice(cuts[b], cuts[b + 1])
                for column, value in zip(
                    out,
                    (
                        b,
                        row["chunk_id"],
                        arrays.pack_ascending(asked.names[part]),
                        arrays.pack(asked.values[part]),
                        None if asked.checks is None else arrays.pack(asked.checks[part]),
                    ),
                ):
                    column.append(value)
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], ASK_SCHEMA.replace(",", "").split()[::2])

    def answering(batches):
        held = defaultdict(list)
        for row in rows_of(batches):
            held[row["bucket"]].append((row["chunk_id"], row["names"], row["vals"], row["checks"]))
        for bucket in sorted(held):
            yield _answers(bucket, held.pop(bucket), combine, reply)

    replies = rows.mapInArrow(arrays.released(asking), ASK_SCHEMA).repartitionById(buckets, F.col("bucket")).mapInArrow(arrays.released(answering), REPLY_SCHEMA)
    return replies.groupBy("chunk_id").agg(F.sort_array(F.collect_list(F.struct("bucket", "reply"))).alias("replies"))


def _answers(bucket: int, asked: list[tuple], combine: str, reply: str) -> pa.RecordBatch:
    names = [arrays.unpack_ascending(x[1]) for x in asked]
    sizes = np.array([len(x) for x in names])
    names = np.concatenate(names)
    values = np.concatenate([arrays.unpack(x[2]) for x in asked])
    if asked[0][3] is None:
        order = np.argsort(names, kind="stable")
        fresh = np.diff(names[order], prepend=~names[order[0]]) != 0
    else:
        checks = np.concatenate([arrays.unpack(x[3]) for x in asked])
        order = np.lexsort((checks, names))
        fresh = (np.diff(names[order], prepend=~names[order[0]]) != 0) | (np.diff(checks[order], prepend=U0) != 0)
        fresh[0] = True
        del checks
    del names
    first = np.flatnonzero(fresh)
    ranked = values[order]
    folded = np.repeat((np.add if combine == "sum" else np.minimum).reduceat(ranked, first), np.diff(np.append(first, len(order))))
    if reply == "count":
        folded = np.minimum(folded, 255)
    elif reply == "below":
        folded = folded < ranked
    out = np.empty(len(order), arrays.U64 if reply == "value" else np.uint8)
    out[order] = folded
    ends = np.cumsum(sizes)
    pieces = [out[e - n : e] for e, n in zip(ends, sizes)]
    coded = [arrays.pack(x) if reply == "value" else zstandard.ZstdCompressor(level=1).compress(x.tobytes()) for x in pieces]
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in asked], pa.int64()), pa.array([bucket] * len(asked), pa.int32()), pa.array(coded, pa.binary())],
        ["chunk_id", "bucket", "reply"],
    )


U0 = arrays.U64(0)


def answer(replies: list[dict] | None, reply: str) -> np.ndarray:
    """The replies to a chunk, in the order of the names it sent."""
    if not replies:
        return np.empty(0, arrays.U64 if reply == "value" else np.uint8)
    if reply == "value":
        return np.concatenate([arrays.unpack(x["reply"]) for x in replies])
    return np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(x["reply"]), np.uint8) for x in replies])


def name_bits(total: int) -> int:
    """Bits for names that are only candidates: some 14 more than it takes to count them, 48 at most."""
    return min(48, 14 + max(1, int(total)).bit_length())


def counted(names: np.ndarray, docs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct names, cut to `bits`, and in how many documents of the chunk each occurs."""
    pairs = np.unique((names >> arrays.U64(64 - bits)) << arrays.U64(16) | docs.astype(arrays.U64))
    cut = pairs >> arrays.U64(16)
    first = np.flatnonzero(np.diff(cut, prepend=~cut[:1]) != 0) if len(cut) else np.empty(0, np.int64)
    return cut[first], np.diff(np.append(first, len(cut))).astype(arrays.U64)


def members(names: np.ndarray, some: np.ndarray, bits: int) -> np.ndarray:
    """Which of the names, cut to `bits`, are among some ascending ones."""
    cut = names >> arrays.U64(64 - bits)
    out = np.zeros(len(cut), bool)
    if not len(some):
        return out
    width = min(bits, max(10, len(some).bit_length() + 3))  # a first look by the top bits
    seen = np.zeros(1 << width, bool)
    seen[some >> arrays.U64(bits - width)] = True
    maybe = np.flatnonzero(seen[cut >> arrays.U64(bits - width)])
    at = np.minimum(np.searchsorted(some, cut[maybe]), len(some) - 1)
    out[maybe] = some[at] == cut[maybe]
    return out


def copies(chunks: DataFrame) -> DataFrame:
    """For each chunk a byte a document, in `copied`: 1 if a document with a smaller doc_id has the same text.

    Between equal texts of one doc_id, none is a copy. Digests are of 128 bits.
    """

    def ask(row):
        ids = arrays.unpack_ascending(row["ids"])
        digests = np.frombuffer(row["digests"], arrays.U64).reshape(-1, 2)
        first, _ = first_of(digests)
        return Asked(digests[first, 0], ids[first], digests[first, 1])

    def mark(batches):
        for row in rows_of(batches):
            ids = arrays.unpack_ascending(row["ids"])
            digests = np.frombuffer(row["digests"], arrays.U64).reshape(-1, 2)
            first, group = first_of(digests)
            below = answer(row["replies"], "below").astype(bool)
            copied = below[group] | (ids > ids[first][group]) if len(ids) else np.empty(0, bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["chunk_id"]], pa.int64()), pa.array([copied.astype(np.uint8).tobytes()], pa.binary())], ["chunk_id", "copied"]
            )

    meta = chunks.select("chunk_id", "ids", "digests")
    replies = exchange(meta, ask, 64, "min", "below")
    return written(meta.join(replies, "chunk_id", "left").mapInArrow(arrays.released(mark), "chunk_id long, copied binary"), "copies")


def first_of(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first document of each distinct digest, by ascending digest, and the number of each document's digest."""
    order = np.lexsort((np.arange(len(digests)), digests[:, 1], digests[:, 0]))
    ranked = digests[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return order[fresh], group
