"""Fill-in-middle examples by a piece table.

A document's text is an immutable buffer, the sentinels another. A document is a row of descriptors (buffer, start, stop), first
one for its whole text. Cutting at a place splits a descriptor; an arrangement is a permutation of descriptors with those of sentinels put
between; its inverse brings the pieces of an output back into the order of the text. Hashes and copies read the buffers
through the descriptors, piece by piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.llm import arrays
from surveyloom.session import ship_package

PART = 4 << 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
#: For each form, pieces (0 prefix, 1 middle, 2 suffix) and the sentinel before each, in order of output.
FORMS = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}


@dataclass(frozen=True)
class Piece:
    """A stretch of one buffer."""

    buffer: memoryview
    start: int
    stop: int

    def split(self, at: int) -> tuple[Piece, Piece]:
        return Piece(self.buffer, self.start, at), Piece(self.buffer, at, self.stop)

    def view(self) -> memoryview:
        return self.buffer[self.start : self.stop]


def cut(pieces: list[Piece], at: int) -> list[Piece]:
    """The pieces with the one that spans the buffer's place `at` split there; at a piece's end the second half is empty."""
    out = []
    for i, piece in enumerate(pieces):
        if piece.start <= at <= piece.stop:
            return [*out, *piece.split(at), *pieces[i + 1 :]]
        out.append(piece)
    raise ValueError(f"no piece spans {at}")


def arranged(pieces: list[Piece], form: str) -> list[Piece]:
    """Prefix, middle and suffix in the order of the form, each after its sentinel."""
    out = []
    for sentinel, which in FORMS[form]:
        out += [Piece(memoryview(sentinel), 0, len(sentinel)), pieces[which]]
    return out


def restored(output: Piece, form: str) -> list[Piece]:
    """The pieces of an output in the order of the text, found by its sentinels alone.

    A text with a sentinel inside is never cut, and no sentinel can begin in one piece and end in another, so each
    stands in the output once.
    """
    data = output.view().tobytes()
    marks, at = [], 0
    for sentinel, _ in FORMS[form]:
        at = data.index(sentinel, at)
        marks.append(at)
        at += len(sentinel)
    own = [None, None, None]
    for (sentinel, which), begin, end in zip(FORMS[form], marks, [*marks[1:], len(data)]):
        own[which] = Piece(output.buffer, output.start + begin + len(sentinel), output.start + end)
    return own


def digest(pieces: list[Piece]) -> str:
    out = hashlib.sha256()
    for piece in pieces:
        out.update(piece.view())
    return out.hexdigest()


def _joined(rows: list[list[Piece]]) -> pa.Array:
    """The text of each row of pieces, as one copy into an Arrow buffer."""
    sizes = np.array([sum(p.stop - p.start for p in row) for row in rows], np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    data = b"".join(p.view() for row in rows for p in row)
    return pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())


def draws(doc_id: Column, seed: int, n: int = 4) -> list[Column]:
    """The first `n` groups of eight hex digits of the sha256 of `seed:doc_id`, as integers. A null id is empty text."""
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(hexed, 8 * i + 1, 8), 16, 10).cast("long").alias(f"_h{i + 1}") for i in range(n)]


def _packed(df: DataFrame, columns: list[str]) -> Column:
    """Columns of any name in one struct, `own`."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in columns]).alias("own")


def _chars(text: np.ndarray) -> np.ndarray:
    """How many code points begin before each byte (n + 1)."""
    out = np.zeros(len(text) + 1, np.int64)
    np.cumsum((text & 0xC0) != 0x80, out=out[1:])
    return out


ADDED = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "output": T.StringType(), "output_sha256": T.StringType()}


def fill_in_middle(docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """The columns of `docs` but `text`, and n (lines), form, prefix_chars, middle_chars, output and output_sha256.

    A text is cut twice between lines, at places drawn from the doc_id, into prefix, middle and suffix. `percent` of the
    documents become `psm` or, `spm_percent` of these, `spm`; the others, empty or null texts, and texts with a sentinel in
    them stay as they are, `plain`, with null prefix_chars and middle_chars (in code points). A null doc_id draws as an empty one;
    rows that repeat a doc_id draw alike. Earlier columns of these names are replaced. No rows give no rows.
    """
    ship_package(docs.sparkSession)
    docs = docs.drop(*ADDED)
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(_packed(docs, rest), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *draws(F.col("doc_id"), seed))
    schema = T.StructType([rows.schema["own"], *[T.StructField(n, k) for n, k in ADDED.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.parts(batches, "text", PART):
            text, offsets = arrays.text_bytes(part.column("text"))
            buffer = memoryview(np.ascontiguousarray(text))
            chars = _chars(text)
            breaks = np.flatnonzero(text == ord("\n")) + 1
            within = np.searchsorted(breaks, offsets, "right")  # a line that ends at a document's end is its own
            h = [part.column(f"_h{i}").to_numpy() for i in range(1, 5)]
            out = [], [], [], [], [], []
            for i, (start, stop) in enumerate(zip(offsets.tolist(), offsets.tolist()[1:])):
                ends = breaks[within[i] : within[i + 1]]
                if stop > start and (not len(ends) or ends[-1] != stop):
                    ends = np.append(ends, stop)
                n = len(ends)
                pieces = [Piece(buffer, start, stop)]
                form, prefix, middle = "plain", None, None
                own = bytes(buffer[start:stop])
                if n and h[2][i] % 100 < percent and not any(s in own for s in SENTINELS):
                    first, second = sorted((int(h[0][i] % (n + 1)), int(h[1][i] % (n + 1))))
                    places = [start, *ends.tolist()]
                    form = "spm" if h[3][i] % 100 < spm_percent else "psm"
                    pieces = cut(cut(pieces, places[second]), places[first])
                    prefix, middle = (int(chars[p.stop] - chars[p.start]) for p in pieces[:2])
                    pieces = arranged(pieces, form)
                for column, value in zip(out, (n, form, prefix, middle, pieces, digest(pieces))):
                    column.append(value)
            columns = [pa.array(c, k) for c, k in zip(out[:4], (pa.int64(), pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([part.column("own"), *columns, _joined(out[4]), pa.array(out[5], pa.string())], ["own", *ADDED])

    made = rows.mapInArrow(arrays.released(run), schema)
    return made.select(*[F.col("own").getField(c).alias(c) for c in rest], *ADDED)


def restore(outputs: DataFrame) -> DataFrame:
    """The columns of `outputs` and `text`, rebuilt from `output` and `form` alone, and `restored_sha256`.

    A null output is an empty one. Earlier columns of these names are replaced.
    """
    ship_package(outputs.sparkSession)
    outputs = outputs.drop("text", "restored_sha256")
    rows = outputs.select(_packed(outputs, outputs.columns), F.coalesce(F.col("output").cast("string"), F.lit("")).alias("output"), "form")
    schema = T.StructType([rows.schema["own"], T.StructField("text", T.StringType()), T.StructField("restored_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.parts(batches, "output", PART):
            data, offsets = arrays.text_bytes(part.column("output"))
            buffer, places = memoryview(np.ascontiguousarray(data)), offsets.tolist()
            whole = [Piece(buffer, a, b) for a, b in zip(places, places[1:])]
            pieces = [restored(p, f) if f in FORMS else [p] for p, f in zip(whole, part.column("form").to_pylist())]
            hashes = pa.array([digest(row) for row in pieces], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("own"), _joined(pieces), hashes], ["own", "text", "restored_sha256"])

    made = rows.mapInArrow(arrays.released(run), schema)
    return made.select(*[F.col("own").getField(c).alias(c) for c in outputs.columns], "text", "restored_sha256")
