"""Token ids as flat binary files with 64-bit document offsets.

Every range of doc_ids becomes one shard of three files: ids of tokens (unsigned 16-bit integers where the vocabulary
allows it, else 32-bit, little-endian, one document after another), offsets (64-bit, n + 1, of tokens within the shard)
and doc_ids (64-bit). The shards' places in the whole are prefix sums over one row a shard. A task writes under a
name of its own and reports it; a lost or repeated attempt leaves files that no row names.
"""

from __future__ import annotations

import itertools
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveyloom.llm import arrays
from surveyloom.llm.chunks import partitions, written
from surveyloom.session import new_folder, ship_package

END_ID = 1
NO_ID = np.iinfo(np.int64).max
CACHED_UNITS = 250_000
PIECE = 2 << 20  # bytes of text that are encoded at once
GROUP = 16  # runs of letters that are encoded as one text


#: A run of the letters that `_units` knows. Lower case leaves each of them one letter.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch

#: What a byte can be: part of a letter, ASCII punctuation, or anything else.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_MARK = np.zeros(256, bool)
_MARK[[x for x in range(0x21, 0x7F) if not chr(x).isalnum()]] = True


def _units(text: np.ndarray, starts: np.ndarray, stops: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words cut where a letter meets ASCII punctuation: the bytes, n + 1 places, and the word of each unit.

    Letters are A-Z, a-z and U+00C0-U+00FF without the two signs; they come out in lower case. Words with any other byte,
    or with the beginning of a special token, stay whole and unchanged. A tokenizer that takes runs of letters, single digits and runs of punctuation apart, and
    lowers the case, reads the units as it reads the words.
    """
    flat = text[~arrays.SPACE[text]]
    places = np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int64)
    after = np.zeros(len(flat), bool)  # the second byte of a letter with an accent
    after[1:] = (flat[:-1] == 0xC3) & (flat[1:] >= 0x80) & (flat[1:] <= 0xBF) & (flat[1:] != 0x97) & (flat[1:] != 0xB7)
    lead = np.zeros(len(flat), bool)
    lead[:-1] = after[1:]
    letter = _LETTER[flat] | after | lead
    odd = ~(letter | _MARK[flat])
    plain = np.ones(len(starts), bool)
    for begin in {x[:2] for x in special}:
        at = flat == begin[0]
        if len(begin) > 1:
            at[:-1] &= flat[1:] == begin[1]
        odd |= at
    plain[np.searchsorted(places, np.flatnonzero(odd), "right") - 1] = False
    byte_plain = np.repeat(plain, stops - starts)
    upper = byte_plain & (_LETTER[flat] & (flat < 0x61) | after & (flat <= 0x9E))
    flat = flat + (upper * np.uint8(0x20))
    cut = np.zeros(len(flat), bool)
    cut[1:] = letter[:-1] & ~letter[1:] & byte_plain[1:]
    cut[places[:-1]] = True
    begins = np.flatnonzero(cut)
    word = np.searchsorted(places, begins, "right") - 1
    return flat, np.append(begins, len(flat)).astype(np.int64), word


class Encoder:
    """A tokenizer whose tokens never span ASCII white space, applied to each distinct unit of a word once.

    Splitting at 0x20 and 0x09-0x0D is exact for it: white space is dropped, no pattern crosses it, and neither
    composition nor lower case reaches over it. For the cuts inside words see `_units`.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.special = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)  # ids with which a run of letters ends
        if suffix:
            self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self._forget()

    def _forget(self):
        self.known: dict[str, int] = {}
        self.sizes = np.empty(0, np.int64)  # of known units, in the order of their numbers
        self.ids = np.empty(0, self.dtype)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts one after another, and how many each has."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), self.dtype, int(sizes.sum())), sizes

    def _encoded_runs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As `_encoded` for runs of letters: many are one text with blanks between them, as a text costs more than a short run.

        The ids that end a run tell them apart. If there are more or fewer than runs, the tokenizer cuts runs in another way, and each is encoded alone.
        """
        ids, _ = self._encoded([" ".join(runs[i : i + GROUP]) for i in range(0, len(runs), GROUP)])
        sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        return (ids, sizes) if len(sizes) == len(runs) and sizes.sum() == len(ids) else self._encoded(runs)

    def _numbers(self, units: list[str]) -> np.ndarray:
        """The units' numbers; new ones are encoded."""
        if len(self.known) > CACHED_UNITS:
            self._forget()
        out = np.fromiter(map(self.known.get, units, itertools.repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(out < 0)
        if len(new):
            is_run = np.fromiter((_LETTERS(units[i]) is not None for i in new), bool, len(new))
            new = np.concatenate([new[is_run], new[~is_run]])
            out[new] = np.arange(len(self.known), len(self.known) + len(new))
            fresh, n = [units[i] for i in new], int(is_run.sum())
            self.known.update(zip(fresh, out[new].tolist()))
            found = [encoded(some) for encoded, some in ((self._encoded_runs, fresh[:n]), (self._encoded, fresh[n:])) if some]
            self.sizes = np.concatenate([self.sizes, *(sizes for _, sizes in found)])
            self.ids = np.concatenate([self.ids, *(ids for ids, _ in found)])
        return out

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by `end_id`, and their numbers."""
        text, offsets = arrays.text_bytes(texts)
        starts, stops, bounds = arrays.word_spans(text, offsets)
        if len(starts):
            flat, places, word = _units(text, starts, stops, self.special)
            column = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(flat))
            coded = column.dictionary_encode()
            unit = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            sizes, first = self.sizes[unit], (np.cumsum(self.sizes) - self.sizes)[unit]
            tokens = self.ids[arrays.expand(first, first + sizes)]
            before = np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(word, bounds)]
        else:
            tokens, before = np.empty(0, self.dtype), np.zeros(len(texts) + 1, np.int64)
        counts = np.diff(before)
        out = np.full(len(tokens) + len(texts), end_id, self.dtype)
        out[np.arange(len(tokens)) + np.repeat(np.arange(len(texts)), counts)] = tokens
        return out, counts + 1


@arrays.stage_cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


SHARD = "part int, tokens string, offsets string, doc_ids string, width int, n_docs long, n_tokens long"


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Write the documents' token ids by ascending doc_id; return one row a shard, with `base`, the ids before it.

    Takes doc_id and text. A null text is empty and gives the end id alone; null doc_ids come last; rows that repeat a
    doc_id are all written, by their text. No rows give no shard. `folder` must be one that driver and executors share (default: a new one
    below spark.checkpoint.dir).
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or new_folder(spark, "tokens")
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.release(_encoder)  # what the stages before have left in this worker
        files, root = fs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        stem = f"{root}/{part:06d}-{uuid.uuid4().hex}"
        encoder = _encoder(tokenizer)
        counts, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        with files.open_output_stream(f"{stem}.tokens") as sink:
            for piece in arrays.parts(batches, "text", PIECE):
                tokens, sizes = encoder.encode(piece.column("text"), end_id)
                sink.write(tokens.tobytes())
                counts.append(sizes)
                ids.append(pc.fill_null(piece.column("doc_id"), NO_ID).to_numpy(zero_copy_only=False))
        counts, ids = np.concatenate(counts), np.concatenate(ids)
        offsets = np.concatenate(([0], np.cumsum(counts)))
        for name, values in (("offsets", offsets), ("doc_ids", ids)):
            with files.open_output_stream(f"{stem}.{name}") as sink:
                sink.write(values.astype("<i8").tobytes())
        arrays.release(_encoder)
        if len(ids):
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "part": part,
                        **{name: f"{stem}.{name}" for name in ("tokens", "offsets", "doc_ids")},
                        "width": encoder.dtype.itemsize,
                        "n_docs": len(ids),
                        "n_tokens": int(offsets[-1]),
                    }
                ],
                pa.schema([("part", pa.int32()), ("tokens", pa.string()), ("offsets", pa.string()), ("doc_ids", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
            )

    order = [F.col("doc_id").asc_nulls_last(), F.col("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = rows.repartitionByRange(partitions(spark), order[0]).sortWithinPartitions(*order)
    shards = written(ranged.mapInArrow(write, SHARD), "shards")
    before = W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row a shard
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))).withColumn("root", F.lit(folder))


def _open(files: fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A flat file as an array: memory-mapped where it is local."""
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    with files.open_input_file(path) as source:
        return np.frombuffer(source.read_buffer(), dtype)


def read_tokens(shards: DataFrame) -> DataFrame:
    """One row a document out of the files: doc_id, start (ids before it), n_tokens, ids_crc32.

    The checksum is over the ids as little-endian unsigned 32-bit integers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                files, _ = fs.FileSystem.from_uri(shard["root"])
                tokens = _open(files, shard["tokens"], f"<u{shard['width']}")
                offsets = np.array(_open(files, shard["offsets"], "<i8"))
                ids = np.array(_open(files, shard["doc_ids"], "<i8"))
                sums = np.empty(len(ids), np.int64)
                for at, (a, b) in enumerate(zip(offsets.tolist(), offsets.tolist()[1:])):
                    sums[at] = zlib.crc32(tokens[a:b].astype("<u4").tobytes())
                columns = [pa.array(ids, mask=ids == NO_ID), pa.array(offsets[:-1] + shard["base"]), pa.array(np.diff(offsets)), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    dealt = shards.repartitionById(partitions(shards.sparkSession), F.col("part"))
    return dealt.mapInArrow(arrays.released(read), "doc_id long, start long, n_tokens long, ids_crc32 long")
