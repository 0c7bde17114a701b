"""Hashed terms of texts and bounded labelled samples, for the two classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.llm import arrays
from surveyloom.llm.arrays import U64
from surveyloom.session import ship_package


PART = 2 << 20  # bytes of text whose terms are in memory at a time


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column | None, most: int) -> DataFrame:
    """doc_id, y and text of at most `most` labelled documents, those whose ids have the smallest digests.

    `keep` is a condition on doc_id, or none. Several labels of a document are averaged; of several rows of one doc_id the smallest
    text counts. The sample's ids, bounded by `most`, are broadcast, so texts of other documents are not shuffled.
    """
    y = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (F.lit(True) if keep is None else keep))
    y = y.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    chosen = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def bins(hashes: np.ndarray, size: int) -> np.ndarray:
    return (arrays.mix(hashes) & U64(size - 1)).astype(np.int64)


def by_document(docs: np.ndarray, terms: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of each document: documents (ascending), terms, counts."""
    keys, counts = np.unique(docs.astype(np.int64) * size + terms, return_counts=True)
    return keys // size, keys % size, counts


def score_texts(docs: DataFrame, score: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """The columns of `docs` and `_score`, by a function of text bytes and document offsets. An earlier `_score` is replaced."""
    ship_package(docs.sparkSession)
    docs = docs.drop("_score")
    schema = T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.parts(batches, "text", PART):
            text, offsets = arrays.text_bytes(part.column("text"))
            values = pa.array(score(text, offsets), pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns, values], [*part.schema.names, "_score"])

    return docs.mapInArrow(arrays.released(run), schema)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
