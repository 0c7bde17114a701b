"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

n-grams of 1 to 2 words and of 1 to 3 word shapes. A word that repeats the one before it is a token of its own, the same
for all words. A shape is the word with each run of small letters, capitals or digits as one character; bytes above 127 count as
small letters. Values are square roots of shares, so that a text's length doesn't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm import arrays
from surveyloom.llm.arrays import U64
from surveyloom.llm.chunks import written
from surveyloom.llm.hashed import PART, bins, by_document, labelled_sample, score_texts, sigmoid
from surveyloom.session import ship_package

SIZE = 1 << 18
FIT_ROWS = 6000  # labelled documents that are learned from, at most
EPOCHS = 3
REPEAT = U64(0x4E5041454552)

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = ord("x")
_CLASS[128:] = ord("x")
_CLASS[ord("A") : ord("Z") + 1] = ord("X")
_CLASS[ord("0") : ord("9") + 1] = ord("9")


def _shapes(text: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each word's shape."""
    kind = _CLASS[text]
    fresh = np.ones(len(text), bool)
    fresh[1:] = kind[1:] != kind[:-1]
    fresh[starts] = True
    place = np.concatenate(([0], np.cumsum(fresh)))
    return arrays.word_hashes(kind[fresh], place[starts], place[stops])


def features(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents (ascending), bins and values."""
    starts, stops, bounds = arrays.word_spans(text, offsets)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    words = arrays.word_hashes(text, starts, stops, lower=True)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    words[again] = REPEAT
    shapes = _shapes(text, starts, stops)
    out = []
    for family, (symbols, most) in enumerate(((words, 2), (shapes, 3))):
        grams = symbols
        for n in range(1, most + 1):
            if n > 1:
                grams = arrays.mix(grams[:-1] + U64(n)) ^ symbols[n - 1 :]
            inside = doc[: len(grams)] == doc[n - 1 :]
            salted = grams ^ U64(((family * 4 + n) << 56) | n)
            docs, terms, counts = by_document(doc[: len(grams)][inside], bins(salted[inside], SIZE), SIZE)
            totals = np.bincount(docs, counts, minlength=len(bounds) - 1)
            out.append((docs, terms, np.sqrt(counts / totals[docs])))
    docs, terms, values = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(docs, kind="stable")
    return docs[order], terms[order], values[order]


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float

    def score(self, text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        docs, terms, values = features(text, offsets)
        return sigmoid(self.bias + np.bincount(docs, self.weights[terms] * values, minlength=len(offsets) - 1))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.1) -> QualityModel:
    """One pass after another over (bins, values, label); the last bin of `SIZE` + 1 is the bias, without penalty."""
    z, n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def weights(at, total, squares):
        shrunk = np.sign(total) * np.maximum(np.abs(total) - np.where(at == SIZE, 0, l1), 0)
        return -shrunk / ((beta + np.sqrt(squares)) / alpha + np.where(at == SIZE, 0, l2))

    for _ in range(epochs):
        for terms, values, label in examples:
            at, x = np.append(terms, SIZE), np.append(values, 1.0)
            total, squares = z[at], n[at]
            w = weights(at, total, squares)
            gradient = (sigmoid(w @ x) - label) * x
            step = (np.sqrt(squares + gradient * gradient) - np.sqrt(squares)) / alpha
            z[at], n[at] = total + gradient - step * w, squares + gradient * gradient
    w = weights(np.arange(SIZE + 1), z, n)
    return QualityModel(w[:SIZE].astype(np.float32), float(w[SIZE]))


def fit_quality(docs: DataFrame, labels: DataFrame, keep: Column | None = None, most: int = FIT_ROWS) -> QualityModel:
    """Learn labels.quality from at most `most` labelled documents for which `keep`, a condition on doc_id, holds.

    Without any example every score is 0.5.
    """
    ship_package(docs.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.parts(batches, "text", PART):
            docs_, terms, values = features(*arrays.text_bytes(part.column("text")))
            cuts = np.searchsorted(docs_, np.arange(part.num_rows + 1))
            blobs = [[x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] for x in (terms.astype(np.int32), values.astype(np.float32))]
            columns = [part.column("doc_id"), part.column("y"), *(pa.array(x, pa.binary()) for x in blobs)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "y", "terms", "vals"])

    sample = written(labelled_sample(docs, labels, "quality", keep, most).select("doc_id", "y", "text"), "quality_sample")
    rows = sample.mapInArrow(arrays.released(extract), "doc_id long, y int, terms binary, vals binary")
    found = rows.orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    return train([(np.frombuffer(r["terms"], np.int32), np.frombuffer(r["vals"], np.float32).astype(float), r["y"]) for r in found])


def quality_scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The columns of `docs` and `_score`, from 0 to 1. A null text counts as empty; a text without words scores by the bias alone."""
    return score_texts(docs, model.score)
