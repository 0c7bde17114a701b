"""Toxicity: a factorisation machine over hashed terms.

Terms are a document's distinct words, in lower case, and the first 3 to 6 bytes of longer ones, which inflected insults share. A
linear weight and a short vector per term; the score adds the products of all pairs' vectors, so that a pair such as an insult
and the mention of a group can weigh more, or less, than its parts. Learning has two passes. The first knows the terms that tell
the classes apart alone, so that thousands of neutral terms of a long text add no noise. The second knows every term of 5 sample
documents or more, but learns only from documents that the model so far gets wrong or is unsure of: pairs of terms that are
neutral alone are found there.
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
from surveyloom.llm.hashed import bins, by_document, labelled_sample, score_texts, sigmoid
from surveyloom.session import ship_package

SIZE = 1 << 20
FACTORS = 8
FIT_ROWS = 20_000  # labelled documents that are learned from, at most
EPOCHS = 6
MARGIN = 0.1  # a document this near to its label teaches the second pass nothing
ROOM = 20  # terms of a document that take a whole step in the second pass; those of longer ones share it
PREFIXES = (3, 4, 5, 6)


def terms(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents (ascending) and their distinct bins."""
    starts, stops, bounds = arrays.word_spans(text, offsets)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    docs, found = [doc], [bins(arrays.word_hashes(text, starts, stops, lower=True), SIZE)]
    for n in PREFIXES:
        long = np.flatnonzero(stops - starts > n)
        heads = arrays.word_hashes(text, starts[long], starts[long] + n, lower=True)
        docs.append(doc[long])
        found.append(bins(heads ^ U64(n), SIZE))
    docs, found, _ = by_document(np.concatenate(docs), np.concatenate(found), SIZE)
    return docs, found


@dataclass
class ToxicityModel:
    """`place` has the row of each bin's weight and vector; row 0 is nothing."""

    place: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    bias: float

    def score(self, text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        docs, found = terms(text, offsets)
        at = self.place[found]
        known = at > 0
        docs, at = docs[known], at[known]
        n = len(offsets) - 1
        total = self.bias + np.bincount(docs, self.weights[at], minlength=n)
        for f in range(self.vectors.shape[1]):
            v = self.vectors[at, f]
            total += 0.5 * (np.bincount(docs, v, minlength=n) ** 2 - np.bincount(docs, v * v, minlength=n))
        return sigmoid(total)


def chosen_terms(with_term: np.ndarray, toxic_with: np.ndarray, docs: int, toxic: int) -> np.ndarray:
    """Bins whose share of toxic documents is far from the sample's, by a z-score of 3 or more."""
    rate = toxic / max(docs, 1)
    spread = np.sqrt(np.maximum(with_term * rate * (1 - rate), 1e-12))
    z = np.where(with_term >= 5, np.abs(toxic_with - with_term * rate) / spread, 0)
    return np.flatnonzero(z >= 3)


def started(seed: int, rows: int, width: float) -> np.ndarray:
    """Vectors to start from, of components up to half of `width` on both sides of 0."""
    return ((arrays.seeded(seed, rows * FACTORS) >> U64(11)) / float(1 << 53) - 0.5).reshape(rows, FACTORS) * width


def class_balance(examples: list[tuple[np.ndarray, int]]) -> float:
    positive = sum(label for _, label in examples)
    return np.sqrt((len(examples) - positive) / positive) if positive and positive < len(examples) else 1.0


def train(examples: list[tuple[np.ndarray, int]], rows: int, epochs: int = EPOCHS, rate: float = 0.15, penalty: float = 1e-4) -> tuple[np.ndarray, np.ndarray, float]:
    """AdaGrad over (rows of terms, label). The rarer class weighs more, half as much as would balance the two."""
    weights, bias = np.zeros(rows), 0.0
    vectors = started(9, rows, 0.1)
    sums = [np.full(rows, 1e-2), np.full((rows, FACTORS), 1e-2), 1e-2]
    balance = class_balance(examples)
    for _ in range(epochs):
        for at, label in examples:
            v = vectors[at]
            s = v.sum(axis=0)
            total = bias + weights[at].sum() + 0.5 * (s @ s - (v * v).sum())
            slope = (float(sigmoid(np.array(total))) - label) * (balance if label else 1.0)
            g = slope + penalty * weights[at]
            gv = slope * (s - v) + penalty * v
            sums[0][at] += g * g
            sums[1][at] += gv * gv
            sums[2] += slope * slope
            weights[at] -= rate * g / np.sqrt(sums[0][at])
            vectors[at] = v - rate * 0.3 * gv / np.sqrt(sums[1][at])
            bias -= rate * slope / np.sqrt(sums[2])
    return weights, vectors, bias


def refine(
    examples: list[tuple[np.ndarray, int]], weights: np.ndarray, vectors: np.ndarray, bias: float, epochs: int = 2 * EPOCHS, rate: float = 0.15, penalty: float = 1e-3
) -> tuple[np.ndarray, np.ndarray, float]:
    """The second pass, over all terms: AdaGrad on the documents that miss their label by `MARGIN`, until there are none.

    Rows that no such document holds stay as they were, nothing if they were nothing.
    """
    rows = len(weights)
    known = np.any(vectors, axis=1)
    weights, vectors = weights.copy(), np.where(known[:, None], vectors, started(10, rows, 0.02))
    sums = [np.full(rows, 1e-2), np.full((rows, FACTORS), 1e-2), 1.0]
    balance = class_balance(examples)
    for _ in range(epochs):
        learned = 0
        for at, label in examples:
            v = vectors[at]
            s = v.sum(axis=0)
            slope = float(sigmoid(np.array(bias + weights[at].sum() + 0.5 * (s @ s - (v * v).sum())))) - label
            if abs(slope) < MARGIN:
                continue
            learned += 1
            slope *= balance if label else 1.0
            step = rate * min(1.0, ROOM / max(len(at), 1))
            gv = slope * (s - v)
            sums[0][at] += slope * slope
            sums[1][at] += gv * gv
            sums[2] += slope * slope
            weights[at] -= step * (slope / np.sqrt(sums[0][at]) + penalty * weights[at])
            vectors[at] = v - step * (0.3 * gv / np.sqrt(sums[1][at]) + penalty * v)
            bias -= step * slope / np.sqrt(sums[2])
            known[at] = True
        if not learned:
            break
    vectors[~known] = 0
    return weights, vectors, bias


def fit_toxicity(docs: DataFrame, labels: DataFrame, keep: Column | None = None, most: int = FIT_ROWS) -> ToxicityModel:
    """Learn labels.toxic from at most `most` labelled documents for which `keep`, a condition on doc_id, holds."""
    ship_package(docs.sparkSession)
    sample = written(labelled_sample(docs, labels, "toxic", keep, most).select("doc_id", "y", "text"), "toxic_sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_, toxic = np.zeros(SIZE, np.int64), np.zeros(SIZE, np.int64)
        for part in arrays.parts(batches, "text"):
            docs_, found = terms(*arrays.text_bytes(part.column("text")))
            y = part.column("y").to_numpy()
            all_ += np.bincount(found, minlength=SIZE)
            toxic += np.bincount(found[y[docs_] == 1], minlength=SIZE)
        some = np.flatnonzero(all_)
        columns = [pa.array(x, pa.int64()) for x in (some, all_[some], toxic[some])]
        yield pa.RecordBatch.from_arrays(columns, ["term", "n", "toxic"])

    counts = sample.mapInArrow(arrays.released(count), "term long, n long, toxic long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    counts = counts.where("n >= 5").toPandas()  # one row a bin at most
    size, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    counts = counts.sort_values("term")
    place = np.zeros(SIZE, np.int32)
    place[counts["term"].to_numpy()] = np.arange(1, len(counts) + 1)
    far = np.zeros(len(counts) + 1, bool)
    far[1 + chosen_terms(counts["n"].to_numpy(), counts["toxic"].to_numpy(), size, toxic)] = True

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.parts(batches, "text"):
            docs_, found = terms(*arrays.text_bytes(part.column("text")))
            at = place[found]
            docs_, at = docs_[at > 0], at[at > 0]
            cuts = np.searchsorted(docs_, np.arange(part.num_rows + 1))
            blobs = pa.array([at[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), blobs], ["doc_id", "y", "terms"])

    rows = sample.mapInArrow(arrays.released(extract), "doc_id long, y int, terms binary").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    examples = [(np.frombuffer(r["terms"], np.int32), r["y"]) for r in rows]
    weights, vectors, bias = train([(at[far[at]], y) for at, y in examples], len(far))
    weights[~far], vectors[~far] = 0, 0
    weights, vectors, bias = refine(examples, weights, vectors, bias)
    used = np.flatnonzero((weights != 0) | np.any(vectors, axis=1))
    kept = np.zeros(len(far), np.int32)
    kept[used] = np.arange(1, len(used) + 1)
    nothing = np.zeros((1, FACTORS))
    return ToxicityModel(kept[place], np.concatenate([[0.0], weights[used]]), np.concatenate([nothing, vectors[used]]), bias)


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The columns of `docs` and `_score`, from 0 to 1. A null or empty text scores by the bias alone."""
    return score_texts(docs, model.score)
