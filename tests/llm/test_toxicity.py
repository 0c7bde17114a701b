"""The factorisation machine: its score against all pairs, pairs of neutral terms, bounded samples."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import arrays, toxicity
from surveyloom.llm.hashed import fold, labelled_sample


def both_or_neither(n, seed):
    """Texts of ten words; toxic if two of them, each harmless alone, are there together or both missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = rng.sample([f"w{k}" for k in range(200)], 10)
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words += ["aa"] * a + ["bb"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(a == b)))
    return rows


@pytest.fixture(scope="module")
def learned(spark):
    rows = both_or_neither(4000, 3)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic long")
    held = fold(F.col("doc_id"), 5) == 0
    return docs, labels, held, toxicity.fit_toxicity(docs, labels, ~held)


def test_pairs_of_neutral_terms_are_learned(learned):
    docs, labels, held, model = learned
    found = toxicity.toxicity_scores(docs.filter(held), model).join(labels, "doc_id").select("toxic", "_score").collect()
    assert len(found) > 700
    assert sum((r["_score"] >= 0.5) == (r["toxic"] == 1) for r in found) / len(found) > 0.9


def test_score_is_the_sum_over_all_pairs(learned):
    model = learned[3]
    texts = ["", "aa bb", "aa", "w1 w2 w3 aa bb AA", "unseen words only", " ".join(f"w{k}" for k in range(200))]
    text = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    docs, found = toxicity.terms(text, offsets)
    got = model.score(text, offsets)
    for i in range(len(texts)):
        at = [model.place[t] for t in found[docs == i]]
        total = model.bias + sum(model.weights[a] for a in at)
        for x, a in enumerate(at):
            for b in at[x + 1 :]:
                total += float(model.vectors[a] @ model.vectors[b])
        assert got[i] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)
    assert not model.weights[0] and not model.vectors[0].any()


def test_a_fit_comes_out_alike_again(spark, learned):
    docs, labels, held, model = learned
    again = toxicity.fit_toxicity(docs.repartition(5), labels.repartition(3), ~held)
    assert (again.place == model.place).all() and again.bias == model.bias
    assert (again.weights == model.weights).all() and (again.vectors == model.vectors).all()


def test_documents_that_fit_teach_nothing():
    weights, vectors = np.array([0.0, 9.0, -9.0, 0.0]), np.zeros((4, toxicity.FACTORS))
    examples = [(np.array([1, 3], np.int32), 1), (np.array([2, 3], np.int32), 0)]
    w, v, b = toxicity.refine(examples, weights, vectors, 0.0)
    assert (w == weights).all() and not v.any() and b == 0.0


def test_the_sample_is_bounded_whatever_repeats(spark):
    rows = [(7, f"text {k:04}") for k in range(1500)] + [(i, None) for i in range(8, 40)] + [(None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(7, 40)] + [(7, 1), (None, 1), (8, None)], "doc_id long, toxic long")
    found = labelled_sample(docs, labels, "toxic", None, 1000).collect()
    assert len(found) == 33 and {r["doc_id"]: r["text"] for r in found}[7] == "text 0000"
    assert labelled_sample(docs, labels, "toxic", None, 10).count() == 10


@pytest.mark.parametrize("rows", [[], [(1, "a", 1)], [(1, None, 0), (2, "", 0)]])
def test_little_to_learn_from(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic long")
    scores = toxicity.toxicity_scores(docs, toxicity.fit_toxicity(docs, labels)).collect()
    assert len(scores) == len(rows) and all(0 <= r["_score"] <= 1 for r in scores)
