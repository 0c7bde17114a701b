"""Hard negatives, the language model and fill-in-middle against brute force and exact round trips."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import arrays, language_model
from surveyloom.llm.fill_in_middle import fill_in_middle, restore
from surveyloom.llm.hard_negatives import Segment, _ordered, _rest, hard_negatives, pairs_above
from surveyloom.llm.language_model import discounts, fit, lm_scores

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- fill-in-middle

LINES = [None, "", "\n", "one line", "a\nb\nc\n", "é😀\nü <P > x\n\n\n" * 40, "holds <S> inside\nand more", "<", "x<\n<S\n>P>\n" * 9, "w\n" * 90_000, "long " * 200_000]


def plain_fim(doc_id, text, percent, spm):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < spm else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("percent, spm", [(100, 50), (60, 0), (60, 100), (0, 50)])
def test_fill_in_middle_equals_plain_text_and_comes_back(spark, percent, spm):
    rows = [(i if i != 3 else None, t, "x", "y") for i, t in enumerate(LINES * 5)]
    rows += rows[:4]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `odd.name` string, form string")
    made = fill_in_middle(docs, 7, percent, spm)
    assert made.columns[:2] == ["doc_id", "odd.name"]
    found = restore(made).collect()
    expected = sorted((str((d, *plain_fim(d, t, percent, spm), t or "")) for d, t, *_ in rows))
    assert sorted(str((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["text"])) for r in found) == expected
    for r in found:
        assert r["odd.name"] == "x"
        assert r["output_sha256"] == hashlib.sha256(r["output"].encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


# --- language model


def tokens(text):
    return ["".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(text or "")] + ["\n"]


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney with dictionaries: a function from a text to its tokens' log10 probabilities."""
    grams = Counter()
    for text in texts:
        seq = ["<s>"] + tokens(text)
        for i in range(1, len(seq)):
            for k in range(1, order + 1):
                if i - k + 1 >= 0:
                    grams[tuple(seq[i - k + 1 : i + 1])] += 1
    counts = {k: {} for k in range(1, order + 1)}
    before = defaultdict(set)
    for g in grams:
        before[g[1:]].add(g[0])
    for g, c in grams.items():
        counts[len(g)][g] = c if len(g) == order or g[0] == "<s>" else len(before[g])
    vocabulary = {g[0] for g in counts[1]}
    off, stats = {}, defaultdict(lambda: [0, 0, 0, 0])
    for k in counts:
        of = Counter(counts[k].values())
        off[k] = discounts(tuple(of[i] for i in range(1, 5)))
        for g, c in counts[k].items():
            s = stats[g[:-1]]
            s[0] += c
            s[min(c, 3)] += 1

    def score(text):
        seq, out = ["<s>"] + tokens(text), []
        for i in range(1, len(seq)):
            p = 1 / (len(vocabulary) + 1)
            for k in range(1, order + 1):
                if i - k + 1 < 0:
                    break
                g = tuple(seq[i - k + 1 : i + 1])
                s = stats.get(g[:-1])
                if s:
                    c = counts[k].get(g, 0)
                    p = max(c - off[k][min(c, 3)], 0) / s[0] + sum(off[k][j] * s[j] for j in (1, 2, 3)) / s[0] * p
            out.append(math.log10(p))
        return out

    return score


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(5)
    words = [f"W{i}" for i in range(120)]
    weights = 1 / np.arange(1, 121)
    texts = [" ".join(rng.choice(words, int(rng.integers(1, 60)), p=weights / weights.sum())) for _ in range(150)]
    texts += [None, "", " \t", "W1 w1 É", texts[3], texts[3], "W2 " * 3000, "unseen words here", "x" * 5000]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_equal_a_plain_model(spark, corpus, order, monkeypatch):
    rows, docs = corpus
    monkeypatch.setattr(language_model, "PART", 2000)  # documents in many parts, n-grams sent many times
    monkeypatch.setattr(language_model, "HELD", 300)
    model = fit(docs, F.col("doc_id") % 5 != 1, order)
    learned = [t for i, t in rows if i % 5 != 1]
    score = plain_model(learned, order)
    unigrams = Counter(w for t in learned for w in tokens(t))
    n, v = sum(unigrams.values()), len(unigrams)
    assert (model.words.total, model.words.size) == (n, v)
    found = {r["doc_id"]: r for r in lm_scores(docs, model).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        own, r = tokens(text), found[i]
        assert (r["n_tokens"], r["n_known"]) == (len(own), sum(unigrams[w] > 0 for w in own))
        assert r["base_score"] == pytest.approx(sum(math.log10((unigrams[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), rel=1e-9)
        assert r["score"] == pytest.approx(sum(score(text)), rel=1e-6)
        assert r["perplexity"] == pytest.approx(10 ** (-r["score"] / len(own)))


def test_probabilities_after_a_context_sum_to_one(spark, corpus):
    """Over all words, the end and one unknown word, after a known, a half known and an unknown context."""
    rows, docs = corpus
    model = fit(docs)
    vocabulary = sorted({w for _, t in rows for w in tokens(t)[:-1]})
    files = language_model.Files(model.folder)
    one = lambda w: arrays.word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w.encode())]), lower=True)[0]
    for context in (["w1", "w2"], ["never", "w2"], ["w2", "never"], []):
        total = 0.0
        for last in [*map(one, vocabulary), language_model.END, np.uint64(12345)]:
            hashes = np.array([*map(one, context), last], np.uint64)
            total += 10 ** language_model.log_probabilities(files, model, hashes, np.array([0, len(hashes)]))[1][-1]
        assert total == pytest.approx(1, rel=1e-5)


def test_model_of_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    model = fit(empty)
    assert lm_scores(empty, model).collect() == []
    r = lm_scores(spark.createDataFrame([(1, "a b", "z")], "doc_id long, text string, score string"), model).first()
    assert (r["n_tokens"], r["n_known"], r["base_score"], r["score"]) == (3, 0, 0, 0)


# --- hard negatives


def plain_negatives(rows, positives=5, negatives=5):
    sound = {}
    for i, e, label in rows:
        if i is not None and label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            sound[i] = (label, [math.floor(256 * float(np.float32(x))) for x in e])
    out = []
    for a, (label, v) in sound.items():
        if a % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in sound.items() if i != a))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fits)]
    return sorted(out)


def vectors(rng, n, width, kind):
    rows = []
    centres = rng.normal(size=(6, width))
    for i in range(n):
        if kind == "hot" and i % 3 == 0:
            e = centres[0]
        elif kind == "clustered":
            e = centres[i % 6] + 0.2 * rng.normal(size=width)
        elif kind == "lengths":
            e = rng.normal(size=width) * 10 ** rng.uniform(-2, 2)
        else:
            e = rng.normal(size=width)
        rows.append((i * 4, [float(x) for x in e], int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("kind", ["plain", "clustered", "hot", "lengths"])
def test_hard_negatives_equal_brute_force(spark, kind):
    rows = vectors(np.random.default_rng(3), 400, 20, kind)
    width = len(rows[0][1])
    rows += [(100_000, [0.0] * width, 1), (100_100, [1.0] * width, 99), (None, [1.0] * width, 1), (100_200, None, 1), (100_300, [1.0] * width, None)]
    rows += [(100_400, [float("nan")] * width, 1), (100_500, [None] + [1.0] * (width - 1), 1), rows[5]]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, score string").repartition(3)
    found = sorted(tuple(r) for r in hard_negatives(df, F.col("vec_id") % 100 == 0).collect())
    expected = plain_negatives(rows)
    assert found == expected and (kind == "plain" or expected)


def test_no_vectors_and_no_anchors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert hard_negatives(spark.createDataFrame([], schema), F.col("vec_id") % 100 == 0).collect() == []
    some = spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2), (100, [], 1), (200, [], 2)], schema)
    assert hard_negatives(some, F.col("vec_id") == 7).collect() == []
    assert hard_negatives(some.where("vec_id >= 100"), F.col("vec_id") == 100).collect() == []


def test_pairs_above_a_threshold_are_whole_and_little_is_indexed():
    rng = np.random.default_rng(9)
    x = np.floor(256 * rng.normal(size=(500, 37)) / np.arange(1, 38)).astype("<i8")
    q = np.floor(256 * rng.normal(size=(40, 37)) / np.arange(1, 38)).astype("<i8")
    known = np.ones(500, "<i8").tobytes() + np.arange(500, dtype="<i8").tobytes()
    order = np.arange(37)
    segment = Segment({"vectors": x.tobytes(), "labels": np.zeros(500, "<i8").tobytes(), "ids": known}, order, 1)
    own, scores = _ordered(q, order), q @ x.T
    lengths = np.sqrt((q * q).sum(axis=1))
    for t in (400.0, 200.0, 50.0, 0.0):
        low = np.ceil(t * lengths)
        at, row, score = pairs_above(segment, own, _rest(own), low, np.ones((40, 500), bool), t)
        want = np.argwhere(scores >= low[:, None])
        assert sorted(zip(at.tolist(), row.tolist())) == sorted(map(tuple, want.tolist()))
        assert (score == scores[at, row]).all()
    held = segment.index(200.0)[1]
    assert held.sum() < 0.5 * x.size  # the rest is covered by the bound
