"""Every query over empty tables, and over nulls, repeated rows, long texts and clashing extra columns."""

import pytest

import corpus_pipeline
from surveyloom.llm.queries import QUERIES

TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality long, toxic long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
}
# Names that the operators use themselves.
CLASHES = ("words", "size", "n", "k", "kept", "spans", "label", "score", "component_id", "item_id", "start", "_score", "_n", "_size", "epochs", "target", "id")
NAMES = sorted(QUERIES)


def store(spark, folder, rows, extra=()):
    for name, schema in TABLES.items():
        df = spark.createDataFrame(rows.get(name, []), schema)
        for column in extra:
            if column not in df.columns:
                df = df.selectExpr("*", f"'x' AS {column}")
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    return store(spark, tmp_path_factory.mktemp("nothing"), {})


TEXTS = [None, "", " \t\n", "one", "fine plain words here to read", "fine plain words here to read", "\x00 é ​ 😀 " * 3, "w" * 9000, "a b c " * 9000]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    docs = [(i, text, None if i % 4 == 0 else "en", None if i % 3 == 0 else "s", None) for i, text in enumerate(TEXTS)]
    item = "a benchmark question of more than eight words that some document holds"
    docs.append((len(TEXTS), f"before {item} after", "en", "s", 1))
    labels = [(i, i % 2, (i + 1) % 2) for i in range(len(TEXTS))] + [(None, 1, 1), (3, None, None), (4, 1, 0)]
    vectors = [(i, [float(i % 3), -1.0, 0.5], i % 2) for i in range(60)]
    vectors += [(100, None, 1), (150, [1.0, None, 2.0], 1), (200, [float("nan"), 0.0, 0.0], 1), (None, [1.0, 1.0, 1.0], 1), (400, [9.0, 9.0, 9.0], None)]
    pages = [(i, None, html) for i, html in enumerate([None, "", "<p>", "<html><body><article><p>Some text &amp; more of it.</p></article></body></html>"])]
    tables = {"documents": docs, "labels": labels, "embeddings": vectors, "pages": pages, "benchmark": [(1, item), (2, None), (None, "")]}
    return store(spark, tmp_path_factory.mktemp("odd"), tables, CLASHES)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, nothing, name):
    assert QUERIES[name](spark, nothing).collect() == []


def test_pipeline_over_empty_tables(spark, nothing):
    assert corpus_pipeline.run(spark, nothing).collect() == []


def by_id(df, key="doc_id"):
    rows = [r.asDict() for r in df.collect()]
    assert len({r[key] for r in rows}) == len(rows)
    return {r[key]: r for r in rows}


@pytest.mark.parametrize("name", [n for n in NAMES if n.split("_")[0] in ("op1", "op3", "op5", "op7", "op8", "op9", "op10", "op12", "op13")])
def test_odd_documents_give_one_row_each(spark, odd, name):
    found = by_id(QUERIES[name](spark, odd))
    assert sorted(found) == list(range(len(TEXTS) + 1))
    if "predicted" in found[0]:
        assert all(0 <= r["score"] <= 1 for r in found.values())
    if "component_id" in found[0]:
        assert found[5]["component_id"] == 4 and found[0]["n_shingles"] == 0
        assert [found[i]["component_id"] for i in (0, 1, 2)] == [0, 1, 2]
    if "n_words" in found[0]:
        assert [found[i]["n_words"] for i in (0, 1, 2, 8)] == [0, 0, 0, 27000]
    if "n_bytes" in found[0]:
        assert [found[i]["n_bytes"] for i in (0, 1, 2, 7)] == [0, 0, 3, 9000]
    if "base_score" in found[0]:
        assert [found[i]["n_tokens"] for i in (0, 1, 2, 3, 7, 8)] == [1, 1, 1, 2, 2, 27001]
        assert all(r["score"] < 0 and r["base_score"] < 0 for r in found.values())
    if "form" in found[0]:
        assert [(found[i]["n"], found[i]["form"]) for i in (0, 1)] == [(0, "plain")] * 2 and [found[i]["n"] for i in (2, 7)] == [1, 1]
    if "start" in found[0]:
        ends = [found[i]["start"] + found[i]["n_tokens"] for i in sorted(found)]
        assert found[0]["n_tokens"] == 1 and [found[i]["start"] for i in sorted(found)] == [0, *ends[:-1]]


def test_odd_benchmark(spark, odd):
    assert {r["doc_id"] for r in QUERIES["op2_decontaminate"](spark, odd).collect()} == {len(TEXTS)}


def test_odd_pages(spark, odd):
    found = by_id(QUERIES["op6_main_text"](spark, odd), "page_id")
    assert sorted(found) == [0, 1, 2, 3]
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())
    assert [found[i]["text"] for i in (0, 1, 2)] == ["", "", ""]


def test_odd_vectors_are_no_negatives(spark, odd):
    """Vector 0 moves to label 1, so it and its positives are of the odd ids; copies of its own vector are negatives too."""
    rows = QUERIES["op11_hard_negatives"](spark, odd).collect()
    label = {i: (i % 2 + 1) % 10 if i % 7 == 0 else i % 2 for i in range(60)}
    whole = {i: (256 * (i % 3), -256, 128) for i in range(60)}
    scored = sorted((-sum(x * y for x, y in zip(whole[0], v)), i) for i, v in whole.items() if i != 0)
    expected = []
    for s, p in [x for x in scored if label[x[1]] == label[0]][:5]:
        fits = [x for x in scored if label[x[1]] != label[0] and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
        expected += [(0, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(fits)]
    assert sorted(tuple(r) for r in rows) == sorted(expected) and expected


def test_odd_vectors_take_no_part(spark, odd):
    rows = QUERIES["op4_exact_topk"](spark, odd).collect()
    whole = {i: (256 * (i % 3), -256, 128) for i in range(60)} | {400: (2304, 2304, 2304)}
    for query in (0, 50):
        scored = sorted((-sum(x * y for x, y in zip(whole[query], v)), i) for i, v in whole.items() if i != query)[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == query] == scored
    assert {r["query_id"] for r in rows} == {0, 50, 400}


def test_pipeline_over_odd_documents(spark, odd):
    """Two labelled good texts, so most is rejected; whatever is kept comes back once or twice."""
    out = corpus_pipeline.run(spark, odd)
    assert out.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {r["doc_id"] for r in out.collect()} <= set(range(len(TEXTS)))


def test_stages_keep_clashing_columns(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, odd)
        assert out.columns == docs.columns, name
        kept = out.collect()
        assert kept and all(r["_n"] == r["epochs"] == "x" for r in kept), name
    groups = corpus_pipeline.join_near_duplicates(spark, docs, odd)
    assert sorted(r["doc_id"] for r in groups.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9]
    clean = corpus_pipeline.decontaminate(spark, docs, odd)
    assert sorted(r["doc_id"] for r in clean.collect()) == list(range(len(TEXTS)))


def test_different_texts_of_one_id_stay(spark):
    """Groups that link to either text of doc_id 5 stay apart, and each keeps its smallest doc_id."""
    one, two = (" ".join(f"{x}{i}" for i in range(30)) for x in "pq")
    other = " ".join(f"r{i}" for i in range(30))
    rows = [(5, one), (5, two), (5, two), (5, other), (3, one + " end"), (9, two + " end"), (None, one), (7, None), (7, "")]
    docs = spark.createDataFrame([(i, x, "en", "s", n) for n, (i, x) in enumerate(rows)], TABLES["documents"])
    out = corpus_pipeline.join_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"] or "") for r in out.collect()), key=str)
    assert found == sorted([(3, one + " end"), (5, two), (5, other), (None, one), (7, "")], key=str)


def test_runs_of_letters_are_encoded_together():
    """As the tokenizer reads them one by one, with few calls; other units, and those of a tokenizer without ends of words, stay alone."""
    import pyarrow as pa
    import public_tokenizers

    from surveyloom.llm.token_files import Encoder

    path = public_tokenizers.path("word_bpe_49k.json")
    words = [f"{a}{b}{c}" for a in ("str", "ÉÀ", "İx", "q", "ß", "Ａ", "µ", "ſ") for b in ("an", "'s", "ö", "3", "</w>", "—", "<|endoftext|>", "é") for c in ("ge", "", "X", "~", "~~a")]
    words += ["</w>", "w", "́a", "x y", "　", "'s", "don't", "ÿ" * 300, "​"]
    texts = [" ".join(words), *words, " ".join(f"wo{chr(97 + i % 26)}{chr(97 + i // 26)}rd" for i in range(600))]

    class Counting:
        def __init__(self, inner):
            self.inner, self.texts = inner, 0

        def encode_batch_fast(self, texts, **how):
            self.texts += len(texts)
            return self.inner.encode_batch_fast(texts, **how)

    encoder = Encoder(path)
    plain = encoder.tokenizer
    want = [i for t in texts for i in [*plain.encode(t, add_special_tokens=False).ids, 1]]
    encoder.tokenizer = Counting(plain)
    ids, sizes = encoder.encode(pa.array(texts), 1)
    assert ids.tolist() == want and sizes.sum() == len(want)
    before = encoder.tokenizer.texts
    encoder._forget()
    encoder.encode(pa.array(texts[-1:]), 1)
    assert encoder.tokenizer.texts - before <= 600 / 10

    encoder._forget()
    encoder.ends[:] = False
    assert encoder.encode(pa.array(texts), 1)[0].tolist() == want
