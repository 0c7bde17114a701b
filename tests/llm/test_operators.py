"""Corpus operators against brute force, on small tables with nulls, ties, repeated rows and odd texts."""

import hashlib
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from surveyloom.llm import decontaminate, html_text, suffix_dedup
from surveyloom.llm.jaccard_join import jaccard_join
from surveyloom.llm.mixing import mix, mix_report
from surveyloom.llm.recompression import recompression_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(1)
    words = [f"w{i}é" for i in range(300)]
    some = lambda n: " ".join(rng.choice(words, n))
    passage, base = some(70), some(200).split()
    out = [None, "", "a b", "A  B", some(400) + passage, passage + "\n" + some(90), "x " * 300, "x " * 200, passage]
    for k in range(12):
        copy = list(base)
        copy[k * 7] = "edit"
        out.append(" ".join(copy))
    return [*out, out[9], out[9], some(5000) + passage]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, x, "en", f"s{i % 3}" if i % 5 else None, 0) for i, x in enumerate(texts)], SCHEMA)


def brute(units, width):
    seen, out = set(), {}
    for doc, sequence in units.items():
        gone, own = [False] * len(sequence), set()
        for i in range(len(sequence) - width + 1):
            window = sequence[i : i + width]
            own.add(window)
            if window in seen:
                gone[i : i + width] = [True] * width
        seen |= own
        out[doc] = [u for u, g in zip(sequence, gone) if not g]
    return out


def test_repeats_equal_brute_force(docs, texts):
    bytes_ = brute({i: (x or "").encode() for i, x in enumerate(texts)}, 50)
    for row in suffix_dedup.suffix_dedup(docs).collect():
        assert bytes(row["kept"]) == bytes(bytes_[row["doc_id"]])
    words = brute({i: tuple(WORD.findall(x or "")) for i, x in enumerate(texts)}, 50)
    for row in recompression_dedup(docs).collect():
        assert row["kept"] == " ".join(words[row["doc_id"]])


def test_covers_hold_every_difference():
    for period, cover in suffix_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_jaccard_join_equals_brute_force(docs, texts):
    lower = lambda x: tuple(WORD.findall("".join(c.lower() if c.isascii() else c for c in x or "")))
    sets = []
    for w in map(lower, texts):
        sets.append({w[i : i + 5] for i in range(len(w) - 4)} if len(w) >= 5 else {w} if w else set())
    root = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join(docs).collect()}
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert not jaccard_join(empty).collect() and not recompression_dedup(empty).collect()


def test_mix_meets_its_targets(docs):
    rows = mix_report(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] for r in rows)


def test_mix_by_given_weights(spark):
    """Scores passed in as a column decide who is taken more often; null, NaN and negative scores weigh least; `mix` agrees with the report."""
    scores = [0.99, 0.02, None, float("nan"), -1.0]
    docs = spark.createDataFrame([(i, "a b c", "s" if i % 2 else None, scores[i % 5]) for i in range(2000)], "doc_id long, text string, source string, `my``score` double")
    options = {"share": 0.3, "weight": "my`score"}
    report = {r["doc_id"]: r["times"] for r in mix_report(docs, **options).collect()}
    taken = [sum(n for i, n in report.items() if i % 5 == k) for k in range(5)]
    assert taken[0] > 350 and max(taken[1:]) < 100 and sum(taken) in (599, 600, 601)
    mixed = mix(docs, **options)
    assert mixed.columns == docs.columns
    rows = [r["doc_id"] for r in mixed.collect()]
    assert sorted(rows) == sorted(i for i, n in report.items() for _ in range(n))


def test_edited_items_are_found():
    item = " ".join(f"i{k}" for k in range(40))
    edited = item.replace("i7 ", "").replace("i20", "changed")
    index = decontaminate.build_index([1, 2, 3], [item, "too short", ""])
    found = decontaminate.matches(pa.array([f"x y {edited} z", "nothing here", None, ""]), index)
    assert [(doc, item, distance) for doc, item, distance, _ in found] == [(0, 0, 2)]


def _edited(rng, item, edits, spread):
    """The item with so many words changed, left out or added, evenly spread or anywhere."""
    at = [int((k + 0.5) * len(item) / edits) for k in range(edits)] if spread else sorted(rng.choice(len(item), edits, replace=False).tolist())
    out = list(item)
    for i in reversed(at):
        out[i : i + 1] = [["new"], [], [item[i], "new"]][0 if spread else int(rng.integers(3))]
    return out


@pytest.mark.parametrize("spread", [False, True])
def test_items_at_the_allowed_distance_are_found_at_every_length(spread):
    """Equal to edit distances over whole documents, and none of the edited items is missed."""
    rng = np.random.default_rng(7)
    words = [f"v{i}" for i in range(400)]
    for n in (8, 9, 10, 12, 15, 16, 20, 38):
        items = [rng.choice(words, n).tolist() for _ in range(30)]
        index = decontaminate.build_index(list(range(len(items))), [" ".join(x) for x in items])
        texts = [" ".join([*rng.choice(words, 9), *_edited(rng, x, k * (n // 4), spread), *rng.choice(words, 9)]) for x in items for k in (0, 1)]
        found = decontaminate.matches(pa.array(texts), index)
        assert {(d, d // 2) for d in range(len(texts))} <= {(d, i) for d, i, _, _ in found}
        held, bounds = decontaminate._words(pa.array(texts))
        brute = []
        for d in range(len(texts)):
            for i, own in enumerate(index.words):
                distance, end = decontaminate.edit_distance_within(own, held[bounds[d] : bounds[d + 1]])
                brute += [(d, i, distance, end)] if distance <= n // 4 else []
        assert found == brute


@pytest.mark.parametrize("kind", ["changed", "any", "spread"])
def test_walks_alone_find_nine_of_ten(kind):
    """Without the runs, items at the allowed distance are found by a sampled walk over their own words."""
    rng = np.random.default_rng(11)
    words = [f"v{i}" for i in range(4000)]
    for n in (8, 9, 10, 11, 12, 15, 16, 20, 23, 24, 28, 31, 38, 60):
        items = [rng.choice(words, n).tolist() for _ in range(100)]
        index = decontaminate.build_index(list(range(len(items))), [" ".join(x) for x in items], runs=False)
        assert not index.widths
        at = [sorted(rng.choice(n, n // 4, replace=False).tolist()) for _ in items]
        changed = [[f"n{i}" if i in gone else word for i, word in enumerate(x)] for x, gone in zip(items, at)]
        bodies = changed if kind == "changed" else [_edited(rng, x, n // 4, kind == "spread") for x in items]
        texts = [" ".join([*rng.choice(words, 9), *x, *rng.choice(words, 9)]) for x in bodies]
        found = decontaminate.matches(pa.array(texts), index)
        assert len({d for d, i, _, _ in found if d == i}) >= 90, (n, len(found))


@pytest.mark.parametrize("rest", ["absent", "there"])
def test_items_that_begin_alike_take_bounded_memory(rest):
    """400 items of one beginning, in half a megabyte of it: with the items' other words absent, or all there."""
    items = [f"which of the x{i} y{i} z{i} u{i} v{i} w{i}" for i in range(400)]
    index = decontaminate.build_index(list(range(400)), items)
    others = [" ".join(x.split()[3:]) for x in items] if rest == "there" else []
    text = " ".join(["which of the " * 40_000, *others, items[7]])
    tracemalloc.start()
    found = decontaminate.matches(pa.array([text, items[3]]), index)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(0, 7, 0), (1, 3, 0)} <= {x[:3] for x in found}
    assert {i for d, i, _, _ in found if d == 0} <= set(range(400)) and peak < 300 << 20


def test_blocks_of_the_benchmark_give_the_same_rows(spark, monkeypatch):
    """Many small blocks, repeated items and a text id: the rows of one block, each copy once."""
    rng = np.random.default_rng(5)
    words = [f"v{i}" for i in range(60)]
    items = [" ".join(rng.choice(words, int(rng.integers(1, 20)))) for _ in range(60)]
    texts = [" ".join([*rng.choice(words, 30), items[i % 60], *rng.choice(words, 5)]) for i in range(40)]
    rows = [(f"b{i}", x) for i, x in enumerate(items)] + [("b3", items[3]), ("b4", "another one"), ("none", None), ("empty", "")]
    benchmark = spark.createDataFrame(rows, "item_id string, text string")
    docs = spark.createDataFrame([(i, x, "en", "s", 0) for i, x in enumerate([*texts, None, ""])], SCHEMA)
    whole = sorted(map(tuple, decontaminate.contamination(docs, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 40)
    assert sorted(map(tuple, decontaminate.contamination(docs, benchmark).collect())) == whole
    index = decontaminate.build_index([x[0] for x in rows], [x[1] or "" for x in rows])
    assert whole == sorted((d, rows[i][0], *x) for d, i, *x in decontaminate.matches(pa.array([*texts, None, ""]), index))
    clean = {r["doc_id"] for r in decontaminate.decontaminated(docs, benchmark).collect()}
    assert clean == set(range(42)) - {x[0] for x in whole}
    nothing = benchmark.where("item_id = 'none'")
    assert decontaminate.contamination(docs, nothing).count() == 0 and decontaminate.decontaminated(docs, nothing).count() == 42


def test_short_items_are_found():
    """At 25 per cent one edit in items of 4 to 7 words, none below; an item without words is nowhere."""
    words = "zero one two three four five six".split()
    items = [" ".join(words[:n]) for n in range(8)]
    index = decontaminate.build_index(list(range(8)), items)
    for n in range(1, 8):
        edited = [*words[: n - 1], "new"]
        found = decontaminate.matches(pa.array([" ".join(["x", *body, "y"]) for body in (words[:n], edited, [])]), index)
        distances = {(doc, item): distance for doc, item, distance, _ in found}
        assert distances[0, n] == 0 and distances.get((1, n)) == (1 if n >= 4 else None)
        assert not any(item == 0 or doc == 2 for doc, item in distances)


def test_blocks_of_a_page():
    page = "<html><!-- x --><script>var a='</p>'</script><ul><li><a href='>'>A</a><li>B</ul><p>c&amp;d <b>e</b>f<br>g<p>h"
    assert [b.text for b in html_text.blocks(page)] == ["A", "B", "c&d ef", "g", "h"]


@pytest.mark.parametrize(
    "page, expected",
    [
        ('<p>one <svg class="i"/> two</p><p>three</p>', ["one two", "three"]),
        ("<p>a<math/>b</p><object data='x'/><p>c</p>", ["ab", "c"]),
        ("<p>energy <math><mi>E</mi><mo>=</mo><mn>1</mn></math> holds<p>next", ["energy E=1 holds", "next"]),
        ("<p>one <svg><title>icon</title><path d='M0'/></svg> two</p>", ["icon", "one two"]),
        ("<object-card>kept</object-card><style-guide>too</style-guide><script>no</script><style>no</style>", ["kept", "too"]),
        ("<p>one <svg> two</p><p>three</p>", ["two", "one", "three"]),
        ("<div>one <math><mi>x</div><div>three</div>", ["one x", "three"]),
        ("<svg><p>one</p><p>two</p>", ["one", "two"]),
        ("<article>one <object><p>fallback</p></article><p>two", ["fallback", "one", "two"]),
        ("<p>one <noscript>off</noscript><iframe src=x></iframe> two <canvas>old</canvas></p><template>t</template>", ["off", "old", "one two", "t"]),
    ],
)
def test_embedded_elements_cut_nothing(page, expected):
    assert [b.text for b in html_text.blocks(page)] == expected


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<p>one <!--> two</p><p>three</p>", ["one two", "three"]),
        ("<p>one <!---> two</p>", ["one two"]),
        ("<p>one<!-- a > b --!> two<p>three<!-- -- ->x-->", ["one two", "three"]),
        ("<p>a<![CDATA[x>b</p>c", ["ab", "c"]),
        ("<p>a</ >b</3>c<?pi x>d<!doctype y>e", ["abcde"]),
        ("1 < 2 and <3 or a<", ["1 < 2 and <3 or a<"]),
        ("<p title='a>b'>x<p title='never>y</p>z", ["x", "y", "z"]),
        ("<p>a<script x='>'>if (a</b) {}</script >b<style>c", ["ab"]),
        ("<p>a<script>never ends</p>", ["a"]),
    ],
)
def test_marks_that_are_no_tags_cut_nothing(page, expected):
    assert [b.text for b in html_text.blocks(page)] == expected


@pytest.mark.parametrize("kind", ["<a ", "<div>x", "<svg>x", "</x>", '<a "x" ', '<a ">', "<p>a<b '\">", "<!-- ", "<table><tr><td>y", "<math><mi>x", "<object>z", "<a>x", "<li>q", "<![CDATA["])
def test_broken_pages_take_linear_time(kind):
    """Half a megabyte of one mark, and as many end tags that close nothing."""
    import time

    began = time.monotonic()
    found = html_text.blocks(kind * (500_000 // len(kind)) + "</y>" * 20_000)
    assert time.monotonic() - began < 20
    if kind in ("<div>x", "<svg>x", "<object>z", "<table><tr><td>y", "<li>q"):
        assert len("".join(b.text for b in found)) == kind.count(kind[-1]) * (500_000 // len(kind))


def test_a_page_s_words_are_those_of_a_plain_parser():
    """All text outside script and style, in the order of the page, on pages with every kind of element."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.off = [], 0

        def handle_starttag(self, tag, attrs):
            self.off += tag in ("script", "style")

        def handle_endtag(self, tag):
            self.off -= tag in ("script", "style") and self.off > 0

        def handle_data(self, data):
            if not self.off:
                self.out.append(data)

    rng = np.random.default_rng(4)
    tags = "p div b a li ul table tr td section span h2 em article".split()
    for _ in range(200):
        page, open_ = [], []
        for i in range(60):
            kind = rng.integers(6)
            if kind == 0 and open_:
                page.append(f"</{open_.pop()}>")
            elif kind <= 2:
                open_.append(str(rng.choice(tags)))
                page.append(f"<{open_[-1]} class='c{i}' data-x=\"a > b\">")
            elif kind == 3:
                page.append(str(rng.choice(["<!-- x > y -->", "<script>var a = '<p>';</script>", "<br>", "<img src=x/>", "<!doctype html>", "<style>p > b {}</style>"])))
            else:
                page.append(f"w{i}&amp;é ")
        plain = Plain()
        plain.feed("".join(page))
        plain.close()
        squeeze = lambda x: "".join(x.split())
        assert squeeze("".join(b.text for b in html_text.blocks("".join(page)))) == squeeze("".join(plain.out))


def thue_morse(n, a="a", b="b"):
    out = [bin(i).count("1") % 2 for i in range(n)]
    return [a if x else b for x in out], [b if x else a for x in out]


@pytest.mark.parametrize("n", [1024, 4096])
def test_self_similar_words_are_told_apart(spark, n):
    """A word and its complement, which sums modulo a power of two can't tell apart, in joins, windows and items."""
    one, two = ("".join(x) for x in thue_morse(n))
    assert one != two
    before = [f"x{i}" for i in range(49)]
    rows = [(1, one), (2, two), (3, one.upper()), (4, " ".join([*before, one])), (5, " ".join([*before, two])), (6, " ".join([*before, one]))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join(docs).collect()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 4, 6: 4}
    assert {r["doc_id"]: len(r["kept"].split()) for r in recompression_dedup(docs).collect()} == {1: 1, 2: 1, 3: 1, 4: 50, 5: 50, 6: 0}
    index = decontaminate.build_index([1], [f"q r s {one}"])
    found = decontaminate.matches(pa.array([f"q r s {one}", f"q r s {two}", f"q r {two}"]), index)
    assert [(doc, distance) for doc, _, distance, _ in found] == [(0, 0), (1, 1)]


@pytest.mark.parametrize("width", [64, 65, 1000, 2048])
def test_wide_windows_equal_brute_force(spark, width):
    words = thue_morse(2048)
    texts = [" ".join(words[0]), " ".join(words[1]), " ".join(["z", *words[0], "y"]), "".join(words[0]), "".join(words[1]), "q" + "".join(words[0])]
    docs = spark.createDataFrame([(i, x, "en", "s", 0) for i, x in enumerate(texts)], SCHEMA)
    for found, units in (
        (suffix_dedup.suffix_dedup(docs, width), {i: x.encode() for i, x in enumerate(texts)}),
        (recompression_dedup(docs, width), {i: tuple(x.split()) for i, x in enumerate(texts)}),
    ):
        kept = brute(units, width)
        for row in found.collect():
            own = row["kept"].split() if isinstance(row["kept"], str) else list(row["kept"])
            assert own == kept[row["doc_id"]]
            assert row["n_units"] == len(units[row["doc_id"]]) and row["n_units"] - len(own) == sum(s["stop"] - s["start"] for s in row["spans"])
            assert all(a["stop"] < b["start"] for a, b in zip(row["spans"], row["spans"][1:]))
