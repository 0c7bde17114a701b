"""Main text of web pages by a recurrent block labeller.

A page is read as its leaf blocks: runs of text between block-level tags, each with the path of open elements. A block
becomes a vector: learned vectors of its path's tags, classes and ids and of its words (both hashed), and a few counts. A
bidirectional LSTM in numpy reads the page's blocks in order, and a logistic unit on both directions labels each one as main
text or not, so that what stands before and after counts.

It is trained on a bounded sample of the pages, labelled by what their markup says plainly (an article element, a menu), and on
pages made from the sample's words in other layouts: other containers, class names that say nothing, notices and
comments inside the article. There, the layout knows the label.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.llm import arrays
from surveyloom.llm.hashed import sigmoid
from surveyloom.session import ship_package

FIT_PAGES = 300
FIT_CHARS = 200_000
MADE_PAGES = 900
EPOCHS = 4
HIDDEN = 24
PATH_BINS, PATH_SIZE = 512, 20
WORD_BINS, WORD_SIZE = 1024, 12
COUNTS = 7

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: May stand inside a sentence; the text within is a block of its own beside it. In math, elements are parts of the sentence.
EMBEDDED = frozenset("canvas iframe noscript object svg template".split())
FOREIGN = frozenset(("math", "svg"))
#: Opening one of these ends open foreign elements, but for those that hold HTML again.
BREAKOUT = frozenset("article blockquote body center dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
HOLDS_HTML = frozenset(("annotation-xml", "foreignobject"))
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
STOP = re.compile("[>\"']")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in ("script", "style")}
COMMENT_END = re.compile("--!?>")
MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Opening one of these ends an open paragraph, and an open element of its own kind up to the container named.
ENDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",), "p": ()}


class Path:
    """An open element and those around it. What blocks take from a path is kept with each element, so that they share it."""

    __slots__ = ("tag", "depth", "bits", "label", "last")

    def __init__(self, parent: Path | None = None, tag: str = "", marks: tuple[str, ...] = ()):
        self.tag, self.depth, self.bits, self.label = tag, 0, 0, None
        if parent is not None:
            found = {f"t {tag}", *(f"m {mark}" for mark in marks)}
            parts = {part for mark in marks for part in re.split(r"[=_\-]", mark)[1:]}
            found.update(f"w {part}" for part in parts if part)
            if parent.depth:
                found.add(f"p {parent.tag} {tag}")
            self.depth, self.bits = parent.depth + 1, parent.bits
            for x in found:
                self.bits |= 1 << _bin(x)
            self.label = 0 if parts & OTHER_WORDS or tag in OTHER_TAGS else 1 if tag in MAIN_TAGS else parent.label
        self.last = _bin("e " + (f"{parent.tag} {tag}" if parent is not None and parent.depth else tag))


def _bin(feature: str) -> int:
    return zlib.crc32(feature.encode()) % PATH_BINS


@dataclass
class Block:
    text: str
    path: Path
    linked: int  # characters inside links


@dataclass
class Token:
    """A tag, or any other mark (without a tag) that parts text and is none itself."""

    start: int
    stop: int
    tag: str = ""
    end: bool = False
    rest: str = ""
    parts: bool = False  # of a tag that can't be read


def tokens(page: str) -> Iterator[Token]:
    """The page's tags and comments, in order; what lies between is text.

    One cursor goes through the page. A comment ends at --> or --!>, or at once as <!--> and <!--->; other marks that begin with <! or
    <?, and end tags without a name, end at the next >. Script and style go with what they hold. A quoted value that never ends,
    or behind which no tag ends, is not taken for quoted, up to where that was found. A < behind the last > is text.
    """
    last, at, plain = page.rfind(">"), 0, 0
    unquoted: set[str] = set()  # quotes that don't occur any more
    while True:
        start = page.find("<", at)
        if start < 0 or start > last:
            return
        at = start + 1
        following = page[at : at + 1]
        if following in ("!", "?"):
            if page.startswith("!--", at):
                if page.startswith((">", "->"), at + 3):
                    stop = page.index(">", at + 3) + 1
                else:
                    found = COMMENT_END.search(page, at + 3)
                    stop = found.end() if found else len(page)
            else:
                stop = page.index(">", at) + 1
            yield Token(start, stop)
            at = stop
            continue
        end = following == "/"
        name = NAME.match(page, at + end)
        if not name:
            if end:  # no tag, but no text either
                at = page.index(">", at) + 1
                yield Token(start, at)
            continue
        spot, parts = name.end(), False
        while True:
            found = STOP.search(page, spot)
            mark = found[0] if found else ""
            if mark == ">":
                stop = found.end()
                break
            close = -1
            if mark and mark not in unquoted and spot >= plain:
                close = page.find(mark, found.end())
                if close < 0:
                    unquoted.add(mark)
            if close < 0 or close > last:
                plain, parts = max(plain, close), True
                stop = page.index(">", name.end()) + 1
                break
            spot = close + 1
        tag = name[0].lower()
        if tag in RAW_END and not end:
            found = RAW_END[tag].search(page, stop)
            at = found.end() if found else len(page)
            yield Token(start, at)
            continue
        yield Token(start, stop, "" if parts else tag, end, page[name.end() : stop - 1], parts)
        at = stop


def blocks(page: str) -> list[Block]:
    """The page's leaf blocks, whole, in order, with character references decoded and white space folded."""
    out: list[Block] = []
    stack: list[Path] = [Path()]
    inner = [0]  # how many elements up to each place are no parts of a sentence
    known: dict[tuple[Path, str, str], Path] = {}
    places: dict[str, list[int]] = {}  # where each tag is on the stack
    parts: list[str] = []
    linked, at = 0, 0
    held: list[tuple[list[str], int]] = []  # the text around each open embedded element
    special: list[int] = []  # where embedded elements and math are on the stack

    def last(tag: str, after: int = 0) -> int | None:
        """The innermost open element of the tag, if it is above that place."""
        open_ = places.get(tag)
        return open_[-1] if open_ and open_[-1] > after else None

    def flush():
        nonlocal parts, linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, stack[-1], linked))
        parts, linked = [], 0

    def drop(index: int):
        while len(stack) > index:
            places[stack.pop().tag].pop()
            inner.pop()

    def close(index: int):
        nonlocal parts, linked
        while special and special[-1] >= index:
            outer = special.pop()
            if stack[outer].tag in EMBEDDED:
                flush()
                drop(outer)
                parts, linked = held.pop()
                # the text around is that of the elements outside; where one of them closes too, and is a block, it ends here
                if inner[-1] > inner[index - 1]:
                    flush()
        drop(index)

    for token in tokens(page):
        if token.start > at:
            piece = page[at : token.start]
            parts.append(piece)
            linked += len(piece) if last("a") is not None else 0
        at = token.stop
        tag = token.tag
        if not tag:
            if token.parts:
                flush()
            continue
        if special and not token.end and tag in BREAKOUT:
            while special and stack[special[-1]].tag in FOREIGN and all(last(x, special[-1] - 1) is None for x in HOLDS_HTML):
                close(special[-1])
        scope = special[-1] if special else 0  # what opens inside ends nothing outside
        found = last(tag) if token.end else None
        inline = tag in INLINE or tag in EMBEDDED or tag == "math"
        if special and stack[scope].tag == "math":
            inline = inline or not token.end and tag not in BREAKOUT or token.end and (found is None or found > scope)
        if not inline:
            flush()
        if token.end:
            if found is not None:
                close(found)
        elif tag not in VOID and not token.rest.endswith("/"):
            if not inline:
                open_p = last("p", scope)
                if open_p is not None:
                    close(open_p)
            if tag in ENDS:
                same = last(tag, scope)
                if same is not None and all((last(x, scope) or 0) < same for x in ENDS[tag]):
                    close(same)
            path = known.get((stack[-1], tag, token.rest))
            if path is None:
                marks = tuple(f"{a.lower()}={w}" for a, x, y, z in MARK.findall(token.rest) for w in (x or y or z).lower().split()) if token.rest else ()
                path = known[stack[-1], tag, token.rest] = Path(stack[-1], tag, marks)
            if tag in EMBEDDED:
                held.append((parts, linked))
                parts, linked = [], 0
            if tag in EMBEDDED or tag == "math":
                special.append(len(stack))
            places.setdefault(tag, []).append(len(stack))
            stack.append(path)
            inner.append(inner[-1] + (tag not in INLINE))
    if at < len(page):
        parts.append(page[at:])
    flush()
    close(1)
    flush()
    return out


def path_bins(paths: list[Path]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of paths: every element's tag and marks, the last two elements, and tags in a row. One list, and their sizes."""
    bins, sizes, step = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 1 << 14
    for low in range(0, len(paths), step):
        rows = b"".join((p.bits | 1 << p.last).to_bytes(PATH_BINS // 8, "little") for p in paths[low : low + step])
        has = np.unpackbits(np.frombuffer(rows, np.uint8).reshape(-1, PATH_BINS // 8), axis=1, bitorder="little")
        sizes.append(has.sum(axis=1, dtype=np.int64))
        bins.append(np.nonzero(has)[1])
    return np.concatenate(bins), np.concatenate(sizes)


@dataclass
class Encoded:
    """Blocks of some pages: hashed paths and words as lists one after another, counts, and each page's number of blocks."""

    paths: np.ndarray
    path_sizes: np.ndarray
    words: np.ndarray
    word_sizes: np.ndarray
    counts: np.ndarray
    sizes: np.ndarray


def encode(pages: list[list[Block]]) -> Encoded:
    flat = [b for page in pages for b in page]
    sizes = np.array([len(p) for p in pages], np.int64)
    bins, bin_sizes = path_bins([b.path for b in flat])
    text, offsets = arrays.text_bytes(pa.array([b.text for b in flat], pa.large_string()))
    starts, stops, bounds = arrays.word_spans(text, offsets)
    words = (arrays.word_hashes(text, starts, stops, lower=True) % arrays.U64(WORD_BINS)).astype(np.int64)
    word_sizes = np.diff(bounds)
    chars = np.array([len(b.text) for b in flat], float)
    place = np.concatenate([np.arange(n) / max(n - 1, 1) for n in sizes]) if len(sizes) else np.empty(0)
    ends = np.array([b.text[-1] in ".!?:;…\"'" for b in flat], float)
    counts = np.stack(
        [
            np.log1p(chars) / 5,
            np.log1p(word_sizes) / 4,
            np.array([b.linked for b in flat]) / np.maximum(chars, 1),
            place,
            ends,
            np.array([b.path.depth for b in flat]) / 10,
            np.ones(len(flat)),
        ],
        axis=1,
    ) if flat else np.empty((0, COUNTS))
    return Encoded(bins, bin_sizes, words, word_sizes, np.minimum(counts, 3), sizes)


def _means(table: np.ndarray, items: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The mean vector of each list of items; zero for an empty one."""
    out = np.zeros((len(sizes), table.shape[1]))
    some = np.flatnonzero(sizes)
    if len(some):
        first = np.concatenate(([0], np.cumsum(sizes)))[:-1][some]
        out[some] = np.add.reduceat(table[items], first, axis=0) / sizes[some, None]
    return out


class Labeller:
    """The model: two tables of vectors, an LSTM in each direction, and a logistic unit."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        width = PATH_SIZE + WORD_SIZE + COUNTS
        self.p = {"path": rng.normal(0, 0.1, (PATH_BINS, PATH_SIZE)), "word": rng.normal(0, 0.1, (WORD_BINS, WORD_SIZE)), "out": rng.normal(0, 0.1, 2 * HIDDEN), "bias": np.zeros(1)}
        for side in "fb":
            self.p[f"w{side}"] = rng.normal(0, 1 / np.sqrt(width), (width, 4 * HIDDEN))
            self.p[f"u{side}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            self.p[f"c{side}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)  # an open forget gate to begin with

    def inputs(self, e: Encoded) -> np.ndarray:
        return np.concatenate([_means(self.p["path"], e.paths, e.path_sizes), _means(self.p["word"], e.words, e.word_sizes), e.counts], axis=1)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """States of one direction over steps x pages; where the mask is 0 the state stays."""
        steps, pages, _ = x.shape
        h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
        driven = x @ self.p[f"w{side}"] + self.p[f"c{side}"]
        states, trace = np.zeros((steps, pages, HIDDEN)), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = driven[t] + h @ self.p[f"u{side}"]
            i, f, o = (sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + i * g
            lit = np.tanh(new)
            m = mask[t][:, None]
            trace.append((t, h, c, i, f, o, g, lit, m))
            h, c = m * (o * lit) + (1 - m) * h, m * new + (1 - m) * c
            states[t] = h
        return states, trace

    def _laid_out(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        steps = int(sizes.max())
        page = np.repeat(np.arange(len(sizes)), sizes)
        step = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out, mask = np.zeros((steps, len(sizes), x.shape[1])), np.zeros((steps, len(sizes)))
        out[step, page], mask[step, page] = x, 1
        return out, mask, step, page

    def predict(self, e: Encoded) -> np.ndarray:
        """The probability of main text for each block."""
        x = self.inputs(e)
        out = np.empty(len(x))
        first = np.cumsum(e.sizes) - e.sizes
        order = np.argsort(e.sizes, kind="stable")
        order = order[e.sizes[order] > 0]
        at = 0
        while at < len(order):  # pages of like length together, some 20,000 padded blocks at a time
            n = 1
            while at + n < len(order) and (n + 1) * e.sizes[order[at + n]] <= 20_000:
                n += 1
            some = order[at : at + n]
            rows = np.concatenate([np.arange(first[p], first[p] + e.sizes[p]) for p in some])
            laid, mask, step, page = self._laid_out(x[rows], e.sizes[some])
            states = np.concatenate([self._run(laid, mask, side)[0] for side in "fb"], axis=2)
            out[rows] = sigmoid(states[step, page] @ self.p["out"] + self.p["bias"][0])
            at += n
        return out

    def gradients(self, e: Encoded, labels: np.ndarray) -> dict[str, np.ndarray]:
        x = self.inputs(e)
        laid, mask, step, page = self._laid_out(x, e.sizes)
        runs = {side: self._run(laid, mask, side) for side in "fb"}
        states = np.concatenate([runs[side][0] for side in "fb"], axis=2)
        slope = (sigmoid(states[step, page] @ self.p["out"] + self.p["bias"][0]) - labels) / len(labels)
        grads = {"out": slope @ states[step, page], "bias": np.array([slope.sum()])}
        dx = np.zeros_like(laid)
        for number, side in enumerate("fb"):
            above = np.zeros_like(runs[side][0])
            above[step, page] = slope[:, None] * self.p["out"][number * HIDDEN : (number + 1) * HIDDEN]
            w, u = self.p[f"w{side}"], self.p[f"u{side}"]
            dw, du, dc_ = np.zeros_like(w), np.zeros_like(u), np.zeros(4 * HIDDEN)
            dh, dc = np.zeros_like(above[0]), np.zeros_like(above[0])
            for t, h, c, i, f, o, g, lit, m in reversed(runs[side][1]):
                dh = dh + above[t]
                into = dh * m
                dnew = into * o * (1 - lit * lit) + dc * m
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), into * lit * o * (1 - o), dnew * i * (1 - g * g)], axis=1)
                dw += laid[t].T @ dz
                du += h.T @ dz
                dc_ += dz.sum(axis=0)
                dx[t] += dz @ w.T
                dh = dh * (1 - m) + dz @ u.T
                dc = dc * (1 - m) + dnew * f
            grads |= {f"w{side}": dw, f"u{side}": du, f"c{side}": dc_}
        flat = dx[step, page]
        for name, items, sizes, part in (("path", e.paths, e.path_sizes, flat[:, :PATH_SIZE]), ("word", e.words, e.word_sizes, flat[:, PATH_SIZE : PATH_SIZE + WORD_SIZE])):
            grads[name] = np.zeros_like(self.p[name])
            np.add.at(grads[name], items, np.repeat(part / np.maximum(sizes, 1)[:, None], sizes, axis=0))
        return grads

    def fit(self, pages: list[list[Block]], labels: list[list[int]], epochs: int = EPOCHS, rate: float = 0.01, batch: int = 32) -> Labeller:
        """Adam over batches of pages."""
        rng = np.random.default_rng(11)
        first, second, n = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        use = [i for i, page in enumerate(pages) if page]
        for _ in range(epochs):
            order = rng.permutation(use)
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                grads = self.gradients(encode([pages[i] for i in some]), np.concatenate([labels[i] for i in some]).astype(float))
                n += 1
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.999**n)) + 1e-8)
        return self


#: What markup says plainly: elements and parts of class names or ids.
MAIN_TAGS = frozenset(("article", "main"))
OTHER_TAGS = frozenset("nav header footer aside form title button select textarea".split())
OTHER_WORDS = frozenset(
    "ad ads advert advertisement sponsored promo banner cookie consent notice alert nav navbar menu breadcrumb breadcrumbs sidebar widget related share social"
    " comment comments reply replies discussion respond footer header masthead newsletter subscribe signup login search toc pagination pager tags meta copyright".split()
)


class Layouts:
    """Pages made from given words, with the label of each block."""

    def __init__(self, words: list[str], seed: int = 3):
        self.words, self.rng = words or ["word"], random.Random(seed)
        self.html, self.labels = [], []

    def text(self, low: int, high: int) -> str:
        r = self.rng
        return " ".join(r.choice(self.words) for _ in range(r.randint(low, high))).capitalize() + r.choice(("", ".", ".", "!"))

    def put(self, tag: str, label: int, low: int, high: int, link: float = 0.0):
        text = html.escape(self.text(low, high))
        if self.rng.random() < link:
            text = f'<a href="/x">{text}</a>'
        self.html.append(f"<{tag}>{text}</{tag.split()[0]}>")
        self.labels.append(label)

    def boxed(self, box: str, inside):
        self.html.append(f"<{box}>")
        inside()
        self.html.append(f"</{box.split()[0]}>")

    def _name(self, *names: str) -> str:
        return f'{self.rng.choice(("class", "class", "id"))}="{self.rng.choice(names)}"'

    def links(self, n: int):
        r = self.rng
        if r.random() < 0.7:
            self.boxed("ul", lambda: [self.put("li", 0, 1, 4, 0.95) for _ in range(n)])
        else:
            for _ in range(n):
                self.put(r.choice(("div", "span", "p")) if r.random() < 0.5 else "div", 0, 1, 4, 0.95)

    def chrome(self):
        r = self.rng
        kind = r.randrange(9)
        if kind == 0:
            self.boxed(r.choice(("nav", "div " + self._name("menu", "nav", "navbar", "main-menu", "breadcrumb"))), lambda: self.links(r.randint(2, 8)))
        elif kind == 1:
            self.boxed(r.choice(("header", "div " + self._name("header", "masthead", "site-header"))), lambda: [self.put(r.choice(("h1", "div", "p")), 0, 1, 6), self.links(r.randint(0, 5))])
        elif kind == 2:
            self.boxed(r.choice(("footer", "div " + self._name("footer", "copyright", "page-footer"))), lambda: [self.put(r.choice(("p", "div", "small")), 0, 2, 20) for _ in range(r.randint(1, 3))])
        elif kind == 3:
            self.boxed(r.choice(("aside", "div " + self._name("sidebar", "widget", "related", "side"))), lambda: [self.put("h3", 0, 1, 4), self.links(r.randint(1, 6)), self.put("p", 0, 3, 30)])
        elif kind == 4:
            self.put(r.choice(("div", "p", "section")) + " " + self._name("ad", "ads", "advert", "sponsored", "promo", "ad-slot", "banner"), 0, 3, 30, 0.3)
        elif kind == 5:
            self.put(r.choice(("div", "p", "section")) + " " + self._name("cookie", "cookie-notice", "notice", "consent", "alert", "newsletter"), 0, 3, 30)
        elif kind == 6:
            self.boxed(r.choice(("form", "form " + self._name("search", "login", "subscribe"))), lambda: [self.put(r.choice(("div", "p", "button")), 0, 1, 8) for _ in range(r.randint(1, 4))])
        elif kind == 7:
            self.comments()
        else:
            self.boxed("div " + self._name("share", "social", "tags", "meta", "pagination"), lambda: self.links(r.randint(1, 5)))

    def comments(self):
        r = self.rng

        def one():
            self.boxed("div " + self._name("comment", "reply", "comment-body"), lambda: [self.put("p", 0, 3, 60) for _ in range(r.randint(1, 2))])

        self.boxed(r.choice(("section ", "div ", "ol ")) + self._name("comments", "discussion", "responses", "comment-list"), lambda: [self.put("h3", 0, 1, 4), *(one() for _ in range(r.randint(1, 5)))])

    def main(self, silent: bool):
        r = self.rng
        plain = ("div", 'div class="c1"', 'div class="box"', "section", 'td class="x"')
        told = ("article", "article", "main", 'div class="content"', 'div id="content"', 'div class="post"', 'div class="entry-content"', 'section class="article-body"', 'div class="story"', 'div itemprop="articleBody"')

        def inside():
            if r.random() < 0.7:
                self.put(r.choice(("h1", "h1", "h2")), 1, 2, 12)
            for _ in range(r.randint(1, 12)):
                kind = r.random()
                if kind < 0.72:
                    self.put("p", 1, *((1, 120) if not silent else (12, 120)), 0.02)
                elif kind < 0.78:
                    self.put(r.choice(("h2", "h3")), 1, 1, 8)
                elif kind < 0.84:
                    self.boxed(r.choice(("ul", "ol")), lambda: [self.put("li", 1, 3, 30) for _ in range(r.randint(2, 5))])
                elif kind < 0.88:
                    self.put(r.choice(("blockquote", "pre", "div", "figcaption")), 1, 5, 60)
                elif not silent and kind < 0.95:
                    self.chrome()

        self.boxed(r.choice(plain if silent else told), inside)

    def page(self) -> tuple[str, list[int]]:
        r = self.rng
        self.html, self.labels = ["<!DOCTYPE html><html><head>"], []
        self.put("title", 0, 2, 12)
        self.html.append("</head><body>")
        for _ in range(r.randint(1, 4)):
            self.chrome()
        self.main(silent=r.random() < 0.25)
        for _ in range(r.randint(0, 4)):
            self.chrome()
        self.html.append("</body></html>")
        return "".join(self.html), self.labels


def train(pages: list[str], made: int = MADE_PAGES) -> Labeller:
    """A labeller from some pages and as many made ones as asked for. Without pages, the made ones use one word."""
    read = [blocks(page) for page in pages]
    words = sorted({w for page in read for b in page[:40] for w in b.text.split()[:60]})[:20_000]
    examples, labels = [], []
    for page in read:
        known = [b.path.label for b in page]
        if any(known):  # a page on which nothing is said to be main text teaches nothing
            examples.append(page)
            labels.append([x or 0 for x in known])
    layouts = Layouts(words)
    for _ in range(made):
        page, own = layouts.page()
        found = blocks(page)
        if len(found) == len(own):
            examples.append(found)
            labels.append(own)
    return Labeller().fit(examples, labels)


def fit_labeller(pages: DataFrame, most: int = FIT_PAGES) -> Labeller:
    """Train on at most `most` whole pages of at most FIT_CHARS characters, those whose ids have the smallest digests."""
    chosen = pages.where(F.length("html") <= FIT_CHARS).select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(most)
    rows = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id").where(F.length("html") <= FIT_CHARS)
    found = rows.orderBy(F.xxhash64("page_id"), "page_id", F.xxhash64("html")).limit(most).collect()
    return train([r["html"] for r in found])


def main_text(pages: list[str], model: Labeller) -> list[str]:
    read = [blocks(page) for page in pages]
    keep = model.predict(encode(read)) >= 0.5
    out, at = [], 0
    for page in read:
        out.append(" ".join(b.text for b, k in zip(page, keep[at : at + len(page)]) if k))
        at += len(page)
    return out


def extract_text(pages: DataFrame, model: Labeller) -> DataFrame:
    """The columns of `pages` but html, and text, the main text of the whole html.

    A null html is empty; a page without main text gives an empty string.
    """
    ship_package(pages.sparkSession)
    rest = [x for x in pages.columns if x not in ("html", "text")]
    schema = T.StructType([*(pages.schema[x] for x in rest), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.parts(batches, "html"):
            texts = main_text([x or "" for x in part.column("html").to_pylist()], model)
            yield pa.RecordBatch.from_arrays([*(part.column(x) for x in rest), pa.array(texts, pa.string())], [*rest, "text"])

    return pages.select(*rest, "html").mapInArrow(arrays.released(run), schema)
