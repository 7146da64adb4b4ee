"""Main text of web pages by a linear-chain conditional random field.

A page is read as its leaf blocks, the stretches of text between block-level tags. Each block has features from
its ancestors' tags and class names and from its text; neighbouring blocks are linked by transition weights. The
weights are trained on labelled pages by maximum conditional likelihood (forward-backward), and the best labelling
of a page, main text or not, is decoded by Viterbi. Comments, scripts, styles and other content that is never
shown are no blocks at all.

Labelled pages are the seed layouts below, written for training and filled with text blocks, and a bounded sample
of the corpus, in which the mark-up itself tells the label: what stands in an ``article`` or ``main`` and in no
part that is marked as something else.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import pieces

CELLS = 1 << 15

#: Elements of HTML. Inline ones do not end a block; the text of hidden ones is never shown; void ones
#: have no end tag; an open paragraph ends where one of ``ENDS_P`` starts.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder svg g "
    "tspan object noscript".split()
)
HIDDEN = frozenset("head iframe noembed noframes script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split()
)
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())

_NAME = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")

#: Words in tag, class and id names that mark a part as no main text, for labels of the sample.
OTHER = frozenset(
    "nav menu header footer aside sidebar ad ads advert advertisement banner sponsor promo form search login newsletter "
    "subscribe cookie consent notice alert popup modal comment comments reply replies related share social breadcrumb "
    "pagination widget toolbar dialog copyright".split()
)
MAIN = frozenset({"article", "main"})


class Node:
    """An open element. ``fresh`` are its tag and names that none of its ancestors has, of those that count with it: inside
    an outermost ``article`` or ``main`` the names above that are kept apart."""

    __slots__ = ("parent", "tag", "names", "fresh", "inner", "main", "other", "number")

    def __init__(self, parent: Node | None, tag: str, names: list[str], fresh: list[str], number: int):
        self.parent, self.tag, self.names, self.fresh, self.number = parent, tag, names, fresh, number
        self.inner = tag if tag not in INLINE else parent.inner if parent else ""
        #: The outermost article or main element, and whether a part in it, or any part outside of one, is marked as other.
        self.main: Node | None = parent.main if parent and parent.main else self if tag in MAIN else None
        above = parent.other if parent and self.main is not self else False
        own = () if tag in ("html", "body") or (tag == "main" and self.main is self) else {tag, *names}
        self.other: bool = above or not OTHER.isdisjoint(own)


@dataclass
class Block:
    text: str
    node: Node | None  # innermost open element
    linked: int  # characters inside links

    def features(self) -> set[str]:
        """Tags and names of the ancestors; those above an outermost article or main are other ones."""
        out, node, kind = set(), self.node, "in"
        while node is not None:
            out |= {f"{kind} {p}" for p in (node.tag, *node.names)}
            if node.tag in MAIN and node.main is node:
                kind = "above"
            node = node.parent
        return out

    @property
    def inner(self) -> str:
        return self.node.inner if self.node else ""


#: Elements in which an open paragraph outside is not ended by a new one.
SCOPE = ("table", "td", "th", "caption", "button", "object", "marquee", "applet")


class _Page:
    """Reads a page once from left to right; each step takes as long as what it consumes."""

    def __init__(self, page: str, plain: bool = False):
        self.page, self.plain = page, plain
        self.blocks: list[Block] = []
        self.open: list[Node] = []
        self.depths: dict[str, list[int]] = {}  # of the open elements, by tag
        self.nodes: list[Node] = []
        self.counts: list[dict[str, int]] = [{}]  # names outside, and inside an outermost article or main
        self.hidden = self.links = self.linked = 0
        self.held: list[str] = []
        self.quotes = True

    def flush(self) -> None:
        if self.held:
            text = " ".join(html.unescape("".join(self.held)).split())
            if text:
                self.blocks.append(Block(text, self.open[-1] if self.open else None, min(self.linked, len(text))))
            self.held.clear()
        self.linked = 0

    def text(self, piece: str) -> None:
        if piece and not self.hidden:
            self.held.append(piece)
            self.linked += len(piece) if self.links else 0

    def enter(self, tag: str, names: list[str]) -> None:
        if self.plain and tag in MAIN:
            tag = "div"
        parent = self.open[-1] if self.open else None
        if tag in MAIN and not (parent and parent.main):
            self.counts.append({})
        counts, fresh = self.counts[-1], []
        for name in {tag: None, **dict.fromkeys(names)}:
            counts[name] = counts.get(name, 0) + 1
            if counts[name] == 1:
                fresh.append(name)
        node = Node(parent, tag, names, fresh, len(self.nodes))
        self.nodes.append(node)
        self.depths.setdefault(tag, []).append(len(self.open))
        self.open.append(node)
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def close(self, depth: int) -> None:
        while len(self.open) > depth:
            node = self.open.pop()
            self.depths[node.tag].pop()
            counts = self.counts[-1]
            for name in {node.tag, *node.names}:
                counts[name] -= 1
            if node.main is node:
                self.counts.pop()
            self.hidden -= node.tag in HIDDEN
            self.links -= node.tag == "a"

    def last(self, *tags: str) -> int:
        """Depth of the innermost open element of these tags; -1 if there is none."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=-1)

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag at ``at``, outside quoted values; -1 if there is none. Where a quoted value
        never ends, quotes are ordinary characters from there on."""
        first = end = self.page.find(">", at)
        while self.quotes and end >= 0:
            marks = [p for p in (self.page.find('"', at, end), self.page.find("'", at, end)) if p >= 0]
            if not marks:
                return end
            mark = min(marks)
            at = self.page.find(self.page[mark], mark + 1) + 1
            end = self.page.find(">", at) if at else -1
        if end < 0 <= first:
            self.quotes = False
        return first if end < 0 else end

    def read(self) -> _Page:
        page, at, end = self.page, 0, len(self.page)
        while at < end:
            begin = page.find("<", at)
            self.text(page[at : begin if begin >= 0 else end])
            if begin < 0:
                break
            if page.startswith("<!--", begin):
                stop = page.find("-->", begin + 4)
                at = stop + 3 if stop >= 0 else end
                continue
            found = _TAG.match(page, begin, begin + 200)
            stop = self.tag_end(begin) if found else page.find(">", begin) if page[begin + 1 : begin + 2] in ("!", "?") else -2
            if stop == -1 and found:  # no tag can end any more
                self.text(page[begin:])
                break
            if stop < 0:
                self.text("<")
                at = begin + 1
                continue
            at = stop + 1
            if found:
                at = self.element(found[1] == "/", page[begin + 1 + len(found[1]) : stop], at)
        self.flush()
        return self

    def element(self, closing: bool, inside: str, at: int) -> int:
        """A tag, and where to read on."""
        parts = re.split(r"[\s/]", inside, maxsplit=1)
        tag = parts[0].lower()
        if tag == "br" and not self.hidden:
            self.held.append(" ")
        if tag not in INLINE and tag != "br":
            self.flush()
        if closing:
            depth = self.last("div" if self.plain and tag in MAIN else tag)
            if depth >= 0:
                self.close(depth)
            return at
        if tag in VOID:
            return at
        if tag in ENDS_P and self.last("p") > self.last(*SCOPE):
            self.close(self.last("p"))
        if tag in ("li", "dt", "dd", "option"):
            # a new item ends an open one of the same list
            depth = self.last("dt", "dd", "dl") if tag in ("dt", "dd") else self.last(tag, "ul", "ol", "select")
            if depth > self.last(*SCOPE) and self.open[depth].tag in ("li", "dt", "dd", "option"):
                self.close(depth)
        names = [w.lower() for n in _NAME.findall(" " + parts[1]) for w in _PART.findall(" ".join(n))] if len(parts) > 1 else []
        self.enter(tag, names)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(self.page, at)
            self.text(self.page[at : stop.start() if stop else len(self.page)])
            at = stop.start() if stop else len(self.page)
        return at


def blocks(page: str, plain: bool = False) -> list[Block]:
    """Leaf blocks of a page, in order, with decoded and collapsed text; blank ones are left out.

    Broken pages are read on: an end tag closes the innermost open element of its name and all inside it, or is passed
    over; a ``<`` that starts no tag is text. Time and memory grow with the length of the page, whatever is in it.
    ``plain`` reads ``article`` and ``main`` as any other part.
    """
    return _Page(page, plain).read().blocks


def own_features(found: list[Block]) -> list[set[str]]:
    """Features of each block but those of its ancestors."""
    out, last = [], len(found) - 1
    for i, b in enumerate(found):
        size = len(b.text)
        words = b.text.count(" ") + 1
        out.append({
            f"tag {b.inner}", f"length {min(8, size.bit_length())}", f"words {min(7, words.bit_length())}",
            f"links {4 * b.linked // max(size, 1)}", f"stop {b.text[-1] in '.!?…。'}", f"first {i == 0}", f"last {i == last}",
            f"start {b.text[0] in '©→»•|'}", f"bar {'|' in b.text or '©' in b.text}", f"other {bool(b.node and b.node.other)}",
            "bias",
        })
    return out


def features(found: list[Block], bare: bool = False) -> list[np.ndarray]:
    """Feature cells of each block, for training; ``bare`` leaves the ancestors out."""
    if bare:
        found = [replace(b, node=None) for b in found]
    return [np.sort([_cell(n) for n in own | b.features()]) for own, b in zip(own_features(found), found, strict=True)]


@lru_cache(1 << 16)
def _cell(name: str) -> int:
    value = 14695981039346656037
    for b in name.encode():
        value = (value ^ b) * 1099511628211 & (2**64 - 1)
    return value >> 49


@dataclass(frozen=True)
class Crf:
    """Two labels, 0 other and 1 main text: a weight for each cell and label, and transition[from, to]."""

    weights: np.ndarray
    transition: np.ndarray

    def emissions(self, cells: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[c].sum(axis=0) for c in cells]).reshape(len(cells), 2)

    def page_emissions(self, page: _Page, known: dict[tuple, np.ndarray] | None = None) -> np.ndarray:
        """As ``emissions`` of the blocks' features, but an element's part is added up once, for all blocks in it; ``known``
        keeps what the same names add between calls."""
        known = {} if known is None else known
        if len(known) > 1 << 16:
            known.clear()

        def part(kind: str, names: list[str]) -> np.ndarray:
            key = kind, *names
            if key not in known:
                known[key] = self.weights[[_cell(f"{kind} {n}") for n in names]].sum(axis=0)
            return known[key]

        scores, above = np.zeros((len(page.nodes) + 1, 2)), np.zeros((len(page.nodes) + 1, 2))
        for k, node in enumerate(page.nodes):
            up = node.parent.number if node.parent else -1
            start = above[up] if node.main is node else scores[up]
            scores[k] = start + part("in", node.fresh)
            if node.main is None:
                above[k] = above[up] + part("above", node.fresh)
        own = [self.weights[[_cell(n) for n in names]].sum(axis=0) for names in own_features(page.blocks)]
        at = [b.node.number if b.node else -1 for b in page.blocks]
        return np.array(own).reshape(len(at), 2) + scores[at]

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Best labelling for the emissions; where two are equally good, 0 comes first."""
        if not len(scores):
            return np.zeros(0, np.int64)
        best, back = scores[0], np.zeros((len(scores), 2), np.int64)
        for i in range(1, len(scores)):
            through = best[:, None] + self.transition
            back[i] = through.argmax(axis=0)
            best = through.max(axis=0) + scores[i]
        labels = np.zeros(len(scores), np.int64)
        labels[-1] = best.argmax()
        for i in range(len(scores) - 1, 0, -1):
            labels[i - 1] = back[i, labels[i]]
        return labels


def fit(pages: list[tuple[list[np.ndarray], np.ndarray]], rounds: int = 30, step: float = 0.5, decay: float = 1e-5) -> Crf:
    """Maximum conditional likelihood by adaptive stochastic gradient steps, one page at a time, in a fixed order."""
    weights, transition = np.zeros((CELLS, 2)), np.zeros((2, 2))
    seen, seen_t = np.full((CELLS, 2), 1e-2), np.full((2, 2), 1e-2)
    order = np.random.default_rng(5)
    for _ in range(rounds):
        for at in order.permutation(len(pages)):
            cells, labels = pages[at]
            n = len(cells)
            if not n:
                continue
            scores = Crf(weights, transition).emissions(cells)
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = scores[0]
            for i in range(1, n):
                ahead[i] = scores[i] + np.logaddexp(ahead[i - 1, 0] + transition[0], ahead[i - 1, 1] + transition[1])
            for i in range(n - 2, -1, -1):
                onward = transition + scores[i + 1] + behind[i + 1]
                behind[i] = np.logaddexp(onward[:, 0], onward[:, 1])
            whole = np.logaddexp(*ahead[-1])
            gap = -np.exp(ahead + behind - whole)
            gap[np.arange(n), labels] += 1
            turn = np.zeros((2, 2))
            if n > 1:
                pairs = ahead[:-1, :, None] + transition + (scores + behind)[1:, None, :] - whole
                turn = -np.exp(pairs).sum(axis=0)
                np.add.at(turn, (labels[:-1], labels[1:]), 1)
            slope: dict[int, np.ndarray] = {}
            for c, g in zip(cells, gap, strict=True):
                for cell in c.tolist():
                    slope[cell] = slope.get(cell, 0) + g
            where = np.fromiter(slope, np.int64)
            g = np.array(list(slope.values())) - decay * weights[where]
            seen[where] += g * g
            weights[where] += step * g / np.sqrt(seen[where])
            seen_t += turn * turn
            transition += step * turn / np.sqrt(seen_t)
    return Crf(weights.astype(np.float32), transition)


#: Labelled layouts: (mark-up, blocks of main text are in {m}, all others in {o}).
SEEDS = [
    '<header class="site-header"><h1>{o}</h1><nav><div><a href="/">{o}</a></div><div><a>{o}</a></div></nav></header><main><h1>{m}</h1><p>{m}</p>'
    "<p>{m}</p><h2>{m}</h2><p>{m}</p></main><footer>{o}</footer>",
    '<div id="cookie-notice"><p>{o}</p><button>{o}</button></div><nav><ul><li><a>{o}</a></li><li><a>{o}</a></li></ul></nav>'
    '<article><h1>{m}</h1><p>{m}</p><div class="ad">{o}</div><p>{m}</p><ul><li>{m}</li><li>{m}</li></ul></article>'
    '<aside class="sidebar"><h3>{o}</h3><p>{o}</p></aside><footer><p>{o}</p></footer>',
    '<div class="header"><div class="logo">{o}</div><ul class="menu"><li><a>{o}</a></li><li><a>{o}</a></li></ul></div>'
    '<div id="content"><div class="post-body"><h1>{m}</h1><p>{m}</p><blockquote>{m}</blockquote><p>{m}</p></div>'
    '<div id="comments"><h3>{o}</h3><div class="comment"><p>{o}</p></div><div class="comment"><p>{o}</p></div></div></div>'
    '<div class="sidebar widget"><p>{o}</p></div><div class="footer">{o}</div>',
    '<article class="post"><header><h1>{m}</h1></header><p>{m}</p><pre>{m}</pre><table><tr><td>{m}</td><td>{m}</td></tr></table>'
    '<section class="comments"><p>{o}</p><p>{o}</p></section><form><label>{o}</label><p>{o}</p><button>{o}</button></form>'
    "</article><footer>{o}</footer>",
    '<div role="banner"><p>{o}</p></div><div class="breadcrumb"><a>{o}</a></div><div class="article-content"><h2>{m}</h2><p>{m}</p>'
    '<p>{m}</p><figure><figcaption>{m}</figcaption></figure></div><ul class="related"><li><a>{o}</a></li><li><a>{o}</a></li></ul>'
    '<div class="share social">{o}</div><div class="newsletter"><form><p>{o}</p></form></div><div id="footer"><p>{o}</p></div>',
    '<table><tr><td class="nav"><a>{o}</a></td><td class="main"><p>{m}</p><p>{m}</p></td></tr></table><p class="copyright">{o}</p>',
    '<div class="alert notice">{o}</div><div class="ads"><p>{o}</p></div><section id="main"><h1>{m}</h1><p>{m}</p><p>{m}</p>'
    '<div class="sponsor">{o}</div><p>{m}</p></section><div class="popup modal"><p>{o}</p></div><footer>{o}</footer>',
    "<nav>{o}</nav><h1>{m}</h1><p>{m}</p><p>{m}</p><hr><p>{m}</p><footer>{o}</footer>",
]


def seed_pages(texts: list[str]) -> list[tuple[list[np.ndarray], np.ndarray]]:
    """The seed layouts filled with ``texts``, with the label of each block; every third one goes without its
    ancestors, so that the text's own features are learnt, too."""
    out, at = [], 0
    for number, layout in enumerate(SEEDS * 3):
        parts, wanted = re.split(r"(\{[mo]\})", layout), []
        for i, part in enumerate(parts):
            if part in ("{m}", "{o}"):
                wanted.append(int(part == "{m}"))
                text = texts[at % len(texts)]
                # main text runs long as a rule, other text short, but not always
                parts[i] = html.escape(text if wanted[-1] or at % 3 == 0 else " ".join(text.split()[: 1 + at % 6]))
                at += 1
        found = blocks("<body>" + "".join(f"{p}" for p in parts) + "</body>")
        if len(found) == len(wanted):  # a text with nothing to show is no block
            out.append((features(found, bare=number % 3 == 1), np.array(wanted)))
    return out


def marked_labels(found: list[Block]) -> np.ndarray | None:
    """Labels where the mark-up tells them; None for a page that has no part marked as main text. Only names between an
    article or main element and the block, an article's own among them, mark a part of it as other."""
    main = [b.node is not None and b.node.main is not None and not b.node.other for b in found]
    return np.array(main, np.int64) if any(main) else None


def train(pages: DataFrame, sample_pages: int = 300, most_names: int = 200_000) -> Crf:
    """Model from the seed layouts and about ``sample_pages`` pages, chosen by a hash of their html. Pages with more than
    ``most_names`` names over all their blocks, which is beyond any sound page, are no examples.

    Every second sampled page has its ``article`` and ``main`` elements renamed, so that the other evidence learns, too.
    """
    some = pages.where(F.col("html").isNotNull())
    share = min(1.0, sample_pages / max(some.count(), 1))
    chosen = some.where(F.pmod(F.xxhash64("html", F.lit(9)), F.lit(1 << 30)) < int(share * (1 << 30)))
    labelled: list[tuple[list[np.ndarray], np.ndarray]] = []
    texts: list[str] = []
    for i, row in enumerate(chosen.select("html").distinct().orderBy(F.xxhash64("html"), "html").collect()):
        page = _Page(row["html"]).read()
        found, labels = page.blocks, marked_labels(page.blocks)
        if labels is not None and len(found) * sum(1 + len(n.names) for n in page.nodes) <= most_names * 50:
            texts += [b.text for b in found]
            labelled.append((features(blocks(row["html"], plain=True) if i % 2 else found), labels))
    filler = ["A sentence of some length that ends with a stop, and another one.", "Two words"]
    return fit(seed_pages(texts or filler) + labelled)


def extract(pages: DataFrame, model: Crf) -> DataFrame:
    """``pages`` (html and any other columns) with __text: the main text's blocks, joined by single spaces.

    A null or empty page, or one without main text, gives an empty text. Columns of ``pages`` stay as they are.
    """
    place = pages.columns.index("html")
    shared = pages.sparkSession.sparkContext.broadcast((model.weights, model.transition))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = Crf(*shared.value)
        known: dict[tuple, np.ndarray] = {}
        for batch in pieces(batches, place):
            texts = []
            for raw in batch.column(place).cast(pa.large_binary()).to_pylist():
                page = _Page(raw.decode("utf-8", "replace") if raw else "").read()
                labels = crf.decode(crf.page_emissions(page, known))
                texts.append(" ".join(b.text for b, main in zip(page.blocks, labels, strict=True) if main))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "__text"]
            )

    return pages.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in pages.dtypes) + ", __text string")
