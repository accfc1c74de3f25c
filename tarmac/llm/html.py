"""Main text of web pages: the maximum-scoring run of words and tags.

A page is a sequence of words and tags. Words score positive and tags negative, and
words below an element whose name, class, id or role speaks for boilerplate score
negative as well. The weights are log-odds from labelled pages: a few written out in
``labelled_pages``, and a bounded sample of the given pages that mark their article
themselves. One linear scan finds the best contiguous run; of its blocks, those in
boilerplate elements are left out.

Tags are read by the rules of HTML: a quote opens a value only after an equals sign, and
only ``script``, ``style``, ``textarea`` and ``title`` hold raw text up to their end tag.
Other elements that hold no text (``_HIDDEN``) are left out with their content if they are
closed; one that is left open hides nothing. Time is linear in the page, however deep.

Defined results: a null or empty page, or one without words, has an empty text. Pages
cut off in the middle are read as far as they go, and pages of any length whole. Of runs
that score the same the first counts. Repeated rows are read one by one. An empty table
gives none; further columns of whatever name are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.labelled_pages import PAGES

#: Of the pages that mark their article, so many teach the weights, by the order of a hash.
SAMPLE = 2000
#: A word written out in ``labelled_pages`` counts as so many.
HAND_WEIGHT = 20

# Kinds of HTML elements.
_RAW = "script style textarea title".split()
_HIDDEN = "noscript template svg math iframe object canvas select".split()
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
_NAMED = set("nav header footer aside form button label menu dialog figcaption legend address".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)"
    r"(?P<attrs>(?:[^>=]+|=\s*+(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")
_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in _RAW}
_HIDDEN_TAG = re.compile(rf"<(/?)({'|'.join(_HIDDEN)})\b(?:[^>]*>|[^>]*\Z)", re.I)


def _hidden_ends(page: str) -> dict[int, int]:
    """Where each hidden element that is closed begins, and the place after its end tag."""
    out: dict[int, int] = {}
    opened: dict[str, list[int]] = {name: [] for name in _HIDDEN}
    for m in _HIDDEN_TAG.finditer(page):
        own = opened[m[2].lower()]
        if not m[1]:
            own.append(m.start())
        elif own:
            out[own.pop()] = m.end()
    return out


class Stack:
    """The open elements: their names, and the features of all around; each step is done in constant time on average."""

    def __init__(self) -> None:
        self.elements: list[tuple[str, frozenset[str]]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    @property
    def features(self) -> frozenset[str]:
        return self.elements[-1][1] if self.elements else frozenset()

    def push(self, name: str, own: set[str]) -> None:
        around = self.features
        self.places.setdefault(name, []).append(len(self.elements))
        if name in _BLOCKS:
            self.blocks.append(len(self.elements))
        self.elements.append((name, around if own <= around else around | own))

    def cut(self, name: str) -> None:
        """Close the last element of the name and all within."""
        k = self.places[name][-1]
        while len(self.elements) > k or self.elements and not self.elements[-1][0]:
            gone = self.elements.pop()[0]
            if gone:
                self.places[gone].pop()
            if self.blocks and self.blocks[-1] == len(self.elements):
                self.blocks.pop()

    def close(self, name: str) -> None:
        if not self.places.get(name):
            return
        k = self.places[name][-1]
        if name in _BLOCKS or not self.blocks or self.blocks[-1] < k:
            self.cut(name)
        else:  # an inline end tag does not close the blocks opened since
            self.places[name].pop()
            self.elements[k] = ("", self.elements[k][1])

    def linked(self) -> bool:
        return any(name == "a" for name, _ in self.elements[-3:])


@dataclass
class Block:
    """A block of text: words, whether it is a heading, the features of the elements around it, and linked words."""

    text: str
    features: frozenset[str]
    words: int = 0
    linked: int = 0
    tags: list[str] = field(default_factory=list)


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order, with the tags before each of them; the last may be empty."""
    page = page or ""
    out: list[Block] = []
    stack, hidden = Stack(), _hidden_ends(page)
    parts: list[str] = []
    tags: list[str] = []
    state = {"linked": 0, "features": frozenset()}

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, state["features"], text.count(" ") + 1, state["linked"], tags.copy()))
            tags.clear()
        parts.clear()
        state["linked"] = 0

    def add(text: str) -> None:
        if text:
            if not parts:
                state["features"] = stack.features
            parts.append(text)
            if stack.linked():
                state["linked"] += len(text.split())

    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if not m["close"] and name in _RAW:
            end = _END[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "head" or name in _HIDDEN:
            at = hidden.get(m.start(), at) if not m["close"] else at
            continue
        if name in _BLOCKS:
            flush()
        elif name == "br":
            parts.append(" ")
        tags.append(name)
        if m["close"]:
            stack.close(name)
        elif name not in _VOID:
            if name == "p" and stack.places.get("p"):
                stack.cut("p")
            around = stack.features
            inside = "article/" if {"article", "main"} & around else ""
            own = {f"{inside}{name}"} if name in _NAMED or name in ("article", "main") else set()
            for a in _ATTR.finditer(m["attrs"]):
                value = next((v for v in a.groups()[1:] if v is not None), "").lower()
                own |= {f".{w}" for w in _PARTS.findall(value)}
            own |= {name} & {"article", "main"}
            stack.push(name, own)
    flush()
    out.append(Block("", frozenset(), 0, 0, tags))
    return out


@dataclass
class Weights:
    """Log-odds of content against boilerplate, of features of elements and of tags."""

    features: dict[str, float]
    tags: dict[str, float]
    linked: float

    def boilerplate(self, block: Block) -> bool:
        return any(self.features.get(f, 0.0) <= BOILERPLATE for f in block.features)

    def word(self, block: Block) -> float:
        """The score of a word: 1, less for links, or a little below 0 in boilerplate, which a run may lead across."""
        if self.boilerplate(block):
            return -0.2
        return 1.0 - self.linked * block.linked / max(1, block.words)


#: Log-odds from which on an element is boilerplate, and the cost of a tag at least and at most.
BOILERPLATE, TAG_LEAST, TAG_MOST = -1.0, 0.02, 0.4


def label(page: str | None) -> list[tuple[Block, bool]]:
    """Blocks with their labels, of a page that marks its article."""
    return [(b, bool({"article", "main", ".mainlabel"} & b.features)) for b in blocks(page)]


def counts(labelled: list[tuple[Block, bool]], weight: int = 1) -> Counter:
    """How often each kind of feature, tag and word is content and is not."""
    out: Counter = Counter()
    for block, content in labelled:
        for f in block.features - {"article", "main", ".mainlabel", ".boilerlabel"}:
            out["feature", f, content] += weight * block.words
        for t in block.tags:
            out["tag", t, content] += weight
        out["word", "", content] += weight * block.words
        out["linked", "", content] += weight * block.linked
    return out


def weights(total: Counter) -> Weights:
    """Log-odds from counts."""
    content, rest = (total["word", "", side] + 1.0 for side in (True, False))
    odds = lambda kind, x: math.log((total[kind, x, True] + 0.5) / content) - math.log(
        (total[kind, x, False] + 0.5) / rest
    )
    names = lambda kind: {x for k, x, _ in total if k == kind}
    tags = {t: -min(TAG_MOST, max(TAG_LEAST, -odds("tag", t) / 4)) for t in names("tag")}
    linked = min(1.5, max(0.0, -odds("linked", "") / 2))
    return Weights({f: odds("feature", f) for f in names("feature")}, tags, linked)


def hand_counts() -> Counter:
    out: Counter = Counter()
    for page in PAGES:
        marked = [(b, ".boilerlabel" not in b.features and ".mainlabel" in b.features) for b in blocks(page)]
        out += counts(marked, HAND_WEIGHT)
    return out


def main_text(page: str | None, w: Weights) -> str:
    """The text of the best run of blocks."""
    own = blocks(page)
    # Each block scores the tags before it and its words. A run begins at a block and ends with one.
    best, best_run, score, start = 0.0, (0, 0), 0.0, 0
    for k, block in enumerate(own[:-1]):
        cost = sum(w.tags.get(t, -0.3) for t in block.tags)
        score += cost
        if score <= 0:
            score, start = 0.0, k
        score += block.words * w.word(block)
        if score > best:
            best, best_run = score, (start, k + 1)
    kept = [b.text for b in own[best_run[0] : best_run[1]] if not w.boilerplate(b)]
    return "\n".join(kept)


def learn(pages: DataFrame) -> Weights:
    """Weights from the labelled pages and a sample of the given pages that mark one article."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                total += counts(label(page.as_py()))
        rows = [(k, x, side, n) for (k, x, side), n in total.items()]
        types = (pa.string(), pa.string(), pa.bool_(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["kind", "name", "content", "n"]
        )

    marked = pages.filter(F.col("html").rlike(r"(?i)<(article|main)[\s>]")).select("html", F.xxhash64("html").alias("hash"))
    sample = marked.select("hash").distinct().orderBy("hash").limit(SAMPLE)  # a bound on what is broadcast
    own = marked.join(F.broadcast(sample), "hash", "left_semi").dropDuplicates(["hash"]).select("html")
    counted = own.mapInArrow(count, "kind string, name string, content boolean, n bigint")
    total = hand_counts()
    for kind, name, content, n in counted.groupBy("kind", "name", "content").agg(F.sum("n")).collect():
        total[kind, name, content] += n
    return weights(total)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(learn(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), shared.value) for p in batch.column(2)]
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    own = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "html")
    return own.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
