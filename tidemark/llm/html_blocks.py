"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its text blocks. Each block has a vector of its tag path (tag
names, words of class and id, hashed; the kinds of container it lies in), of its words (hashed)
and of a few sizes. A bidirectional LSTM in numpy reads the whole sequence, so the label of a
block depends on everything before and after it, and calls each block main text or not.

Training labels come from the containers of a bounded sample of pages. Containers are renamed
and blocks copied into other kinds of container at random while training, so that the net
learns what kinds of container mean and does not rely on one site's names.
"""

from __future__ import annotations

import html.parser
import re
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, map_batches

#: Pages used for training, rounds over them and blocks of a training sequence.
TRAINING_PAGES, ROUNDS, LONGEST = 128, 15, 32
HIDDEN, HASHED, RATE = 16, 64, 0.02
#: Blocks, padding included, that are labelled together; a step takes some 3 KB.
CELLS = 8192

BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre search section select summary table tbody td textarea tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without text of their own in the page.
SILENT_TAGS = frozenset("script style template noscript head title svg math iframe object canvas audio video".split())
#: Elements that may stand in a head; any other one, or text, ends a head left open.
HEAD_TAGS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Foreign content ends where a block begins inside it; media left open end where a part of the page begins.
FOREIGN, MEDIA = ("svg", "math"), ("object", "canvas", "audio", "video")
PARTS = frozenset("article body footer h1 h2 header main nav section".split())
#: Blocks that end an open paragraph when they begin.
CLOSES_P = BLOCK_TAGS - {"body", "html", "option", "td", "th", "tr", "tbody", "thead", "tfoot"}
_NOT_P = BLOCK_TAGS - {"p"} | SILENT_TAGS

#: Words of tag names, classes and ids that tell what a container is for.
CONTAINERS = {
    "main": "article main content post entry story body text articlebody maincontent post-body",
    "menu": "nav menu navigation navbar breadcrumb breadcrumbs toc pagination pager header masthead topbar banner",
    "footer": "footer foot copyright colophon legal bottom",
    "side": "aside sidebar side widget related recommended recommendations teaser popular trending",
    "notice": "notice cookie cookies consent alert popup modal dialog gdpr overlay paywall disclaimer",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion adsense banner-ad",
    "form": "form search login signup subscribe newsletter input select textarea fieldset button",
    "comment": "comment comments reply replies disqus respond discussion commentlist",
    "share": "share social sharing tags meta byline author-box",
}
KINDS = tuple(CONTAINERS)
_KIND_OF = {word: kind for kind, listed in CONTAINERS.items() for word in listed.split()}
_PART = re.compile(r"[a-z0-9]+")


class Element:
    """An open element: its names, what it lies in, and the kinds of container from the outermost to it.

    Elements are shared by the blocks below them, so a page nested n deep takes n of them.
    """

    __slots__ = ("names", "above", "kinds", "inner")

    def __init__(self, names: tuple[str, ...], above: Element | None) -> None:
        self.names, self.above = names, above
        kind = kind_of(names) if names[0] not in ("html", "body") else None
        kinds = above.kinds if above else frozenset()
        self.kinds = kinds if kind is None or kind in kinds else kinds | {kind}
        self.inner = kind or (above.inner if above else None)


def element(*path: tuple[str, ...], above: Element | None = None) -> Element | None:
    """The innermost of some elements, outermost first."""
    for names in path:
        above = Element(names, above)
    return above


@dataclass
class Block:
    text: str
    #: The innermost open element; its names are its tag and the words of its class, id and role.
    at: Element | None
    linked: int = 0

    @property
    def kinds(self) -> frozenset[str]:
        return self.at.kinds if self.at else frozenset()

    @property
    def inner(self) -> str | None:
        return self.at.inner if self.at else None


def _names(tag: str, attrs: Sequence[tuple[str, str | None]]) -> tuple[str, ...]:
    told = [v.lower() for k, v in attrs if k in ("class", "id", "role") and v]
    whole = [w for v in told for w in v.split()]
    return (tag, *dict.fromkeys([*whole, *(p for w in whole for p in _PART.findall(w))]))


class _Reader(html.parser.HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[Element] = []
        self.count: Counter[str] = Counter()
        self.silent, self.links = 0, 0
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[Block] = []

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(text, self.open[-1] if self.open else None, self.linked))
        self.parts, self.linked = [], 0

    def _pop(self, tag: str) -> None:
        while self.open:
            name = self.open.pop().names[0]
            self.count[name] -= 1
            self.silent -= name in SILENT_TAGS
            self.links -= name == "a"
            if name == tag:
                return

    def _is_open(self, tag: str, until: frozenset[str] = frozenset()) -> bool:
        if not self.count[tag] or not until:
            return self.count[tag] > 0
        for opened in reversed(self.open):
            if opened.names[0] == tag:
                return True
            if opened.names[0] in until:
                return False
        return False

    def _end_silence(self, tag: str) -> None:
        """Close what was left open and hides text, where ``tag`` cannot stand inside it."""
        if self._is_open("head") and tag not in HEAD_TAGS and not self._is_open("template"):
            self._pop("head")
        for other in FOREIGN:
            if tag in BLOCK_TAGS and self._is_open(other) and not self._is_open("foreignobject"):
                self._pop(other)
        for other in MEDIA:
            if tag in PARTS and self._is_open(other):
                self._pop(other)

    def handle_starttag(self, tag: str, attrs) -> None:
        if self.silent:
            self._end_silence(tag)
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in BLOCK_TAGS:
            self.flush()
            if tag in CLOSES_P and self._is_open("p", _NOT_P):
                self._pop("p")
            if tag == "li" and self._is_open("li", frozenset(("ul", "ol"))):
                self._pop("li")
        if tag not in VOID_TAGS:
            self.open.append(Element(_names(tag, attrs), self.open[-1] if self.open else None))
            self.count[tag] += 1
            self.silent += tag in SILENT_TAGS
            self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and tag not in ("script", "style") and self.open and self.open[-1].names[0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
        if self._is_open(tag):
            self._pop(tag)

    def handle_data(self, data: str) -> None:
        if self.silent and self.open[-1].names[0] == "head" and not data.isspace():
            self._pop("head")
        if not self.silent:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, white space inside each turned into one space."""
    reader = _Reader()
    reader.feed(page)
    reader.close()
    reader.flush()
    return reader.blocks


def kind_of(names: Sequence[str]) -> str | None:
    """Kind of container an element is: its class and id come before its tag."""
    told = [_KIND_OF[n] for n in names[1:] if n in _KIND_OF]
    other = [k for k in told if k != "main"]
    return other[0] if other else told[0] if told else _KIND_OF.get(names[0])


def weak_label(block: Block) -> int:
    """Training label: main text is what lies in a main container and in no other kind inside it."""
    if block.inner:
        return int(block.inner == "main")
    return int(len(block.text) >= 80 and block.linked * 2 < len(block.text))


_SLOTS: dict[str, int] = {}


def _slot(word: str) -> int:
    if len(_SLOTS) > 200_000:
        _SLOTS.clear()
    value = _SLOTS.get(word)
    if value is None:
        value = _SLOTS[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % HASHED
    return value


def _path_vector(at: Element | None, told: dict[Element | None, np.ndarray]) -> np.ndarray:
    """Hashed names and kinds of a path, from the nearest element above whose vector is known."""
    if at not in told:
        new = []
        while at not in told:
            new.append(at)
            at = at.above
        vector = told[at]
        for done, inner in enumerate(reversed(new)):
            if done == 0 or done == len(new) - 1:
                vector = vector.copy()
            for name in inner.names:
                vector[_slot("<" + name)] = 1
            if done >= len(new) - 2:
                # Kept for the block's element and the one above it, which blocks beside it share.
                vector[HASHED:] = 0
                for kind in inner.kinds:
                    vector[HASHED + KINDS.index(kind)] = 1
                if inner.inner:
                    vector[HASHED + len(KINDS) + KINDS.index(inner.inner)] = 1
                told[inner] = vector
        at = new[0]
    return told[at]


WIDTH = 2 * HASHED + 2 * len(KINDS) + 5


def vectors(listed: Sequence[Block]) -> np.ndarray:
    """One row of features per block."""
    out = np.zeros((len(listed), WIDTH), np.float32)
    told: dict[Element | None, np.ndarray] = {None: np.zeros(HASHED + 2 * len(KINDS), np.float32)}
    for i, block in enumerate(listed):
        row = out[i]
        row[: HASHED + 2 * len(KINDS)] = _path_vector(block.at, told)
        found = block.text.split()
        counts = np.bincount([_slot(w) for w in found], minlength=HASHED)
        at = HASHED + 2 * len(KINDS)
        row[at : at + HASHED] = np.sqrt(counts / max(1, len(found)))
        row[at + HASHED :] = (
            np.log1p(len(found)) / 5,
            block.linked / max(1, len(block.text)),
            i / len(listed),
            block.text[-1:] in ".!?",
            bool(block.kinds),
        )
    return out


@dataclass
class Net:
    """Weights of a bidirectional LSTM with one output per step."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int = 7) -> Net:
        rng, out = np.random.default_rng(seed), {}
        for way in ("f", "b"):
            out[way + "x"] = rng.normal(0, 0.1, (WIDTH, 4 * HIDDEN))
            out[way + "h"] = rng.normal(0, 0.1, (HIDDEN, 4 * HIDDEN))
            out[way + "0"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        out["o"], out["o0"] = rng.normal(0, 0.1, 2 * HIDDEN), np.zeros(1)
        return cls(out)

    def _run(self, way: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """States of one direction over (page, step); masked steps leave the state as it was. ``keep``: what gradients need."""
        n, steps, _ = x.shape
        inner = x @ self.weights[way + "x"] + self.weights[way + "0"]
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        states, kept = np.zeros((n, steps, HIDDEN)), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = inner[:, t] + h @ self.weights[way + "h"]
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + i * g
            on = mask[:, t, None]
            if keep:
                kept.append((t, h, c, i, f, o, g, new))
            c = np.where(on, new, c)
            h = np.where(on, o * np.tanh(new), h)
            states[:, t] = h
        return states, kept

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        ahead, kept_f = self._run("f", x, mask, keep)
        back, kept_b = self._run("b", x, mask, keep)
        both = np.concatenate([ahead, back], axis=2)
        return 1 / (1 + np.exp(-(both @ self.weights["o"] + self.weights["o0"]))), both, (kept_f, kept_b)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, both, kept = self.forward(x, mask, keep=True)
        off = (p - y) * mask / max(1, mask.sum())
        out = {"o": np.einsum("nt,nth->h", off, both), "o0": np.array([off.sum()])}
        to_states = off[..., None] * self.weights["o"]
        for way, states, steps in (("f", to_states[..., :HIDDEN], kept[0]), ("b", to_states[..., HIDDEN:], kept[1])):
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN))
            dh, dc = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
            d_inner = np.zeros_like(self.weights[way + "h"])
            for t, h, c, i, f, o, g, new in reversed(steps):
                on = mask[:, t, None]
                dh = dh + states[:, t]
                tanh = np.tanh(new)
                d_new = np.where(on, dc + dh * o * (1 - tanh**2), 0)
                dz = np.concatenate(
                    [d_new * g * i * (1 - i), d_new * c * f * (1 - f), np.where(on, dh * tanh, 0) * o * (1 - o), d_new * i * (1 - g**2)], axis=1
                )
                dz_all[:, t] = dz
                d_inner += h.T @ dz
                dh = np.where(on, dz @ self.weights[way + "h"].T, dh)
                dc = np.where(on, d_new * f, dc)
            out[way + "h"] = d_inner
            out[way + "x"] = np.einsum("ntw,ntz->wz", x, dz_all, optimize=True)
            out[way + "0"] = dz_all.sum(axis=(0, 1))
        return out

    def label(self, pages: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Which blocks of each page are main text; pages of similar length are read together.

        A group has at most ``CELLS`` steps over all its pages, or is one page.
        """
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = [i for i in sorted(range(len(pages)), key=lambda i: -len(pages[i])) if len(pages[i])]
        while order:
            group = order[: max(1, CELLS // len(pages[order[0]]))]
            order = order[len(group) :]
            x, mask = _padded([pages[i] for i in group])
            p = self.forward(x, mask)[0]
            for row, i in enumerate(group):
                out[i] = p[row, : len(pages[i])] > 0.5
        return out


def _padded(pages: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, WIDTH)), np.zeros((len(pages), steps), bool)
    for i, page in enumerate(pages):
        x[i, : len(page)] = page
        mask[i, : len(page)] = True
    return x, mask


def _renamed(listed: Sequence[Block], rng: np.random.Generator) -> list[Block]:
    """The page with its containers renamed, and some blocks copied into containers of other kinds."""
    new: dict[Element | None, Element | None] = {None: None}
    names_of: dict[tuple[str, ...], tuple[str, ...]] = {}

    def other(names: tuple[str, ...]) -> tuple[str, ...]:
        if names not in names_of:
            kind = kind_of(names) if names[0] not in ("html", "body") else None
            words = CONTAINERS[kind].split() if kind else []
            names_of[names] = ("div", str(rng.choice(words))) if kind and rng.random() < 0.7 else names
        return names_of[names]

    def renamed(at: Element | None) -> Element | None:
        way = []
        while at not in new:
            way.append(at)
            at = at.above
        for inner in reversed(way):
            at = new[inner] = Element(other(inner.names), new[inner.above])
        return at if way else new[at]

    out = [Block(b.text, renamed(b.at), b.linked) for b in listed]
    texts = [b for b in out if "main" in b.kinds] or out
    for _ in range(int(rng.integers(0, 4)) if out else 0):
        kind = str(rng.choice(KINDS[1:]))
        wrap = ("div", str(rng.choice(CONTAINERS[kind].split())))
        copied = [texts[int(i)] for i in rng.integers(0, len(texts), int(rng.integers(1, 5)))]
        inside = rng.random() < 0.5
        at = int(rng.integers(0, len(out) + 1)) if not inside else out.index(copied[0]) + 1 if copied[0] in out else len(out)
        alone = element(("html",), ("body",))
        out[at:at] = [Block(b.text, element(wrap, ("p",), above=(b.at.above if b.at else None) if inside else alone), 0) for b in copied]
    return out


def train(pages: Sequence[str], rounds: int = ROUNDS, seed: int = 7) -> Net:
    """Fit a net to weak labels of the pages, by Adam over the whole sample in four parts a round."""
    net, rng = Net.new(seed), np.random.default_rng(seed)
    read = [b for b in map(blocks, pages) if b]
    if not read:
        return net
    mean = {k: np.zeros_like(v) for k, v in net.weights.items()}
    square = {k: np.zeros_like(v) for k, v in net.weights.items()}
    step = 0
    for _ in range(rounds):
        for part in np.array_split(rng.permutation(len(read)), 4):
            chosen = []
            for i in part:
                page = _renamed(read[i], rng)
                at = int(rng.integers(0, max(1, len(page) - LONGEST + 1)))
                chosen.append(page[at : at + LONGEST])
            if not chosen:
                continue
            x, mask = _padded([vectors(c) for c in chosen])
            y = np.zeros(mask.shape)
            for i, c in enumerate(chosen):
                y[i, : len(c)] = [weak_label(b) for b in c]
            step += 1
            for k, g in net.gradients(x, mask, y).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                net.weights[k] -= RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return net


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = TRAINING_PAGES) -> Net:
    """Train on at most ``sample`` pages, chosen by a hash of id and page."""
    some = pages.select(F.col(id_col).cast("string").alias("id"), F.col(html_col).alias("html")).where("html is not null")
    chosen = sorted((r["id"] or "", r["html"]) for r in hash_sample(some, sample).collect())
    return train([page for _, page in chosen])


def extract(pages: DataFrame, net: Net, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row; blocks are joined by one line feed.

    Null and empty pages, and pages without main text, give an empty text. Rows may repeat. A head,
    foreign content or media left open end where text or blocks begin that cannot stand in them. Work and memory
    grow in proportion to a page's blocks and its nesting.
    """
    handed = pages.sparkSession.sparkContext.broadcast(net)

    def make():
        def work(batch):
            read = [blocks(p or "") for p in batch.column(2).to_pylist()]
            labels = handed.value.label([vectors(b) for b in read])
            texts = ["\n".join(b.text for b, yes in zip(page, main) if yes) for page, main in zip(read, labels)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

        return work

    chosen = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind, url = (chosen.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    return map_batches(chosen, make, f"page_id {kind}, url {url}, text string, n_chars bigint")
