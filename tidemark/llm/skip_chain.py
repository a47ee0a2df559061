"""Personal data: fixed patterns, and a skip-chain conditional random field over whole documents.

Nodes are the words of a document that hold a digit, an at sign or a plus; all other words are
fixed to "outside", so they split the chain and cost nothing. Neighbouring nodes share
transition potentials. Skip edges join each node to the one before with the same word, and to
the one before with the same shape, however far apart; they share agreement potentials, so
occurrences of one thing get one label. Marginals come from loopy message passing over
a document's nodes.

Labels for training come from the fixed patterns on a sample of documents of a stated size.
Features leave out what the patterns test (checksums, ranges of numbers) and are dropped at
random while training, so that the field also knows spellings the patterns miss. Its spans are
added where they meet no fixed span.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Spans, hash_sample, map_batches

KINDS = ("email", "ip", "card", "phone")
#: Documents with active words that training may read, and its length.
TRAINING_DOCS = 2000
ROUNDS, STEP, DECAY, DROPPED = 300, 0.5, 1e-3, 0.3
#: The marginal from which a label counts.
SURE = 0.9
#: Messages are passed until none changes by more; the limit is far beyond what a chain through all words needs.
TOLERANCE = 1e-4

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match never starts inside a run of digits, because the run's start would match as well.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ACTIVE = re.compile(r"[0-9@+]")
_EDGES = ".,;:!?\"'()[]{}<>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int, int]]:
    """Leftmost matches, found from the at signs so that long runs are read once."""
    found, after, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, 0, domain.end()))
            after = domain.end()
        at = text.find("@", max(at + 1, after))
    return found


def _plain_digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points; failing matches use up their text."""
    found = _emails(text) if "@" in text else []
    if _DIGIT.search(text) is None:
        return found
    for m in _IP.finditer(text):
        # Zeros go first: a part may have any number of them.
        parts = [part.lstrip("0") or "0" for part in m[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_plain_digits(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


@dataclass
class Graph:
    """Active words of one document: their spans, features and edges."""

    spans: np.ndarray
    features: np.ndarray
    chain: np.ndarray
    same: np.ndarray
    alike: np.ndarray


def _features(core: str, before: bool, after: bool) -> list[float]:
    digits = sum(c.isdigit() for c in core)
    letters = sum(c.isalpha() for c in core)
    dots, n = core.count("."), len(core)
    return [
        1.0,
        "@" in core,
        "+" in core,
        "-" in core,
        "(" in core or ")" in core,
        dots == 0,
        dots == 1,
        dots == 3,
        dots > 3,
        letters > 0 and digits > 0,
        letters == 0,
        digits == 0,
        digits in (1, 2),
        digits == 3,
        4 <= digits <= 6,
        7 <= digits <= 11,
        12 <= digits <= 19,
        digits > 19,
        digits == n,
        n > 24,
        "=" in core or ":" in core,
        "/" in core,
        before,
        after,
    ]


N_FEATURES = len(_features("x", False, False))


def graph(text: str) -> Graph | None:
    """The graph of a document; None without active words."""
    if _ACTIVE.search(text) is None:
        return None
    spans, places, cores = [], [], []
    for place, m in enumerate(_WORD.finditer(text)):
        if _ACTIVE.search(m[0]):
            left = len(m[0]) - len(m[0].lstrip(_EDGES))
            core = m[0].strip(_EDGES)
            if core:
                spans.append((m.start() + left, m.start() + left + len(core)))
                places.append(place)
                cores.append(m[0][left : left + len(core)] if m[0][left - 1 : left] != "(" else "(" + core)
    if not spans:
        return None
    where = np.array(places)
    chain = np.flatnonzero(np.diff(where) == 1)
    beside = np.zeros(len(where) + 1, bool)
    beside[chain + 1] = True
    features = np.array([_features(c, beside[i], beside[i + 1]) for i, c in enumerate(cores)], float)
    same, alike, seen, shaped = [], [], {}, {}
    for i, core in enumerate(cores):
        shape = _DIGIT.sub("9", core)
        if core in seen:
            same.append((seen[core], i))
        elif shape in shaped:
            alike.append((shaped[shape], i))
        seen[core] = shaped[shape] = i
    pairs = lambda p: np.array(p, int).reshape(-1, 2)
    return Graph(np.array(spans), features, np.stack([chain, chain + 1], axis=1), pairs(same), pairs(alike))


def node_labels(g: Graph, base: list[tuple[int, int, int]]) -> np.ndarray:
    """Label of each node (0 outside, else kind + 1) from spans that touch it."""
    labels = np.zeros(len(g.spans), int)
    for start, kind, end in base:
        labels[(g.spans[:, 0] < end) & (g.spans[:, 1] > start)] = kind + 1
    return labels


@dataclass
class Field:
    """Weights of the field: per feature and label, per neighbouring labels, per kind of agreement."""

    nodes: np.ndarray
    moves: np.ndarray
    agree: np.ndarray

    def marginals(self, g: Graph) -> np.ndarray:
        """Label probabilities of the nodes after loopy sum-product message passing.

        Passes go on until no message changes by more than ``TOLERANCE``, so that a sure mention reaches
        every later one; loops that never settle end after four passes a word.
        """
        n_labels = self.nodes.shape[1]
        equal = np.eye(n_labels)
        edges = np.concatenate([g.chain, g.same, g.alike])
        kinds = np.repeat([0, 1, 2], [len(g.chain), len(g.same), len(g.alike)])
        table = np.stack([self.moves, self.agree[0] * equal, self.agree[1] * equal])
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        pair = np.concatenate([table[kinds], table[kinds].transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        local = g.features @ self.nodes
        messages = np.zeros((len(source), n_labels))
        for _ in range(50 + 4 * len(local) if len(edges) else 0):
            belief = local.copy()
            np.add.at(belief, target, messages)
            out = belief[source] - messages[back]
            new = np.logaddexp.reduce(out[:, :, None] + pair, axis=1)
            step = 0.5 * (new - new.max(axis=1, keepdims=True) - messages)
            messages += step
            if np.abs(step).max() < TOLERANCE:
                break
        belief = local
        np.add.at(belief, target, messages)
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)


def train(examples: list[tuple[Graph, np.ndarray]], seed: int = 7) -> Field:
    """Weights by pseudo-likelihood: each node's label given its features and its neighbours' labels."""
    n_labels, rng = len(KINDS) + 1, np.random.default_rng(seed)
    if not examples:
        nodes = np.zeros((N_FEATURES, n_labels))
        nodes[0, 0] = 10.0
        return Field(nodes, np.zeros((n_labels, n_labels)), np.zeros(2))
    rows, targets = [], []
    for g, labels in examples:
        one = np.eye(n_labels)[labels]
        left, right, same, alike = (np.zeros((len(labels), n_labels)) for _ in range(4))
        left[g.chain[:, 1]] = one[g.chain[:, 0]]
        right[g.chain[:, 0]] = one[g.chain[:, 1]]
        for into, edges in ((same, g.same), (alike, g.alike)):
            np.add.at(into, edges[:, 0], one[edges[:, 1]])
            np.add.at(into, edges[:, 1], one[edges[:, 0]])
        rows.append(np.concatenate([g.features, left, right, same, alike], axis=1))
        targets.append(labels)
    x, y = np.concatenate(rows), np.eye(n_labels)[np.concatenate(targets)]
    f, k = N_FEATURES, n_labels
    field = Field(np.zeros((f, k)), np.zeros((k, k)), np.zeros(2))
    for _ in range(ROUNDS):
        kept = x.copy()
        # The first feature is the bias; agreement terms are dropped like the others.
        kept[:, 1:] *= rng.random((len(x), x.shape[1] - 1)) >= DROPPED
        left, right = kept[:, f : f + k], kept[:, f + k : f + 2 * k]
        same, alike = kept[:, f + 2 * k : f + 3 * k], kept[:, f + 3 * k :]
        scores = kept[:, :f] @ field.nodes + left @ field.moves + right @ field.moves.T + field.agree[0] * same + field.agree[1] * alike
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        off = (y - p / p.sum(axis=1, keepdims=True)) / len(x)
        field.nodes += STEP * (kept[:, :f].T @ off - DECAY * field.nodes)
        field.moves += STEP * (left.T @ off + off.T @ right - DECAY * field.moves)
        field.agree += STEP * (np.array([(same * off).sum(), (alike * off).sum()]) - DECAY * field.agree)
    return field


def more_spans(g: Graph, marginals: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of surely labelled nodes that meet no fixed span; neighbours with one label are one span."""
    label, sure = marginals.argmax(axis=1), marginals.max(axis=1) >= SURE
    beside, fixed = {int(b) for _, b in g.chain}, Spans(base)
    out: list[tuple[int, int, int]] = []
    last = -2
    for i in np.flatnonzero(sure & (label > 0)):
        start, end = (int(v) for v in g.spans[i])
        kind = int(label[i]) - 1
        if fixed.meet(start, end):
            continue
        if i in beside and last == i - 1 and out[-1][1] == kind:
            out[-1] = (out[-1][0], kind, end)
        else:
            out.append((start, kind, end))
        last = int(i)
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = TRAINING_DOCS) -> Field:
    """Train on at most ``sample`` documents with active words, chosen by a hash of id and text."""
    active = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@+]"))
    chosen = sorted((r["id"] or "", r["text"]) for r in hash_sample(active, sample).collect())
    graphs = [(graph(text), base_spans(text)) for _, text in chosen]
    return train([(g, node_labels(g, base)) for g, base in graphs if g is not None])


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``base`` and ``more`` spans (start, kind, end) per row.

    Null and empty texts have none; rows that repeat an id are read one by one.
    """
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    handed = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        def work(batch):
            base, more = [], []
            for text in batch.column(1).to_pylist():
                found = base_spans(text or "")
                g = graph(text or "")
                base.append(found)
                more.append(more_spans(g, handed.value.marginals(g), found) if g else [])
            listed = lambda spans: pa.array([[dict(zip(("start", "kind", "end"), s)) for s in row] for row in spans], span)
            yield pa.RecordBatch.from_arrays([batch.column(0), listed(base), listed(more)], ["doc_id", "base", "more"])

        return work

    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<start:int,kind:int,end:int>>"
    return map_batches(chosen, make, f"doc_id {kind}, base {spans}, more {spans}")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def report(found: DataFrame) -> DataFrame:
    """Counts of fixed kinds, digest of their spans, and all spans in order."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.sort_array(F.concat("base", "more"))).alias("spans"),
        F.size("more").cast("long").alias("n_more"),
    )
