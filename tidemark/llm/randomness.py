"""Secrets: fixed patterns, and a battery of randomness tests under false-discovery control.

Long runs of key characters that hold digits are candidates. The encoding is inferred as the
smallest alphabet that has all their characters. Three tests ask whether the characters could
come from a uniform source: chi-squared over equal parts of the alphabet, runs above and
below its middle, and serial correlation of neighbours. Their p-values are combined to one
score; random strings score high, words low.

A candidate that passes the battery is compared with plain words: its p-value is its probability
under a character model of words and numbers over that under its alphabet. By Markov's inequality
a plain string has a ratio under r with probability r at most, at any length, so no words
have to be counted first. The corpus's own long words without digits correct the model, which
weighs as much as MODEL_WEIGHT of them; rules and dividers are no words. The Benjamini-Hochberg
step over the counted p-values of all candidates gives those accepted at the wanted
false-discovery rate. Only counts per length class and level, a few hundred at most, meet in one place.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Spans, map_batches

#: Fixed patterns. Their failing matches use up their text, so lengths are checked afterwards.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")
#: Candidates: runs of at least so many characters.
LEAST = 20
RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}}")
FALSE_DISCOVERIES = 0.01

#: Alphabets from small to large, each in its own order.
ENCODINGS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_ORDER = {name: {c: i for i, c in enumerate(letters)} for name, letters in ENCODINGS.items()}
#: Length classes by their lower ends, and levels of the p-value: two for each power of ten.
LENGTHS = (20, 24, 32, 40, 64)
BINS = 32
#: Scores under this are not random.
UNIFORM = 0.01
#: The character model weighs as much as so many of the corpus's words.
MODEL_WEIGHT = 10_000
#: The character model's letters follow each other as in these words.
WORDS = """the of and to in is that for it was on are as with his they at be this have from or one had by word but not
what all were we when your can said there use an each which she do how their if will up other about out many then them
these so some her would make like him into time has look two more write go see number no way could people my than first
water been call who oil its now find long down day did get come made may part over new sound take only little work know
place year live me back give most very after thing our just name good sentence man think say great where help through
much before line right too mean old any same tell boy follow came want show also around form three small set put end
does another well large must big even such because turn here why ask went men read need land different home us move try
kind hand picture again change off play spell air away animal house point page letter mother answer found study still
learn should system server config update client request response handler index value table user file data test error
message version service default process group report summary article section category product archive content queue
zone size journal exact quick jump fix max japan quiz""".split()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if any(len(w) >= 32 for w in text.split()):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def encoding(run: str) -> str | None:
    """Smallest alphabet with all characters of a run; padding does not count."""
    letters = set(run.rstrip("="))
    return next((name for name, order in _ORDER.items() if letters <= order.keys()), None)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(places: np.ndarray, size: int) -> tuple[float, float, float]:
    """p-values of uniformity, runs and serial correlation of places in an alphabet of ``size``."""
    n, parts = len(places), 8
    seen = np.bincount(places * parts // size, minlength=parts)
    expected = np.bincount(np.arange(size) * parts // size, minlength=parts) * n / size
    chi, free = float(((seen - expected) ** 2 / expected).sum()), parts - 1
    # Wilson and Hilferty: the cube root of chi-squared is nearly normal.
    z = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    uniform = 0.5 * math.erfc(z / math.sqrt(2))
    high = places * 2 >= size
    ups = int(high.sum())
    downs = n - ups
    runs = 1 + int((high[1:] != high[:-1]).sum())
    if ups and downs:
        mean = 1 + 2 * ups * downs / n
        spread = (mean - 1) * (mean - 2) / (n - 1)
        order = _two_sided((runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        order = 2.0 ** (1 - n)
    centred = places - places.mean()
    power = float((centred**2).sum())
    serial = _two_sided(float((centred[1:] * centred[:-1]).sum()) / power * math.sqrt(n)) if power > 0 else 0.0
    return uniform, order, serial


def score(run: str) -> float:
    """Combined p-value of the battery (Fisher): near 0 for words, anything up to 1 for random strings."""
    name = encoding(run)
    if name is None:
        return 0.0
    order = _ORDER[name]
    ps = battery(np.array([order[c] for c in run.rstrip("=")]), len(order))
    x = -2 * sum(math.log(max(p, 1e-300)) for p in ps)
    half = x / 2
    return math.exp(-half) * (1 + half + half * half / 2)


def _letter_costs() -> np.ndarray:
    """Minus log probabilities of a letter after a letter; row 26 has those of a letter after anything else."""
    pairs, firsts = np.full((27, 26), 0.5), np.zeros(26)
    for w in WORDS:
        at = [ord(c) - 97 for c in w]
        firsts[at[0]] += 1
        np.add.at(pairs, ([26] * len(at), at), 1)
        np.add.at(pairs, (at[:-1], at[1:]), 1)
    for w in WORDS:
        pairs[ord(w[-1]) - 97] += firsts / firsts.sum()
    return -np.log(pairs / pairs.sum(axis=1, keepdims=True))


_LETTERS = _letter_costs().tolist()
#: What follows a letter, digit or sign: a letter, a digit or a sign.
_NEXT = (-np.log([[0.86, 0.07, 0.07], [0.2, 0.7, 0.1], [0.8, 0.15, 0.05]])).tolist()
#: In strings of both cases: lower or upper after a lower letter, an upper one, or none.
_CASE = (-np.log([[0.85, 0.15], [0.6, 0.4], [0.5, 0.5]])).tolist()


def plain_cost(run: str) -> float:
    """Minus log probability of a run under the character model of words and numbers."""
    one_case = run in (run.lower(), run.upper())
    total, before, kind, case = 0.0, 26, 2, 2
    for c in run:
        now = 0 if c.isalpha() else 1 if c.isdigit() else 2
        total += _NEXT[kind][now]
        if now == 0:
            letter, up = ord(c.lower()) - 97, int(c.isupper())
            total += _LETTERS[before][letter] + (0.0 if one_case else _CASE[case][up])
            before, case = letter, up
        else:
            total += math.log(10) if now == 1 else math.log(4)
            before, case = 26, 2
        kind = now
    return total


def place(run: str) -> int:
    """Length class and level of a run as one number; a level of n means a p-value of at most 10^(-n/2)."""
    size, name, level = sum(len(run) >= low for low in LENGTHS) - 1, encoding(run), 0
    if name is not None and score(run) > UNIFORM:
        text = run.rstrip("=")
        # The alphabet is chosen by the run, one of all.
        gain = plain_cost(text) - len(text) * math.log(len(_ORDER[name])) - math.log(len(ENCODINGS))
        level = max(0, min(BINS - 1, math.floor(2 * gain / math.log(10))))
    return size * BINS + level


def word_like(run: str) -> bool:
    """Mostly letters, and not one character over and over: rules and dividers are no words."""
    return len(set(run)) > 1 and 2 * sum(c.isalpha() for c in run) > len(run)


def _describe(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], list[int]]:
    """Fixed spans, candidates (start, end, place) and the places of long words without digits."""
    base = base_spans(text)
    if not any(len(w) >= LEAST for w in text.split()):
        return base, [], []
    candidates, plain, fixed = [], [], Spans(base)
    for m in RUN.finditer(text):
        if any(c.isdigit() for c in m[0]):
            if not fixed.meet(m.start(), m.end()):
                candidates.append((m.start(), m.end(), place(m[0])))
        elif word_like(m[0]):
            plain.append(place(m[0]))
    return base, candidates, plain


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fixed spans, candidates and places of plain long words per row."""
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    run = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("place", pa.int32())])

    def make():
        def work(batch):
            rows = [_describe(t or "") for t in batch.column(1).to_pylist()]
            columns = [
                batch.column(0),
                pa.array([[dict(zip(("start", "kind", "end"), s)) for s in r[0]] for r in rows], pa.list_(span)),
                pa.array([[dict(zip(("start", "end", "place"), c)) for c in r[1]] for r in rows], pa.list_(run)),
                pa.array([r[2] for r in rows], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "candidates", "plain"])

        return work

    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, base array<struct<start:int,kind:int,end:int>>, "
        "candidates array<struct<start:int,end:int,place:int>>, plain array<int>"
    )
    return map_batches(chosen, make, schema)


def accepted_places(found: DataFrame, rate: float = FALSE_DISCOVERIES) -> list[int]:
    """Places whose candidates are called secrets; at most one count per place reaches the driver."""
    marked = found.select(F.explode(F.col("candidates.place")).alias("place"), F.lit(True).alias("candidate")).unionByName(
        found.select(F.explode("plain").alias("place"), F.lit(False).alias("candidate"))
    )
    counts: dict[bool, dict[int, int]] = {True: defaultdict(int), False: defaultdict(int)}
    for row in marked.groupBy("place", "candidate").count().collect():
        counts[row["candidate"]][row["place"]] = row["count"]
    return sorted(discoveries(counts[True], counts[False], rate))


def discoveries(candidates: dict[int, int], plain: dict[int, int], rate: float) -> set[int]:
    """Benjamini-Hochberg over counted places; p-values mix the model's with the shares of counted words."""
    def share(p: int) -> float:
        size, level = divmod(p, BINS)
        own = {q: n for q, n in plain.items() if q // BINS == size}
        high = sum(n for q, n in own.items() if q % BINS >= level)
        return (high + MODEL_WEIGHT * 10 ** (-level / 2)) / (MODEL_WEIGHT + sum(own.values()))

    total, before, best = sum(candidates.values()), 0, -1.0
    ordered = sorted((share(p), p) for p in candidates)
    for i, (value, p) in enumerate(ordered):
        before += candidates[p]
        last = i + 1 == len(ordered) or ordered[i + 1][0] > value
        if last and value <= rate * before / total:
            best = value
    return {p for value, p in ordered if value <= best}


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def report(found: DataFrame, accepted: list[int]) -> DataFrame:
    """Counts of fixed kinds, digest of their spans, and all spans.

    Null and empty texts have no spans; rows that repeat an id are reported one by one.
    """
    chosen = F.array(*[F.lit(p) for p in accepted]).cast("array<int>")
    taken = F.filter("candidates", lambda c: F.array_contains(chosen, c["place"]))
    more = F.transform(taken, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.sort_array(F.concat("base", more))).alias("spans"),
        F.size(more).cast("long").alias("n_random"),
    )
