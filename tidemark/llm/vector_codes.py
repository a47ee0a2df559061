"""Vector codes: product codebooks, with the nearest entry found by slicing and intersecting bitmasks.

Components become whole numbers, vectors are cut into equal parts and every part gets the index of
its nearest codebook entry. For each dimension of a part the entries' coordinates are sorted, and
place ``i`` of the order holds a mask of the first ``i`` entries. A query first gets a radius: the
distance to the best of the entries next to it in one dimension. An entry at most as far away
differs by no more than the radius in every dimension, so per dimension two places in the order
and the difference of their masks give the entries of the slice, and the slices' masks ANDed give
the candidates, one uint64 per part. Distances decide among them; ties go to the lower index.

All sums are whole numbers, so the order in which tasks finish does not matter. A round moves one
row per part, entry and component from each task; only the merged codebooks, a size set by the
parameters, reach the driver.

Rules for odd rows: rows whose vector is null, empty, or holds null or non-finite components are
dropped, and so are vectors that have not the commonest length (the longer one on a tie). Lengths
that cannot be cut equally are filled up with zeros at the end. Whole components are held inside a
range in which no sum of squares overflows (for 64 components: floats up to 741,000). Seeds are the
kept rows with the smallest ids, null ids last, repeated ids by their vectors; every row is coded,
whether ids repeat or not. Fewer rows than entries give smaller codebooks, an empty table no rows.
Other columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import skew_join
from .common import map_batches, map_task, shared_table

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, place]`` for vectors of ``length`` components."""

    entries: np.ndarray
    length: int

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class Slices:
    """Sorted coordinates and prefix masks of one part's entries (at most 64)."""

    def __init__(self, entries: np.ndarray) -> None:
        if len(entries) > 64:
            raise ValueError("a mask holds at most 64 entries")
        self.entries = entries
        order = np.argsort(entries, axis=0, kind="stable")
        self.order = order
        self.sorted = np.take_along_axis(entries, order, axis=0)
        bits = np.left_shift(np.uint64(1), order.astype(np.uint64))
        none = np.zeros((1, entries.shape[1]), np.uint64)
        self.masks = np.concatenate([none, np.bitwise_or.accumulate(bits, axis=0)])

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Mask of the entries that lie within ``radius`` of each row of ``x`` in every dimension."""
        out = np.full(len(x), np.uint64(0xFFFFFFFFFFFFFFFF))
        for d in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, d], x[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], x[:, d] + radius, "right")
            out &= self.masks[high, d] ^ self.masks[low, d]
        return out

    def _apart(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        step = x - self.entries[entry]
        return (step * step).sum(axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row; the lowest index on ties."""
        best = np.zeros(len(x), np.int64)
        far = self._apart(x, best)
        for d in range(x.shape[1]):
            beside = self.order[np.minimum(np.searchsorted(self.sorted[:, d], x[:, d]), len(self.entries) - 1), d]
            apart = self._apart(x, beside)
            closer = (apart < far) | ((apart == far) & (beside < best))
            best, far = np.where(closer, beside, best), np.where(closer, apart, far)
        # One more than the rounded root, so that rounding never loses an entry.
        left = self.candidates(x, np.sqrt(far.astype(np.float64)).astype(np.int64) + 1)
        rows = np.arange(len(x))
        while len(rows):
            lowest = left & (~left + np.uint64(1))
            entry = np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
            apart = self._apart(x[rows], entry)
            closer = (apart < far[rows]) | ((apart == far[rows]) & (entry < best[rows]))
            best[rows[closer]], far[rows[closer]] = entry[closer], apart[closer]
            left ^= lowest
            rows, left = rows[left != 0], left[left != 0]
        return best, far


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """vec_id, label and v: the kept rows' components times ``scale``, rounded down; written once, read every round."""
    chosen = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    good = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))
    kept = chosen.where(F.col("x").isNotNull() & (F.size("x") > 0)).where(F.forall("x", good))
    most = kept.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    length = most[0] if most else 1
    limit = float(math.isqrt((2**63 - 1) // (4 * length)))
    held = lambda c: F.floor(F.greatest(F.least(c * F.lit(float(scale)), F.lit(limit)), F.lit(-limit))).cast("int")
    return shared_table(kept.where(F.size("x") == length).select("vec_id", "label", F.transform("x", held).alias("v")), "whole-vectors")


def _matrix(lists: pa.Array, parts: int) -> np.ndarray:
    """(rows, parts, places) of whole components, filled up with zeros so that parts are equal."""
    flat = np.asarray(lists.flatten(), np.int64).reshape(len(lists), -1)
    short = -flat.shape[1] % parts
    return np.pad(flat, ((0, 0), (0, short))).reshape(len(flat), parts, -1)


def _round(vectors: DataFrame, entries: np.ndarray) -> np.ndarray:
    """Entries after one round: the whole means of the parts nearest to each; unused ones stay."""
    parts, k, width = entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(e) for e in entries]
        count, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), parts)
            for p, part in enumerate(slices):
                best, _ = part.nearest(x[:, p])
                count[p] += np.bincount(best, minlength=k)
                np.add.at(total[p], best, x[:, p])
        p, e = np.nonzero(count)
        for place in range(width):
            columns = [p, e, np.full(len(p), place), count[p, e], total[p, e, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "place", "n", "total"])

    sums = map_task(vectors.select("v"), run, "part long, entry long, place long, n long, total long")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    out = entries.copy()
    for r in sums.groupBy("part", "entry", "place").agg(wide("n").alias("n"), wide("total").alias("total")).collect():
        out[r["part"], r["entry"], r["place"]] = int(r["total"]) // int(r["n"])
    return out


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks over all ``vectors``; None without any."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return None
    start = np.array([r["v"] for r in first], np.int64)
    books = np.ascontiguousarray(_matrix(pa.array(start.tolist(), pa.list_(pa.int64())), parts).transpose(1, 0, 2))
    for _ in range(rounds):
        books = _round(vectors, books)
    return Codebooks(books, start.shape[1])


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (squared distance, summed over the parts)."""
    entries = books.entries

    def make():
        slices = [Slices(e) for e in entries]

        def work(batch):
            x = _matrix(batch.column(2), len(slices))
            found = [part.nearest(x[:, p]) for p, part in enumerate(slices)]
            codes = np.stack([best for best, _ in found], axis=1).astype(np.uint8)
            error = sum(apart for _, apart in found)
            columns = [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes]), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

        return work

    kind = vectors.schema["label"].dataType.simpleString()
    return map_batches(vectors.select("vec_id", "label", "v"), make, f"vec_id bigint, label {kind}, code string, error bigint")


def decode(coded: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id and the whole components the code stands for."""
    entries, length = books.entries, books.length

    def make():
        def work(batch):
            codes = np.array([list(bytes.fromhex(c)) for c in batch.column(1).to_pylist()], np.int64).reshape(-1, len(entries))
            rows = np.concatenate([entries[p, codes[:, p]] for p in range(len(entries))], axis=1)[:, :length]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(rows), pa.list_(pa.int64()))], ["vec_id", "v"])

        return work

    return map_batches(coded.select("vec_id", "code"), make, "vec_id bigint, v array<bigint>")


def report(coded: DataFrame, books: Codebooks) -> DataFrame:
    """Coded rows with the error summed over equal labels (nulls together) and the codebooks' digest.

    Errors are summed per label inside each task first, and a label of very many rows is split in the join.
    """
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    joined = skew_join(coded, sums, ["label"], "left", null_safe=True)
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def compress(table: DataFrame, **names: str) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept row of ``table``."""
    vectors = whole_vectors(table, **names)
    books = fit(vectors)
    if books is None:
        empty = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
        return table.sparkSession.createDataFrame([], empty)
    return report(shared_table(encode(vectors, books), "vector-codes"), books)
