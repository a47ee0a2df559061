"""Helpers the operators share: words, hashes, shared tables, record batches."""

from __future__ import annotations

import bisect
import hashlib
import itertools
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scale import materialise

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: White space of the word rule, as a Java character class and as SQL characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Entries a memo may hold before it starts anew; bounds the memory of a Python worker.
MEMO_LIMIT = 250_000


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and gives Spark the true size."""
    return materialise(df, name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def hash_sample(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` different rows, those with the lowest hashes; the same ones every time.

    Hashes are compared first and without the rows, so texts of the sample only are moved.
    """
    hashed = df.withColumn("__h", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    cut = hashed.select("__h").distinct().orderBy("__h").limit(n).agg(F.max("__h")).first()[0]
    few = hashed.where(F.col("__h") <= F.lit(cut)) if cut is not None else hashed.limit(0)
    return few.dropDuplicates(["__h"]).drop("__h")


def words(text: Column) -> Column:
    """Words of a text (runs without space, tab, line feed, vertical tab, form feed, return); null: none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+")
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


class WordHashes(dict):
    """64-bit ids of words (bytes), remembered up to a limit."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_LIMIT:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            self[word] = value
        return value


#: One memo per Python worker, whichever operators its tasks belong to.
_MEMO = WordHashes()


def word_ids(listed: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_MEMO.__getitem__, listed), np.uint64, len(listed))


def forget_words() -> None:
    """Free the memo of a worker whose next tasks do not hash words."""
    _MEMO.clear()


class Spans:
    """Tells whether a range meets any of some (start, kind, end) spans, however many there are."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        ordered = sorted(spans)
        self.starts = [s for s, _, _ in ordered]
        self.reach = list(itertools.accumulate((e for _, _, e in ordered), max))

    def meet(self, start: int, end: int) -> bool:
        before = bisect.bisect_left(self.starts, end)
        return before > 0 and self.reach[before - 1] > start


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole 64-bit number."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` ids; a shorter, not empty sequence is one run of its own length."""
    n = len(ids)
    if n == 0:
        return ids
    width = min(size, n)
    total = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        total += ids[j : n - width + 1 + j] * np.uint64((0x9E3779B97F4A7C15 * (2 * j + 3)) & 0xFFFFFFFFFFFFFFFF | 1)
    return mix64(total)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if t is None else t for t in column.cast(kind).to_pylist()]


def in_slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A record batch in pieces of few rows, so long texts never pile up as Python objects."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], schema: T.StructType | str
) -> DataFrame:
    """``mapInArrow`` over slices; ``make`` runs once per task and returns the function for a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in in_slices(batch):
                yield from work(piece)

    return map_task(df, run, schema)


def map_task(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` for functions over all batches of a task."""
    find_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def find_package(spark: SparkSession) -> None:
    """Python workers of a local session may start in another folder than the driver."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
