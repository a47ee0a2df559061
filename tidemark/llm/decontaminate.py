"""Benchmark decontamination as a prefix-filtered set join.

Items are cut into windows of 13 words (a shorter item is one window). A window is contained
in a document only if every shingle of three of its words is, so one shingle per window, its
rarest in the corpus, is prefix enough: containment asks for all tokens, and the prefix of a
set that must be contained whole has length one. Document shingles meet the index of these
prefixes; the shingle's place in the window gives the only place the window can start at
(positional bound), which must lie inside the document (length bound), and there the words
are compared one by one.

Benchmarks are a stated set: their windows are handed to the tasks in blocks of bounded size,
and documents pass through one step per block. Documents are never shuffled.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, shingle_hashes, text_bytes, word_ids

WINDOW = 13
SHINGLE = 3
#: Windows given to one step; a block of them takes about 100 MB in a task.
BLOCK_WINDOWS = 200_000
#: Bytes outside [0-9A-Za-z] and non-ASCII separate words; A-Z become lower case.
_FOLD = bytes(b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b >= 0x80 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))



def item_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class WindowIndex:
    """Distinct windows of a block of items, found by one shingle each."""

    def __init__(self, windows: list[tuple[bytes, ...]], owners: list[list[int]], counts: dict[int, int]):
        self.windows, self.owners = windows, owners
        places: dict[int, list[tuple[int, int]]] = {}
        for w, listed in enumerate(windows):
            shingles = shingle_hashes(word_ids(list(listed)), SHINGLE).tolist()
            place = min(range(len(shingles)), key=lambda p: (counts.get(shingles[p], 0), shingles[p]))
            # Short windows are shorter than a shingle: their key is the run of their own length.
            places.setdefault((shingles[place], min(len(listed), SHINGLE)), []).append((w, place))
        self.places = places
        self.sorted = {n: np.array(sorted(k for k, m in places if m == n), np.uint64) for n in range(1, SHINGLE + 1)}
        self.sorted = {n: keys for n, keys in self.sorted.items() if len(keys)}

    def occurrences(self, listed: list[bytes], ids: np.ndarray) -> list[tuple[int, int]]:
        """(first word, window) of every occurrence in a document."""
        found, n = [], len(listed)
        for size, keys in self.sorted.items():
            if n < size:
                continue
            at = shingle_hashes(ids, size)
            near = np.searchsorted(keys, at)
            near[near == len(keys)] = 0
            for p in np.flatnonzero(keys[near] == at).tolist():
                for w, place in self.places[(int(at[p]), size)]:
                    start, window = p - place, self.windows[w]
                    if start >= 0 and start + len(window) <= n and tuple(listed[start : start + len(window)]) == window:
                        found.append((start, w))
        return found


def _item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """item_id and words of each distinct window of an item."""

    def make():
        def work(batch):
            ids, listed = [], []
            for item, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                found = item_words(text)
                width = min(window, len(found))
                for cut in {tuple(found[i : i + width]) for i in range(len(found) - width + 1)} if found else ():
                    ids.append(item)
                    listed.append(b" ".join(cut).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(listed, pa.string())], ["item_id", "words"])

        return work

    chosen = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))
    return map_batches(chosen, make, "item_id string, words string")


def _shingle_counts(docs: DataFrame, wanted: np.ndarray, text_col: str) -> dict[int, int]:
    """How often each wanted shingle occurs in the corpus; at most as many rows as shingles wanted."""
    handed = docs.sparkSession.sparkContext.broadcast(wanted)

    def make():
        keys = handed.value

        def work(batch):
            total = np.zeros(len(keys), np.int64)
            for text in text_bytes(batch.column(0)):
                ids = word_ids(item_words(text))
                if len(ids) >= SHINGLE:
                    at = shingle_hashes(ids, SHINGLE)
                    near = np.searchsorted(keys, at)
                    near[near == len(keys)] = 0
                    np.add.at(total, near[keys[near] == at], 1)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(total[some])], ["shingle", "n"])

        return work

    counted = map_batches(docs.select(F.col(text_col).alias("text")), make, "shingle bigint, n bigint")
    rows = counted.groupBy("shingle").agg(F.sum("n").alias("n")).collect()
    return {int(np.int64(r["shingle"]).view(np.uint64)): r["n"] for r in rows}


def _blocks(items: DataFrame, id_col: str, text_col: str, window: int, block: int):
    """Blocks of (windows, item ids per window); one block is in memory at a time."""
    windows = _item_windows(items, id_col, text_col, window)
    grouped = windows.groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    ordered = grouped.orderBy("words")
    part = []
    for row in ordered.toLocalIterator():
        part.append((tuple(row["words"].encode("utf-8", "surrogatepass").split(b" ")), list(row["items"])))
        if len(part) == block:
            yield part
            part = []
    if part:
        yield part


def scan(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block: int = BLOCK_WINDOWS,
    carry_text: bool = True,
) -> DataFrame:
    """``docs`` with ``__n_words``, ``__spans`` (start, end in words) and ``__items`` (ids, sorted) added.

    Null texts have no words; items without words are never found. Words of an item without an id are
    hit like any others, only the list of ids leaves it out; an item that occurs in several rows counts
    once per id. Rows and columns of ``docs`` stay as they are.
    """
    context = docs.sparkSession.sparkContext
    found = [F.lit(0).cast("long").alias("__n_words"), F.array().cast("array<int>").alias("__spans"), F.array().cast("array<string>").alias("__items")]
    out, parts = docs.select("*", *found), _blocks(items, item_id, item_text, window, block)
    part = next(parts, [])
    while part is not None:
        after = next(parts, None)
        distinct = sorted({h for listed, _ in part if len(listed) >= SHINGLE for h in shingle_hashes(word_ids(list(listed)), SHINGLE).tolist()})
        counts = _shingle_counts(docs, np.array(distinct, np.uint64), text_col) if distinct else {}
        out = _step(out, context.broadcast((part, counts)), text_col, carry_text or after is not None)
        part = after
    return out


def _step(docs: DataFrame, handed, text_col: str, carry_text: bool) -> DataFrame:
    text_at = docs.columns.index(text_col)
    kept = [i for i, c in enumerate(docs.columns[:-3]) if carry_text or c != text_col]
    names = [docs.columns[i] for i in kept] + docs.columns[-3:]
    schema = docs.select(*[F.col(f"`{c}`") for c in names]).schema

    def make():
        part, counts = handed.value
        index = WindowIndex([listed for listed, _ in part], [ids for _, ids in part], counts)

        def work(batch):
            last = batch.num_columns
            sizes, spans, items = [], [], []
            before = zip(batch.column(last - 2).to_pylist(), batch.column(last - 1).to_pylist())
            for text, (old_spans, old_items) in zip(text_bytes(batch.column(text_at)), before):
                listed = item_words(text)
                sizes.append(len(listed))
                found = index.occurrences(listed, word_ids(listed)) if listed else []
                if not found:
                    spans.append(old_spans)
                    items.append(old_items)
                    continue
                pairs = [*zip(old_spans[::2], old_spans[1::2]), *((s, s + len(index.windows[w])) for s, w in found)]
                spans.append(_merge(pairs))
                items.append(sorted({*old_items, *(i for _, w in found for i in index.owners[w])}))
            columns = [*(batch.column(i) for i in kept), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names)

        return work

    return map_batches(docs, make, schema)


def _merge(pairs: list[tuple[int, int]]) -> list[int]:
    """Disjoint spans covering the given ones, as start, end, start, end, ..."""
    out: list[int] = []
    for start, end in sorted(pairs):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def judged(scanned: DataFrame) -> DataFrame:
    """Adds ``__n_hit`` and ``__contaminated`` (a twentieth of the words or more is hit)."""
    lengths = F.transform(F.col("__spans"), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    hit = F.aggregate(lengths, F.lit(0), lambda a, b: a + b).cast("long")
    with_hits = scanned.withColumn("__n_hit", hit)
    return with_hits.withColumn("__contaminated", (F.col("__n_hit") > 0) & (20 * F.col("__n_hit") >= F.col("__n_words")))


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, digest of the item ids, contaminated."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = judged(scan(chosen, items, carry_text=False, **options))
    return rows.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        F.col("__contaminated").alias("contaminated"),
        F.col("__spans").alias("hit_spans"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with their columns as they were."""
    rows = judged(scan(docs, items, text_col=text_col, **options))
    return rows.where(~F.col("__contaminated")).select(*[F.col(f"`{c}`") for c in docs.columns])
