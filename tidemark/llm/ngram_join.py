"""N-gram Jaccard join with PartEnum signatures, and the groups its links form.

Two sets with similarity of at least 4/5 differ in at most a ninth of their summed sizes. Sizes
are cut into bands; in a band whose largest set has R elements the domain of shingles is cut
into ``2R/9 + 1`` partitions, so two similar sets agree in at least one partition and share
its signature. This is the enumeration with two partitions per first-level group, of which
subsets of one are kept: as many signatures as any choice of levels needs at least.

A set need not give all of its signatures. Order signatures by the number of elements they
cover, most first: two sets that agree in ``t`` of ``n`` partitions share one among the first
``n - t + 1`` of each. So a set keeps the ``k + 1`` signatures that cover most, ``k`` being the
largest difference to any partner of its own size range, and empty partitions, which everyone
shares, are the first to go.

Groups of copies never become all pairs. Of signatures with the same members one is enough. Sets
are compared inside a signature's group on parity sketches, which give a lower bound of the
difference and so lose nothing; their width follows the set's size, so that they still tell sets just
under the threshold apart. First the pairs of small groups, and in large ones each member and
its nearest neighbour, are checked on the texts; that joins families of near copies. Then only
pairs of large groups that could still connect two different families are checked. Exact copies
take part once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import skew_join
from .common import map_batches, map_task, mix64, shared_table, shingle_hashes, text_bytes, word_ids
from .components import components

WORDS = 5
#: Members of a signature's group that one comparison block holds.
BLOCK = 1024
#: Groups up to this size are compared whole in the first pass.
SMALL = 16
#: Bits of a sketch: at least four a shingle, a power of two between these.
LEAST_BITS, MOST_BITS = 512, 65536
#: Bytes of sketches compared at a time.
PIECE = 32 << 20

_U = np.uint64


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Distinct hashed shingles of a text, sorted."""
    return np.unique(shingle_hashes(word_ids(text.lower().split()), words))


def linked(a: int, b: int, both: int) -> bool:
    """Similarity of at least 4/5, in whole numbers."""
    return 100 * both >= 80 * (a + b - both) and both > 0


def band_start(size: int) -> tuple[int, int, int]:
    """Start of the band before, of the own band and of the next band of a set size."""
    before, start = 0, 1
    while True:
        after = max(start + 1, -(-start * 125 // 64))
        if size < after:
            return before, start, after
        before, start = start, after


def instances(size: int) -> list[tuple[int, int, int]]:
    """(band, partitions, signatures to keep) of a set; pairs meet in the smaller one's band."""
    before, start, after = band_start(size)
    top = 5 * (after - 1) // 4
    out = [(start, 2 * top // 9 + 1, (size + min(top, 5 * size // 4)) // 9 + 1)]
    reach = 5 * (start - 1) // 4
    if before and size <= reach:
        out.append((before, 2 * reach // 9 + 1, (size + start - 1) // 9 + 1))
    return out


def signatures(shingles: np.ndarray) -> np.ndarray:
    """Signatures of a set of shingles, as many as its bands ask for."""
    out = []
    for band, parts, keep in instances(len(shingles)):
        spread = mix64(shingles + _U(band * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        part = ((spread >> _U(32)) * _U(parts)) >> _U(32)
        order = np.argsort(part, kind="stable")
        count = np.bincount(part.astype(np.int64), minlength=parts)
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix64(spread)[order], dtype=_U)])
        ends = np.concatenate([[0], np.cumsum(count)])
        content = sums[ends[1:]] - sums[ends[:-1]]
        place = mix64(np.arange(parts, dtype=_U) + _U(band << 32))
        sign = mix64(content + place + count.astype(_U))
        out.append(sign[np.lexsort((sign, -count))[:keep]])
    return np.concatenate(out)


def sketch(shingles: np.ndarray) -> bytes:
    """For each of some cells whether an odd number of shingles falls into it."""
    cells = LEAST_BITS
    while cells < min(4 * len(shingles), MOST_BITS):
        cells *= 2
    odd = np.bincount((shingles >> _U(20)).astype(np.int64) & (cells - 1), minlength=cells)
    return np.packbits((odd & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches of ``width`` bytes each; of a wider one the parts that share a cell are joined."""
    out = np.empty((len(sketches), width // 8), _U)
    for row, one in zip(out, sketches):
        row[:] = np.bitwise_xor.reduce(np.frombuffer(one, _U).reshape(-1, width // 8), axis=0)
    return out


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, set size, 128-bit digest of the set, signatures and sketch of each row."""

    def make():
        def work(batch):
            sizes, digests, signs, sketches = [], [], [], []
            for text in text_bytes(batch.column(1)):
                found = shingle_set(text)
                sizes.append(len(found))
                digests.append((int(mix64(found).sum(dtype=_U)), int(mix64(found ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=_U))))
                signs.append(signatures(found).view(np.int64) if len(found) else np.zeros(0, np.int64))
                sketches.append(sketch(found))
            ends = np.cumsum([0, *map(len, signs)]).astype(np.int32)
            pairs = np.array(digests, _U).reshape(-1, 2).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *signs])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), lists, pa.array(sketches, pa.binary())],
                ["doc_id", "n_shingles", "d1", "d2", "signs", "sketch"],
            )

        return work

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(chosen, make, "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, signs array<bigint>, sketch binary")


def _pairs_of_blocks(rows: DataFrame, nearest: bool) -> DataFrame:
    """Pairs (x, y) inside the groups of ``rows`` whose sketches allow a link.

    ``rows``: key columns sign, lo, hi, then side (block of the member), doc_id, label,
    n_shingles, sketch; sorted by key within partitions. A group holds at most two blocks.
    With ``nearest`` larger groups give each member's nearest earlier member only.
    """
    from pyspark.sql import types as T

    names = ["sign", "lo", "hi", "side", "doc_id", "label", "n_shingles", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            cut = _last_group(table)
            rest = table.slice(cut)
            yield from _compare(table.slice(0, cut), nearest)
        if rest is not None:
            yield from _compare(rest, nearest)

    schema = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.LongType())])
    return map_task(rows.select(*names), run, schema)


def _last_group(table: pa.Table) -> int:
    """Row at which the last, perhaps unfinished, group begins."""
    keys = np.stack([np.asarray(table.column(i)) for i in range(3)])
    other = np.flatnonzero((keys[:, :-1] != keys[:, 1:]).any(axis=0))
    return int(other[-1]) + 1 if len(other) else 0


def _compare(table: pa.Table, nearest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of whole groups, a bounded number of sketches at a time."""
    if table.num_rows < 2:
        return
    keys = np.stack([np.asarray(table.column(i)) for i in range(3)])
    starts = np.concatenate([[0], np.flatnonzero((keys[:, :-1] != keys[:, 1:]).any(axis=0)) + 1, [table.num_rows]])
    sketches = table.column(7).to_pylist()
    widths = np.minimum.reduceat(np.array([len(x) for x in sketches]), starts[:-1])
    # Groups whose narrowest sketches are equally wide are compared together.
    for width in np.unique(widths).tolist():
        part, size = [], 0
        for g in np.flatnonzero(widths == width).tolist():
            part.append(g)
            size += int(starts[g + 1] - starts[g]) * width
            if size >= PIECE:
                yield from _compare_groups(table, keys, starts, part, sketches, width, nearest)
                part, size = [], 0
        if part:
            yield from _compare_groups(table, keys, starts, part, sketches, width, nearest)


def _compare_groups(table, keys, starts, part: list[int], sketches: list[bytes], width: int, nearest: bool) -> Iterator[pa.RecordBatch]:
    rows = np.concatenate([np.arange(starts[g], starts[g + 1]) for g in part])
    lengths = np.diff(starts)[part]
    side, docs, labels, sizes = (np.asarray(table.column(i))[rows] for i in range(3, 7))
    lo, hi = keys[1][rows], keys[2][rows]
    bits = folded([sketches[i] for i in rows.tolist()], width)
    first = np.concatenate([[0], np.cumsum(lengths)])
    group = np.repeat(np.arange(len(lengths)), lengths)
    small = lengths <= SMALL
    lows, highs = [], []

    def keep(i: np.ndarray, j: np.ndarray) -> None:
        crosses = (labels[i] != labels[j]) & ((lo[i] == hi[i]) | (side[i] != side[j]))
        i, j = i[crosses], j[crosses]
        most = (sizes[i] + sizes[j]) // 9
        near = np.abs(sizes[i] - sizes[j]) <= most
        near[near] = np.bitwise_count(bits[i[near]] ^ bits[j[near]]).sum(axis=1) <= most[near]
        near |= (sizes[i] < 0) | (sizes[j] < 0)
        lows.append(np.minimum(docs[i], docs[j])[near])
        highs.append(np.maximum(docs[i], docs[j])[near])

    for step in range(1, SMALL):
        i = np.flatnonzero((group[step:] == group[:-step]) & small[group[step:]]) if len(docs) > step else np.zeros(0, int)
        if len(i):
            keep(i, i + step)
    for g in np.flatnonzero(~small):
        at = np.arange(first[g], first[g + 1])
        for k in range(1, len(at)):
            if nearest:
                apart = np.bitwise_count(bits[at[:k]] ^ bits[at[k]]).sum(axis=1)
                i = at[[int(apart.argmin())]]
            else:
                i = at[:k]
            keep(i, np.full(len(i), at[k]))
    pairs = np.unique(np.stack([np.concatenate(lows), np.concatenate(highs)]), axis=1) if lows else np.zeros((2, 0), np.int64)
    if pairs.shape[1]:
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["x", "y"])


def verify(pairs: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs (x, y) whose shingle sets are similar enough, compared element by element."""

    def make():
        last: dict[str, object] = {"text": None, "set": None}

        def work(batch):
            xs, ys, found = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for a, b in zip(text_bytes(batch.column(2)), text_bytes(batch.column(3))):
                if last["text"] != b:
                    last["text"], last["set"] = b, shingle_set(b)
                one, other = shingle_set(a), last["set"]
                found.append(linked(len(one), len(other), len(np.intersect1d(one, other, assume_unique=True))))
            kept = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([xs[i] for i in kept], pa.int64()), pa.array([ys[i] for i in kept], pa.int64())], ["x", "y"])

        return work

    needed = pairs.select(F.col("x").alias("id")).unionByName(pairs.select(F.col("y").alias("id"))).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(needed, "id", "left_semi")
    texts = shared_table(texts, "join-texts")
    one = texts.select(F.col("id").alias("x"), F.col("text").alias("tx"))
    other = texts.select(F.col("id").alias("y"), F.col("text").alias("ty"))
    joined = pairs.join(other, "y").join(one, "x").select("x", "y", "tx", "ty")
    return map_batches(joined, make, "x bigint, y bigint").distinct()


def _blocked(members: DataFrame, pairwise: bool) -> DataFrame:
    """Members of signature groups of ``n`` dealt to comparison blocks, at most two blocks per group key."""
    blocks = members.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    side = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    sided = blocks.withColumn("side", side)
    if pairwise:
        sided = sided.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    else:
        sided = sided.withColumn("other", F.col("side"))
    keyed = sided.withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other"))
    return keyed.repartition("sign", "lo", "hi").sortWithinPartitions("sign", "lo", "hi", "doc_id")


def candidates(described: DataFrame) -> DataFrame:
    """(sign, doc_id, n) of every signature that two sets or more share, n telling how many.

    Signatures with the same members, told by their number and hashes, would only repeat pairs: the lowest one stays.
    """
    from pyspark.sql import Window

    signs = described.select("doc_id", F.explode("signs").alias("sign"))
    counted = signs.withColumn("n", F.count("*").over(Window.partitionBy("sign")))
    shared = shared_table(counted.where("n > 1").select("sign", "doc_id", "n"), "join-shared")
    hashed = F.xxhash64("doc_id")
    lanes = [F.bit_xor(hashed), F.sum(hashed.bitwiseAND(F.lit(0x7FFFFFFF))), F.sum(F.shiftrightunsigned(hashed, 33))]
    members = shared.groupBy("sign", "n").agg(*(lane.alias(f"h{i}") for i, lane in enumerate(lanes)))
    one = members.groupBy("n", "h0", "h1", "h2").agg(F.min("sign").alias("sign")).select("sign")
    return skew_join(shared, one, ["sign"], "left_semi")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) of every row.

    Null and empty texts have no shingles and no links. Rows that share an id are one document,
    linked wherever one of them is. Rows without an id are counted and belong to no component.
    An empty table gives no rows. Other columns are left out, whatever their names.
    """
    everything = shared_table(describe(docs, id_col, text_col), "join-sets")
    rows = everything.where("doc_id is not null")
    light = rows.select("doc_id", "d1", "d2", "n_shingles")
    filled = light.where("n_shingles > 0")
    copies = shared_table(filled.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "join-copies")
    reps = copies.select(F.col("rep").alias("doc_id"), "d1", "d2")
    # An id with several texts stands for the classes of all of them.
    several = filled.groupBy("doc_id").agg((F.min(F.struct("d1", "d2")) != F.max(F.struct("d1", "d2"))).alias("s")).where("s").select("doc_id")
    same = filled.join(several, "doc_id").join(copies, ["d1", "d2"]).select(F.col("doc_id").alias("x"), F.col("rep").alias("y")).where("x <> y")
    sets = rows.where("n_shingles > 0").join(reps, ["doc_id", "d1", "d2"], "left_semi")
    grouped = shared_table(candidates(sets), "join-groups")
    # An id with several texts has no one sketch: size -1 lets its pairs through to the exact check.
    one_text = F.min(F.struct("d1", "d2")) == F.max(F.struct("d1", "d2"))
    traits = rows.where("n_shingles > 0").groupBy("doc_id").agg(
        F.when(one_text, F.max("n_shingles")).otherwise(-1).alias("n_shingles"), F.max("sketch").alias("sketch")
    )

    chosen = grouped.join(traits, "doc_id").withColumn("label", F.col("doc_id"))
    near = shared_table(_pairs_of_blocks(_blocked(chosen, False), True).distinct(), "join-near")
    links = shared_table(verify(near, docs, id_col, text_col).unionByName(same), "join-links")
    found = components(links)

    # Small groups are done; of the others, those whose members do not all belong together yet.
    labelled = grouped.where(f"n > {SMALL}").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    labelled = labelled.select("sign", "doc_id", "n", F.coalesce("component", "doc_id").alias("label"))
    open_signs = labelled.groupBy("sign").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b").select("sign")
    left = skew_join(labelled, open_signs, ["sign"], "left_semi").join(traits, "doc_id")
    crossing = _pairs_of_blocks(_blocked(left, True), False).distinct()
    crossing = shared_table(crossing.join(near, ["x", "y"], "left_anti"), "join-crossing")
    more = verify(crossing, docs, id_col, text_col)
    joined = shared_table(links.unionByName(more), "join-all-links")
    final = components(joined)

    of_class = light.join(copies, ["d1", "d2"], "left").join(final.withColumnRenamed("node", "rep"), "rep", "left")
    placed = of_class.select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
    nameless = everything.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return placed.unionByName(nameless)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id; columns stay as they are.

    Rows without an id are kept. Of rows that repeat an id one is kept.
    """
    groups = near_duplicates(docs, id_col, text_col)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    named = docs.where(F.col(id_col).isNotNull()).join(kept, F.col(id_col) == F.col("__kept"), "left_semi")
    return named.dropDuplicates([id_col]).unionByName(docs.where(F.col(id_col).isNull()))
