"""Prefix trie of conversations by Van Emde Boas recursion: cut at half depth, name, build, graft.

A node is a distinct sequence of first turns. Its name is the exclusive-or of 128 hashed bits per
turn and place, so the name of a prefix is the name of any cut prefix joined with the name of what follows
the cut, and the parent's name is known too. Sequences lie in pieces of bounded length. A piece is
cut at half its depth and both halves again, all cuts of one size in one step; the lower half takes
the name of the cut prefix above it. The cuts between pieces of one long conversation are named
in the same way from the pieces' own names.

Equal names are one node, counted by one aggregate over all levels at once. A node belongs to its
member with the smallest id, so what belongs to one piece is one path downwards: a forest of paths, each
hanging from the node above its first one. Inside a path, totals are sums from below. Between
paths they are grafted upwards in rounds: in each, a path hands its total to the path 1, 2, 4, ...
steps above, so the number of rounds grows with the logarithm of the nesting.

No conversation, node or hash is collected whole. Turns are numbered by a range partitioning with
offsets per piece, also inside one conversation of a third of all rows. Members that end at one
node are written as strings by many tasks; only the digest, which is a sequence by definition, reads these
strings one after the other, holding one record batch.

Rules for odd rows: a null role or text is empty; turns are ordered by turn, null first, and on ties by
hashes of role and text, so reruns agree and repeated rows are repeated turns. Rows without a
conversation id belong to none and are left out. An empty table has no trie and gives no rows,
not even a root. Other columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scale import skew_join
from .common import map_batches, map_task, mix64, shared_table

#: Turns of one conversation that one row holds at most.
PIECE = 4096
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
NO_ENDS = hashlib.sha256(b"").hexdigest()

_U = np.uint64


def turns(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, two hashes of role and text, and the number of words of the text."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    both = F.concat(F.length(by).cast("string"), F.lit(":"), by, said)
    return table.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.xxhash64(F.lit(1), both).alias("t1"),
        F.xxhash64(F.lit(2), both).alias("t2"),
        F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
    )


def _starts(*keys: np.ndarray) -> np.ndarray:
    """First row of each run of equal keys."""
    other = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.concatenate([np.zeros(min(1, len(keys[0])), np.int64), np.flatnonzero(other) + 1])


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), pa.array(values))


def in_pieces(ordered: DataFrame, piece: int = PIECE) -> DataFrame:
    """Sorted turns as rows of up to ``piece`` turns: conv_id, shard, no (both in order), t1, t2 and words as lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, rest = TaskContext.get().partitionId(), 0, [np.zeros(0, np.int64)] * 4

        def out(conv, t1, t2, words):
            nonlocal number
            runs = _starts(conv)
            place = np.arange(len(conv)) - np.repeat(runs, np.diff(np.append(runs, len(conv))))
            starts = np.flatnonzero(place % piece == 0)
            numbers = np.arange(number, number + len(starts))
            number += len(starts)
            columns = [pa.array(conv[starts]), pa.array(np.full(len(starts), shard, np.int32)), pa.array(numbers), *(_lists(c, starts) for c in (t1, t2, words))]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "shard", "no", "t1", "t2", "words"])

        for batch in batches:
            columns = [np.concatenate([r, np.asarray(c, np.int64)]) for r, c in zip(rest, batch.columns)]
            conv = columns[0]
            # The last conversation may go on in the next batch; its full pieces need not wait.
            last = _starts(conv)[-1] if len(conv) else 0
            done = last + (len(conv) - last) // piece * piece
            if done:
                yield out(*(c[:done] for c in columns))
            rest = [c[done:] for c in columns]
        if len(rest[0]):
            yield out(*rest)

    schema = "conv_id bigint, shard int, no bigint, t1 array<bigint>, t2 array<bigint>, words array<bigint>"
    return map_task(ordered.select("conv_id", "t1", "t2", "words"), run, schema)


def arrange(pieces: DataFrame, family: int | None = None) -> DataFrame:
    """Pieces of the rebuilt conversations: conv_id, start, n (turns of the conversation), t1, t2, words.

    With a ``family`` of f, conversation c starts with the first h turns of conversation
    c - c % f (all if it has fewer, none if there is none; the remainder is never negative) in
    place of its own first h, h being the CRC-32 of the decimal id modulo 4. Without, it stays as it is. A
    conversation left without turns is one empty piece.
    """
    conv = F.col("conv_id")
    head = F.arrays_zip(*(F.slice(c, 1, 3).alias(c) for c in ("t1", "t2", "words")))
    base = F.try_subtract(conv, F.pmod(conv, F.lit(family))) if family else conv
    skip = (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int") if family else F.lit(0)
    meta = pieces.select("conv_id", "shard", "no", F.size("t1").alias("n"), base.alias("base"), skip.alias("h"), F.when(conv == base, head).alias("head"))
    # Only the pieces' sizes and three turns move here; a family has few conversations.
    order = Window.partitionBy("base", "conv_id").orderBy("shard", "no")
    meta = meta.repartition("base").withColumn("at", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    meta = meta.withColumn("own", F.sum("n").over(Window.partitionBy("base", "conv_id")))
    first = F.when(F.col("head").isNotNull() & (F.col("at") < 3), F.struct("at", "head"))
    meta = meta.withColumn("heads", F.collect_list(first).over(Window.partitionBy("base")))
    meta = meta.withColumn("lead", F.slice(F.flatten(F.transform(F.sort_array("heads"), lambda x: x["head"])), F.lit(1), F.col("h")))
    taken = F.size("lead")
    places = meta.select(
        "conv_id",
        "shard",
        "no",
        "lead",
        "at",
        F.greatest(F.lit(0), F.least(F.col("n"), F.col("h") - F.col("at"))).cast("int").alias("drop"),
        F.when(F.col("at") == 0, F.lit(0)).otherwise(taken + F.greatest(F.col("at") - F.col("h"), F.lit(0))).cast("long").alias("start"),
        (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("n"),
    )
    joined = pieces.join(places, ["conv_id", "shard", "no"])

    def rebuilt(name: str) -> Column:
        kept = F.slice(name, F.col("drop") + 1, F.greatest(F.size(name) - F.col("drop"), F.lit(0)))
        return F.when(F.col("at") == 0, F.concat(F.transform("lead", lambda x: x[name]), kept)).otherwise(kept).alias(name)

    rows = joined.select("conv_id", "start", "n", "at", *(rebuilt(c) for c in ("t1", "t2", "words")))
    return rows.where((F.size("t1") > 0) | ((F.col("n") == 0) & (F.col("at") == 0))).drop("at")


def name_prefixes(own: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Names of all prefixes of sequences laid end to end, from hashes of single turns and their places.

    Cut in halves of 1, 2, 4, ... turns: each time the lower halves take on the name of the prefix cut off above.
    """
    names, half = own.copy(), 1
    longest = int(place.max()) + 1 if len(place) else 0
    while half < longest:
        lower = np.flatnonzero(place & half)
        above = lower - (place[lower] & (2 * half - 1)) + half - 1
        names[lower] ^= names[above]
        half *= 2
    return names


def name_pieces(arranged: DataFrame) -> DataFrame:
    """conv_id, start, n, words and the names (a, b) of the piece's own prefixes."""

    def make():
        def work(batch):
            sizes = np.asarray(batch.column(3).value_lengths(), np.int64)
            starts = np.cumsum(sizes) - sizes
            inside = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
            place = inside.astype(_U) + np.repeat(np.asarray(batch.column(1)), sizes).astype(_U)
            names = []
            for column, odd in ((3, 0x9E3779B97F4A7C15), (4, 0xD6E8FEB86659FD93)):
                own = mix64(np.asarray(batch.column(column).flatten()).astype(np.int64).view(_U) + mix64(place * _U(odd) + _U(1)))
                names.append(_lists(name_prefixes(own, inside).view(np.int64), starts))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1, 2)), *names, batch.column(5)], ["conv_id", "start", "n", "a", "b", "words"])

        return work

    return map_batches(arranged, make, "conv_id bigint, start bigint, n bigint, a array<bigint>, b array<bigint>, words array<bigint>")


def _with_cuts(pieces: DataFrame) -> DataFrame:
    """Pieces with the name (ca, cb) of the prefix before them; only conversations of several pieces are looked at."""
    nothing = F.lit(0).cast("long")
    alone = pieces.where(F.col("n") == F.size("a")).withColumns({"ca": nothing, "cb": nothing})
    several = pieces.where(F.col("n") > F.size("a"))
    before = Window.partitionBy("conv_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    own = several.select("conv_id", "start", F.element_at("a", -1).alias("x"), F.element_at("b", -1).alias("y"))
    cuts = own.select("conv_id", "start", *(F.coalesce(F.expr(f"bit_xor({c})").over(before), nothing).alias(n) for c, n in (("x", "ca"), ("y", "cb"))))
    return alone.unionByName(several.join(cuts, ["conv_id", "start"]))


def _digests(ends: DataFrame) -> DataFrame:
    """a, b and the digest of the ascending, comma-joined ids that end at each name; ``ends``: a, b, conv_id."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, conv = (np.asarray(batch.column(i)) for i in range(3))
            starts = _starts(a, b)
            joined = [",".join(map(str, part.tolist())) for part in np.split(conv, starts[1:])] if len(conv) else []
            yield pa.RecordBatch.from_arrays([pa.array(a[starts]), pa.array(b[starts]), pa.array(conv[starts]), pa.array(joined, pa.string())], ["a", "b", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if key == (a, b):
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (a, b), hashlib.sha256(ids.encode())
            yield _rows(out)
            out = []
        if key is not None:
            yield _rows([(*key, state.hexdigest())])

    def _rows(rows):
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "sha"])

    keys = ["a", "b", "conv_id"]
    sorted_ends = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    text = map_task(sorted_ends, strings, "a bigint, b bigint, first bigint, ids string")
    by_name = text.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return map_task(by_name, digest, "a bigint, b bigint, sha string")


def _graft(paths: DataFrame) -> DataFrame:
    """Totals of paths with all that hangs below: conv_id, start, leaves, saved.

    ``paths`` adds (uc, us), the path above, null at the top. Each round hands totals to the path
    a power of two above and doubles the step.
    """
    state = shared_table(paths.select("conv_id", "start", "leaves", "saved", "uc", "us"), "trie-paths")
    while not state.where("uc is not null").isEmpty():
        hanging = state.where("uc is not null")
        handed = hanging.groupBy("uc", "us").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        handed = handed.select(F.col("uc").alias("conv_id"), F.col("us").alias("start"), "l", "s")
        above = hanging.select(F.col("conv_id").alias("uc"), F.col("start").alias("us"), F.col("uc").alias("nc"), F.col("us").alias("ns"))
        summed = state.join(handed, ["conv_id", "start"], "left")
        summed = summed.withColumns({"leaves": F.col("leaves") + F.coalesce("l", F.lit(0)), "saved": F.col("saved") + F.coalesce("s", F.lit(0))})
        jumped = skew_join(summed, above, ["uc", "us"], "left")
        state = shared_table(jumped.select("conv_id", "start", "leaves", "saved", F.col("nc").alias("uc"), F.col("ns").alias("us")), "trie-paths")
    return state.drop("uc", "us")


def _describe(paths: DataFrame, top: int) -> DataFrame:
    """One row per node of each path; ``top`` is the root's id."""

    def make():
        def work(batch):
            conv, q0, parent = (np.asarray(batch.column(i)) for i in range(3))
            sizes = np.asarray(batch.column(3).value_lengths(), np.int64)
            ends = np.cumsum(sizes)
            starts = ends - sizes
            total = int(sizes.sum())
            place = np.arange(total) - np.repeat(starts, sizes) + np.repeat(q0, sizes)
            counts, words = (np.asarray(batch.column(i).flatten(), np.int64) for i in (3, 4))
            children = np.ones(total, np.int64)
            children[ends - 1] = 0
            leaves, saved, digests = np.zeros(total, np.int64), (counts - 1) * words, np.full(total, NO_ENDS, object)
            for i, hung in enumerate(batch.column(5).to_pylist()):
                for x in hung or ():
                    at = int(starts[i] + x["pos"] - q0[i])
                    children[at] += x["n"]
                    leaves[at] += x["leaves"]
                    saved[at] += x["saved"]
                    digests[at] = x["sha"] or NO_ENDS
            leaves += children == 0
            below = []
            for values in (leaves, saved):
                upto = np.cumsum(values)
                below.append(np.repeat(upto[ends - 1], sizes) - upto + values)
            own = np.repeat(conv, sizes)
            above = own.copy()
            above[starts] = parent
            columns = [own, place + 1, above, counts, children, *below]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(digests.tolist(), pa.string())], COLUMNS)

        return work

    chosen = paths.select("conv_id", "q0", F.coalesce("parent", F.lit(top)).alias("parent"), "counts", "words", "hung")
    return map_batches(chosen, make, SCHEMA)


def trie(table: DataFrame, family: int | None = None, piece: int = PIECE, **names: str) -> DataFrame:
    """One row per node: the columns of ``COLUMNS``. ``family``: see ``arrange``; ``names``: see ``turns``."""
    spark = table.sparkSession
    light = shared_table(turns(table, **names), "trie-turns")
    order = ["conv_id", "turn", "t1", "t2"]
    pieces = shared_table(in_pieces(light.repartitionByRange(*order).sortWithinPartitions(*order), piece), "trie-pieces")
    named = shared_table(name_pieces(arrange(pieces, family)), "trie-names")
    convs = named.where("start = 0").agg(F.count("*"), F.min("conv_id")).first()
    if not convs[0]:
        return spark.createDataFrame([], SCHEMA)
    cut = _with_cuts(named.where(F.size("a") > 0))

    # Nodes: equal names, whatever their depth, in one aggregate that merges inside tasks first.
    each = cut.select("conv_id", "start", "ca", "cb", F.posexplode(F.arrays_zip("a", "b")).alias("i", "x"))
    each = each.select("conv_id", "start", (F.col("start") + F.col("i")).alias("pos"), *(F.col(f"x.{n}").bitwiseXOR(F.col(f"c{n}")).alias(n) for n in "ab"))
    nodes = each.groupBy("a", "b", "pos").agg(F.count("*").alias("k"), F.min("conv_id").alias("conv_id"), F.min_by("start", "conv_id").alias("start"))
    nodes = shared_table(nodes, "trie-nodes")

    # Paths: what belongs to one piece, from its first own node to its end.
    owned = nodes.groupBy("conv_id", "start").agg(F.min("pos").alias("q0"), F.sort_array(F.collect_list(F.struct("pos", "k"))).alias("own"))
    skip = (F.col("q0") - F.col("start")).cast("int")
    above = {f"p{n}": F.when(skip == 0, F.col(f"c{n}")).otherwise(F.try_element_at(n, F.greatest(skip, F.lit(1))).bitwiseXOR(F.col(f"c{n}"))) for n in "ab"}
    paths = cut.join(owned, ["conv_id", "start"]).withColumns(above)
    paths = paths.select(
        "conv_id", "start", "q0", "pa", "pb", F.transform("own", lambda x: x["k"]).alias("counts"), F.slice("words", skip + 1, F.size("words") - skip).alias("words")
    )
    paths = shared_table(paths, "trie-owned")

    # Where paths hang and where conversations end, found by name.
    tail = F.col("start") + F.size("a") == F.col("n")
    ends = cut.where(tail).select(*(F.element_at(n, -1).bitwiseXOR(F.col(f"c{n}")).alias(n) for n in "ab"), "conv_id")
    turnless = named.where("n = 0").select(*(F.lit(0).cast("long").alias(n) for n in "ab"), "conv_id")
    digests = shared_table(_digests(ends.unionByName(turnless)), "trie-ends")
    wanted = paths.where("q0 > 0").select(F.col("pa").alias("a"), F.col("pb").alias("b"), "conv_id", "start", F.lit(None).cast("string").alias("sha"))
    wanted = wanted.unionByName(digests, allowMissingColumns=True)
    places = nodes.select("a", "b", F.col("conv_id").alias("uc"), F.col("start").alias("us"), F.col("pos").alias("up"))
    hung = shared_table(skew_join(wanted, places, ["a", "b"]).drop("a", "b"), "trie-hung")
    edges = hung.where("conv_id is not null").drop("sha")

    lowest = edges.groupBy("uc", "us").agg(F.max("up").alias("low")).select(F.col("uc").alias("conv_id"), F.col("us").alias("start"), "low")
    own_saved = F.aggregate(F.zip_with("counts", "words", lambda k, w: (k - 1) * w), F.lit(0).cast("long"), lambda s, x: s + x)
    light_paths = paths.select("conv_id", "start", (F.col("q0") + F.size("counts") - 1).alias("last"), own_saved.alias("saved"))
    light_paths = light_paths.join(edges.drop("up"), ["conv_id", "start"], "left").join(lowest, ["conv_id", "start"], "left")
    ending = F.when(F.col("low") == F.col("last"), 0).otherwise(1).cast("long")
    totals = _graft(light_paths.withColumn("leaves", ending))

    none = {n: F.lit(0).cast("long") for n in ("n", "leaves", "saved")}
    grafts = edges.join(totals, ["conv_id", "start"]).select(
        F.col("uc").alias("conv_id"), F.col("us").alias("start"), F.col("up").alias("pos"), F.lit(1).cast("long").alias("n"), "leaves", "saved"
    )
    finals = hung.where("sha is not null").select(F.col("uc").alias("conv_id"), F.col("us").alias("start"), F.col("up").alias("pos"), "sha").withColumns(none)
    uppers = edges.select("conv_id", "start", F.lit(-1).cast("long").alias("pos"), F.col("uc").alias("parent")).withColumns(none)
    all_hung = grafts.unionByName(finals, allowMissingColumns=True).unionByName(uppers, allowMissingColumns=True)
    per_place = all_hung.groupBy("conv_id", "start", "pos").agg(*(F.sum(n).alias(n) for n in none), F.max("sha").alias("sha"), F.max("parent").alias("parent"))
    listed = F.collect_list(F.when(F.col("pos") >= 0, F.struct("pos", *none, "sha"))).alias("hung")
    per_path = per_place.groupBy("conv_id", "start").agg(listed, F.max("parent").alias("parent"))
    rows = _describe(paths.join(per_path, ["conv_id", "start"], "left"), convs[1])

    top = paths.where("q0 = 0").select("conv_id", "start").join(totals, ["conv_id", "start"]).agg(F.count("*"), F.sum("leaves"), F.sum("saved")).first()
    at_root = digests.where("a = 0 and b = 0").first()
    root = (convs[1], 0, None, convs[0], top[0], top[1] or 1, top[2] or 0, at_root["sha"] if at_root else NO_ENDS)
    return rows.unionByName(spark.createDataFrame([root], SCHEMA))
