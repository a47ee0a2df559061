"""Context-tree weighting over bytes, and an add-half word model beside it.

Each byte is eight binary decisions, each in the context of up to DEPTH bytes before it (zero
bytes before the text). Every node of the tree, a context of that many bytes or fewer and the
bits seen of the current byte, has a Krichevsky-Trofimov estimate from its counts, and its weighted
probability is half the estimate and half the product of its children's. What the model says of
a byte mixes the estimates of all depths by these weights.

Neither the counts of contexts with their byte (grams) nor word counts have a bound, and they never
leave the executors. Documents are dealt to batches of bounded size; each batch states its distinct
words and grams, which meet their corpus counts in one shuffle each. Grams are dealt by the
last three bytes of their contexts, so a task holds whole subtrees below depth two and forms their
weights; what these sum to per context of two bytes, at most 2^24 numbers, goes to the driver,
which adds the two top levels. What the model says of each gram a batch needs comes back to its documents
with the word counts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_task, mix64, shared_table, text_bytes

#: Bytes of text per batch.
BATCH_BYTES = 16 << 20
#: The end of a document, as the hash of a word.
END = np.uint64(0x5851F42D4C957F2D)
#: Bytes of text whose words are hashed together, and what a word's hash is made of.
WORD_BYTES = 1 << 18
_DRAWN = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_BETWEEN = re.compile(rb"[\x20\x09-\x0D]")
#: Words of a batch a task gathers before it states the distinct ones.
BATCH_WORDS = 4_000_000
#: Grams of a batch a task gathers before it states the distinct ones.
BATCH_GRAMS = 4_000_000
#: Contexts whose counts are worked on at once.
SLICE = 4096
#: Bytes of context; a gram of six and a flag fit in 64 bits.
DEPTH = 5
_SMALL = 1 << 12


def held_out(doc_id: Column) -> Column:
    """Documents kept from training; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 1


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word: sums of drawn numbers per byte times powers of its place, A-Z in lower case."""
    text = np.frombuffer(data.lower(), np.uint8)
    inside = np.concatenate([[False], ~_SPACE[text], [False]])
    starts, ends = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    sizes = ends - starts
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    at = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(at, sizes)
    powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(sizes.max()) - 1, _BASE)]), dtype=np.uint64)
    drawn = _DRAWN[text[inside[1:-1]]] * powers[place]
    return mix64(np.add.reduceat(drawn, at) + sizes.astype(np.uint64) * _BASE), starts


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces that end between words."""
    at = 0
    while at < len(text):
        cut = _BETWEEN.search(text, at + WORD_BYTES)
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def _with_ends(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text followed by its end, and the length of each."""
    hashes, sizes, group, held = [], [], [], 0

    def together() -> None:
        found, starts = _hash_words(b"\n".join(group))
        bounds = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in group]))
        n = np.diff(np.concatenate([[0], bounds])) + 1
        out, word = np.full(int(n.sum()), END), np.ones(int(n.sum()), bool)
        word[np.cumsum(n) - 1] = False
        out[word] = found
        hashes.append(out)
        sizes.append(n)

    for text in texts:
        if group and held + len(text) > WORD_BYTES:
            together()
            group, held = [], 0
        if len(text) > WORD_BYTES:
            parts = [_hash_words(p)[0] for p in _pieces(text)]
            hashes += [*parts, np.array([END])]
            sizes.append(np.array([sum(map(len, parts)) + 1]))
        else:
            group.append(text)
            held += len(text)
    if group:
        together()
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *hashes]).view(np.int64), np.concatenate([np.zeros(0, np.int64), *sizes])


def _grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Context and byte of every byte as one number, and where each text begins."""
    if not texts:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    gap = b"\0" * depth
    joined = np.frombuffer(gap + gap.join(t.lower() for t in texts) + gap, np.uint8)
    gram = np.zeros(len(joined) - depth, np.int64)
    for i in range(depth + 1):
        gram = (gram << 8) | joined[i : len(joined) - depth + i]
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + depth)])[:-1]
    own = np.ones(len(gram), bool)
    for i in range(depth):
        own[starts + lengths + i] = False
    return gram[own], np.concatenate([[0], np.cumsum(lengths)])


def _batched(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, held_out and batch; the number of batches follows the size of the texts."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-total // BATCH_BYTES))
    batch = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(batches)).cast("int")
    return chosen.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"), batch.alias("batch"))


class _Pile:
    """Distinct grams of a batch, each doubled and one more in training texts, with their counts."""

    def __init__(self):
        self.raw, self.keys, self.counts = [], np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, grams: np.ndarray, train: bool) -> None:
        self.raw.append((grams << 1) | int(train))
        if sum(map(len, self.raw)) > BATCH_GRAMS // 8:
            self.merge()

    def merge(self) -> None:
        if self.raw:
            keys, counts = np.unique(np.concatenate(self.raw), return_counts=True)
            self.raw = []
            both = np.concatenate([self.keys, keys])
            order = np.argsort(both, kind="stable")
            both, n = both[order], np.concatenate([self.counts, counts])[order]
            first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
            self.keys, self.counts = both[first], np.add.reduceat(n, first) if len(first) else n

    def state(self, batch: int) -> Iterator[pa.RecordBatch]:
        self.merge()
        if len(self.keys):
            gram = self.keys >> 1
            first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
            yield _rows(True, batch, gram[first], np.add.reduceat(np.where(self.keys & 1, self.counts, 0), first))
        self.__init__()


def _rows(gram: bool, batch: int, word: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [np.full(len(word), gram), np.full(len(word), batch, np.int32), word, n.astype(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "batch", "word", "n"])


def _statements(batched: DataFrame, depth: int) -> DataFrame:
    """Rows (gram, batch, word, n): a batch's distinct words and grams with their training counts."""

    def run(batches):
        words, piles = {}, {}
        for record in batches:
            for at in range(0, record.num_rows, 512):
                piece = record.slice(at, 512)
                texts, train = text_bytes(piece.column(1)), ~np.asarray(piece.column(2).to_numpy(zero_copy_only=False), bool)
                hashes, sizes = _with_ends(texts)
                batch = np.asarray(piece.column(3))
                counted = np.repeat(train, sizes)
                of = np.repeat(batch, sizes)
                for b in np.unique(batch):
                    here = of == b
                    words.setdefault(int(b), []).append((hashes[here], counted[here]))
                    pile = piles.setdefault(int(b), _Pile())
                    for kind in (False, True):
                        pile.add(_grams([t for t, i, yes in zip(texts, batch, train) if i == b and yes == kind], depth)[0], kind)
                    if len(pile.keys) > BATCH_GRAMS:
                        yield from pile.state(int(b))
                for b, parts in words.items():
                    if sum(len(p[0]) for p in parts) > BATCH_WORDS:
                        yield _words(b, parts)
                        words[b] = []
        for b in list(piles):
            yield from piles.pop(b).state(b)
            if words[b]:
                yield _words(b, words.pop(b))
        _free()

    dealt = batched.repartition("batch").select("doc_id", "text", "held_out", "batch")
    return map_task(dealt, run, "gram boolean, batch int, word bigint, n bigint")


def _words(batch: int, parts: list) -> pa.RecordBatch:
    hashes = np.concatenate([p[0] for p in parts])
    counted = np.concatenate([p[1] for p in parts])
    distinct, place = np.unique(hashes, return_inverse=True)
    n = np.bincount(place, weights=counted, minlength=len(distinct)).astype(np.int64)
    return _rows(False, batch, distinct, n)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function: Stirling's series after eight steps of the recurrence."""
    y, steps = x + 8.0, np.zeros_like(x)
    for i in range(8):
        steps += np.log(x + i)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) - steps


#: Logarithms of the gamma function at n + 1/2 and n + 1 for small n.
_HALVES, _WHOLES = (_log_gamma(np.arange(_SMALL) + x) for x in (0.5, 1.0))


def _gamma_of(n: np.ndarray, table: np.ndarray, more: float) -> np.ndarray:
    out = table[np.minimum(n, _SMALL - 1).astype(np.int64)]
    large = n >= _SMALL
    if large.any():
        out[large] = _log_gamma(n[large] + more)
    return out


def _estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of the counted decisions."""
    return _gamma_of(a, _HALVES, 0.5) + _gamma_of(b, _HALVES, 0.5) - _gamma_of(a + b, _WHOLES, 1.0) - math.log(math.pi)


_HALF = math.log(2)


class Subtrees:
    """Whole subtrees below contexts of two bytes, from distinct grams with their counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int):
        #: Per depth, from the deepest: sorted (context, byte), counts, and the place of each gram.
        self.depths, place, keys, n = [], np.arange(len(grams)), grams, counts.astype(np.float64)
        for d in range(depth, 1, -1):
            keys, back = np.unique(keys & ((1 << (8 * d + 8)) - 1), return_inverse=True)
            n, place = np.bincount(back, weights=n, minlength=len(keys)), back[place]
            self.depths.append((keys, n, place, back))

    def cells(self) -> tuple[np.ndarray, np.ndarray]:
        """Context of two bytes and byte, with their counts."""
        return self.depths[-1][0], self.depths[-1][1]

    def levels(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """Per bit of the byte: nodes of depth two, the log product of their children, and the
        mixture of the depths from three on for each gram (none at depth two)."""
        for level in range(8):
            child, at_child, mixes = None, None, []
            for keys, n, place, back in self.depths[:-1]:
                group, first = self._groups(keys, level)
                bit = (keys >> (7 - level)) & 1
                ones = np.bincount(group, weights=n * bit, minlength=len(first))
                zeros = np.bincount(group, weights=n, minlength=len(first)) - ones
                e = _estimate(zeros, ones)
                if child is None:
                    w, stop = e, np.ones(len(first))
                else:
                    below = np.bincount(group[back[at_child]], weights=child, minlength=len(first))
                    w = np.logaddexp(e, below) - _HALF
                    stop = np.exp(e - _HALF - w)
                k = (np.where(bit, ones[group], zeros[group]) + 0.5) / ((ones + zeros)[group] + 1.0)
                mixes.append((place, stop[group], k))
                child, at_child = w, first
            keys = self.depths[-1][0]
            group, first = self._groups(keys, level)
            nodes = (keys[first] >> 8 << 8) | (1 << level) | ((keys[first] & 255) >> (8 - level))
            if child is None:
                yield nodes, np.zeros(len(first)), None
                continue
            below = np.bincount(group[self.depths[-1][3][at_child]], weights=child, minlength=len(first))
            p = np.full(len(self.depths[0][2]), 0.5)
            for place, stop, k in mixes:
                p = stop[place] * k[place] + (1 - stop[place]) * p
            yield nodes, below, p

    @staticmethod
    def _groups(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Node of each (context, byte) at a bit, and the first of each node."""
        node = keys >> (8 - level)
        new = np.concatenate([[True], node[1:] != node[:-1]])
        return np.cumsum(new) - 1, np.flatnonzero(new)


class Top:
    """The two top levels and depth two: of each decision, the part that depths up to two give and the weight of those below."""

    def __init__(self, cells: np.ndarray, counts: np.ndarray, nodes: np.ndarray, products: np.ndarray, leaves: bool):
        contexts, row = np.unique(cells >> 8, return_inverse=True)
        deep = np.zeros((len(contexts), 256))
        deep[row, cells & 255] = counts
        below = np.zeros((len(contexts), 256))
        below[np.searchsorted(contexts, nodes >> 8), nodes & 255] = products
        last = contexts & 255
        shallow = np.zeros((256, 256))
        np.add.at(shallow, last, deep)
        root = shallow.sum(axis=0, keepdims=True)
        self.contexts = contexts
        self.own, self.rest = np.zeros((len(contexts), 256), np.float32), np.zeros((len(contexts), 256), np.float32)
        for level in range(8):
            at, size = slice(1 << level, 2 << level), 1 << (7 - level)
            split = lambda c, s=size: np.moveaxis(c.reshape(len(c), -1, 2, s).sum(axis=3), 2, 0)
            slices = [slice(i, i + SLICE) for i in range(0, len(contexts), SLICE)]
            n1, n0 = split(shallow), split(root)
            e1, e0 = _estimate(*n1), _estimate(*n0)
            below1 = np.zeros_like(e1)
            for part in slices:
                e2 = _estimate(*split(deep[part]))
                np.add.at(below1, last[part], e2 if leaves else np.logaddexp(e2, below[part, at]) - _HALF)
            w1 = np.logaddexp(e1, below1) - _HALF
            w0 = np.logaddexp(e0, w1.sum(axis=0, keepdims=True)) - _HALF
            stop1, stop0 = np.exp(e1 - _HALF - w1), np.exp(e0 - _HALF - w0)
            k1, k0 = self._one(n1), self._one(n0)
            for part in slices:
                n2, to = split(deep[part]), last[part]
                e2 = _estimate(*n2)
                stop2 = np.ones_like(e2) if leaves else np.exp(e2 - np.logaddexp(e2, below[part, at]))
                self.own[part, at] = stop0 * k0 + (1 - stop0) * (stop1[to] * k1[to] + (1 - stop1[to]) * stop2 * self._one(n2))
                self.rest[part, at] = (1 - stop0) * (1 - stop1[to]) * (1 - stop2)

    @staticmethod
    def _one(n: np.ndarray) -> np.ndarray:
        return (n[1] + 0.5) / (n[0] + n[1] + 1.0)

    def logs(self, grams: np.ndarray, counts: np.ndarray, depth: int) -> np.ndarray:
        """log10 probability of the byte of each gram after its context."""
        byte, row = grams & 255, np.searchsorted(self.contexts, (grams >> 8) & 0xFFFF)
        total = np.zeros(len(grams))
        for level, (_, _, p) in enumerate(Subtrees(grams, counts, depth).levels()):
            node, bit = (1 << level) | (byte >> (8 - level)), (byte >> (7 - level)) & 1
            own, rest = self.own[row, node].astype(np.float64), self.rest[row, node].astype(np.float64)
            total += np.log10(np.where(bit, own, 1 - rest - own) + (0.0 if p is None else rest * p))
        return total


def _dealt(grams: DataFrame, depth: int) -> DataFrame:
    """Grams by the last bytes of their contexts: three, or two where the tree has no more."""
    return grams.repartition(F.col("word").bitwiseAND(F.lit((1 << (8 * min(depth, 3) + 8)) - 256)))


def _free() -> None:
    """Give memory that Arrow keeps back; a worker stays for the tasks that follow."""
    pa.default_memory_pool().release_unused()


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    listed = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(listed).combine_chunks() if listed else None


def _gram_logs(stated: DataFrame, depth: int) -> DataFrame:
    """Rows (gram, batch, word, value): log10 probability of each gram a batch has stated."""
    sums = stated.groupBy("word").agg(F.sum("n").alias("c"), F.collect_list("batch").alias("batches"))
    counted = shared_table(sums, "gram-counts")

    def weigh(batches):
        table = _whole(batches)
        if table is None:
            return
        trees = Subtrees(np.asarray(table.column("word")), np.asarray(table.column("c")), depth)
        cells, n = trees.cells()
        sides = [(False, cells, n)] + [(True, nodes, below) for nodes, below, _ in trees.levels()]
        for side, word, value in sides:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(word), side)), pa.array(word), pa.array(value)], ["node", "word", "value"])
        _free()

    weighed = map_task(_dealt(counted.select("word", "c"), depth), weigh, "node boolean, word bigint, value double")
    top = weighed.groupBy("node", "word").agg(F.sum("value").alias("value")).toArrow()
    node, word, value = (top.column(c).to_numpy() for c in ("node", "word", "value"))
    node = node.astype(bool)
    handed = stated.sparkSession.sparkContext.broadcast(Top(word[~node], value[~node], word[node], value[node], depth == 2))

    def say(batches):
        table = _whole(batches)
        if table is None:
            return
        grams, lists = np.asarray(table.column("word")), table.column("batches").combine_chunks()
        logs = handed.value.logs(grams, np.asarray(table.column("c")), depth)
        for at in range(0, len(grams), 100_000):
            part = lists.slice(at, 100_000)
            of, batch = np.asarray(pa.compute.list_parent_indices(part)), pa.compute.list_flatten(part)
            columns = [pa.array(np.full(len(of), True)), batch, pa.array(grams[at : at + 100_000][of]), pa.array(logs[at : at + 100_000][of])]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "batch", "word", "value"])
        _free()

    return map_task(_dealt(counted, depth), say, "gram boolean, batch int, word bigint, value double")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every row.

    Contexts have up to ``depth`` bytes, 2 to 6. Null and empty texts have one token, their end, and a score of 0.
    Without training documents nothing is known and every byte is as likely as any other. Rows that
    repeat an id are scored one by one.
    """
    if not 2 <= depth <= 6:
        raise ValueError(f"depth {depth} is not between 2 and 6")
    batched = _batched(docs, id_col, text_col)
    stated = shared_table(_statements(batched, depth), "statements")
    words = stated.where("not gram")
    of_word = Window.partitionBy("word")
    counted = words.select(
        "batch", "word", F.sum("n").over(of_word).alias("c"), F.row_number().over(of_word.orderBy("batch")).alias("place")
    )
    counted = shared_table(counted, "word-counts")
    firsts = counted.where("place = 1 and c > 0").agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    distinct, total = int(firsts[0]), int(firsts[1])
    logs_of_grams = _gram_logs(stated.where("gram"), depth)
    size = total + 0.5 * (distinct + 1)

    def run(texts: pa.Table, needed: pa.Table) -> pa.Table:
        of_gram = np.asarray(needed.column("gram").to_numpy(), bool)

        def ordered(chosen: np.ndarray) -> tuple[pd.Index, np.ndarray]:
            # A batch that is stated in parts may ask for a word more than once.
            word, first = np.unique(needed.column("word").to_numpy()[chosen], return_index=True)
            return pd.Index(word), needed.column("value").to_numpy()[chosen][first]

        known, counts = ordered(~of_gram)
        grams, said = ordered(of_gram)
        logs = np.log10((counts + 0.5) / size)
        out = []
        for at in range(0, texts.num_rows, 512):
            piece = texts.slice(at, 512).combine_chunks()
            listed = text_bytes(piece.column("text").combine_chunks())
            hashes, sizes = _with_ends(listed)
            place = known.get_indexer(hashes)
            starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            base = np.add.reduceat(logs[place], starts)
            n_known = np.add.reduceat((counts[place] > 0).astype(np.int64), starts)
            cell, ends = _grams(listed, depth)
            sums = np.concatenate([[0.0], np.cumsum(said[grams.get_indexer(cell)] if len(cell) else [])])
            found = sums[ends[1:]] - sums[ends[:-1]]
            n_bytes = np.array([len(t) for t in listed])
            bits = -found / math.log10(2) / np.maximum(n_bytes, 1)
            out.append(
                pa.table(
                    [piece.column("doc_id"), piece.column("held_out"), pa.array(sizes), pa.array(n_known), pa.array(np.full(len(sizes), total)), pa.array(base), pa.array(found), pa.array(bits)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
                )
            )
        _free()
        return pa.concat_tables(out)

    id_type = batched.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"
    needed = counted.select(F.lit(False).alias("gram"), "batch", "word", F.col("c").cast("double").alias("value")).unionByName(logs_of_grams)
    return batched.groupBy("batch").cogroup(needed.groupBy("batch")).applyInArrow(run, schema)
