"""Token ids in Parquet list columns: dictionary or delta pages, small row groups, page indexes.

Documents are sorted by id over the whole output, so a reader that wants some ids opens few
files, and inside a file few pages, because Spark's Parquet writer stores an offset and a
column index. ``ids`` uses a dictionary (a vocabulary is far smaller than a dictionary page
may be), ids and offsets of documents use delta pages. Metadata columns can be read without
the token column.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scale import scratch
from .common import forget_words, map_batches

END_ID = 2
VOCABULARY = "word_bpe_49k.json"
FILE_SCHEMA = "doc_id bigint, shard int, start_in_shard bigint, n_tokens bigint, ids array<int>"
#: Row groups and pages small enough to skip, pages of at most so many rows.
WRITER_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
}
#: Pieces a Python worker remembers before it starts anew; about 180 MB.
FORM_LIMIT = 800_000
#: Letters that are one character each in both cases and however they are composed.
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch


class Encoder(dict):
    """Ids, as little-endian bytes, of pieces of text without white space.

    The vocabulary drops white space and never merges across it, so a text's ids are those of
    its pieces in a row. Words of Latin letters skip the normaliser, which only makes them lower case,
    and the split, which leaves them whole; their bytes go to the merges straight away.
    """

    def __init__(self, path: str | None = None) -> None:
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.forms = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.as_bytes = {i: split(chr(i))[0][0] for i in range(0xC0, 0x100) if chr(i) not in "×÷"}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= FORM_LIMIT:
            self.clear()
        if _LATIN(piece):
            plain = piece.lower()
            if plain != piece:
                return self._keep(piece, self[plain])
            ids = [t.id for t in self.model.tokenize(plain if plain.isascii() else plain.translate(self.as_bytes))]
        elif piece[-1:] in (".", ",") and _LATIN(piece[:-1]):
            return self._keep(piece, self[piece[:-1]] + self[piece[-1]])
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return self._keep(piece, b"".join(map(self.forms.__getitem__, ids)))

    def _keep(self, piece: str, value: bytes) -> bytes:
        if len(piece) <= 64:
            self[piece] = value
        return value

    def text(self, text: str) -> bytes:
        spaced = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return b"".join(map(self.__getitem__, spaced.split(" ")))


_ENCODERS: dict[str | None, Encoder] = {}


def _encoder(path: str | None) -> Encoder:
    """One encoder per Python worker, kept between its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget_pieces() -> None:
    """Free the encoders of a worker whose next tasks only read."""
    _ENCODERS.clear()


def encode(docs: DataFrame, path: str | None = None, end_id: int | None = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids per document in ascending order of the id, numbered within each task's shard.

    Null texts are empty and keep only the end id; null ids sort first; rows that repeat an
    id are all encoded. Other columns are left out, whatever their names.
    """
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = chosen.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def make():
        forget_words()
        encoder, state = _encoder(path), {"start": 0}
        shard = TaskContext.get().partitionId()

        def work(batch):
            coded = [encoder.text(t) + tail for t in batch.column(1).to_pylist()]
            sizes = np.array([len(c) // 4 for c in coded], np.int64)
            ends = np.cumsum(sizes)
            flat = np.frombuffer(b"".join(coded), "<i4")
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
            starts = state["start"] + ends - sizes
            state["start"] += int(sizes.sum())
            shards = pa.array(np.full(len(sizes), shard, np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), shards, pa.array(starts), pa.array(sizes), lists],
                ["doc_id", "shard", "start_in_shard", "n_tokens", "ids"],
            )

        return work

    return map_batches(ordered, make, FILE_SCHEMA)


def write_tokens(docs: DataFrame, folder: str, **options) -> None:
    """Encode and write the files; one shard per file, in order of their names."""
    encode(docs, **options).write.options(**WRITER_OPTIONS).parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the files with ``start``, the number of ids of all documents before each one.

    The offsets broadcast hold one row per written file, not per document.
    """
    from pyspark.sql import Window

    rows = spark.read.schema(FILE_SCHEMA).parquet(folder)
    sizes = rows.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("shard", F.coalesce(before, F.lit(0)).alias("offset"))
    joined = rows.join(F.broadcast(offsets), "shard")
    return joined.select("doc_id", (F.col("offset") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids")


def new_folder(spark: SparkSession) -> str:
    """A new folder in the shared one, removed with the other intermediates."""
    return scratch(spark, "token-files")


def checksums(tokens: DataFrame) -> DataFrame:
    """Per document: start, number of ids and the CRC-32 of the ids as little-endian 32-bit numbers."""

    def make():
        forget_pieces()

        def work(batch):
            lists = batch.column(3)
            flat = np.asarray(lists.flatten(), "<u4").tobytes()
            ends = np.concatenate([[0], np.cumsum(np.asarray(batch.column(2)))]) * 4
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            columns = [*(batch.column(i) for i in range(3)), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

        return work

    return map_batches(tokens, make, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
