"""Byte-level BPE by prefix dynamic programming: exact encoding, decoding, appends and edits.

Merging by lowest rank, leftmost first, gives a sequence of tokens if and only if every pair of
neighbours, merged on its own, stays that pair: the first merge across a boundary would already
happen in the pair alone. So each byte prefix has exactly one last token, the one that ends there
and fits the last token of the prefix before it. ``PrefixTable`` stores that token for every
prefix. Walking back from the end gives the ids; time is linear in the bytes, also for a word
of a megabyte. An append only adds entries. After an edit, entries before it stay, and entries
after it are kept as soon as as many in a row as the longest token has bytes are the same.

The pattern cuts a text into pieces that are merged separately. A match looks at most two
characters past its end and never back, so after an edit the cut starts again two
characters before it and stops at the first old boundary it meets.

Rules for odd rows: null texts are empty and have no ids; rows without an id and rows that repeat
an id are all encoded; other columns are left out, whatever their names; an empty table gives no rows.
Ids outside the vocabulary raise ``ValueError`` when decoded. Nothing is shuffled, so a hot id
or a very long text stays in its own task, where memory is bounded by the text.
"""

from __future__ import annotations

import base64
import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget_words, map_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pieces and pairs of tokens a Python worker remembers before it starts anew; some 100 MB.
PIECE_LIMIT, PAIR_LIMIT = 300_000, 400_000
_NEVER = 1 << 62
#: Last bytes by which the tokens that may end there are looked up, how many of them are remembered,
#: and characters of texts that are encoded together.
TAIL, TAIL_LIMIT, CHARS = 4, 100_000, 2_000_000
#: Characters past its end that a match of the pattern may look at.
AHEAD = 2


class Vocabulary:
    """Ranks of byte strings, with what encoding and decoding need of them."""

    def __init__(self, path: str | None = None, pattern: str | None = None) -> None:
        import regex

        if path is None or pattern is None:
            import public_tokenizers

            path = path or public_tokenizers.path(VOCABULARY)
            pattern = pattern or public_tokenizers.PATTERN
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.pattern = regex.compile(pattern)
        self._lengths = {rank: len(token) for rank, token in self.tokens.items()}
        self._as_bytes = {rank: rank.to_bytes(4, "little") for rank in self.tokens}
        #: Lengths of the tokens longer than a tail, longest first, by their last bytes.
        sizes: dict[bytes, set[int]] = {}
        for token in self.ranks:
            if len(token) > TAIL:
                sizes.setdefault(token[-TAIL:], set()).add(len(token))
        self._sizes = {tail: sorted(found, reverse=True) for tail, found in sizes.items()}
        self._tails: dict[bytes, list[tuple[int, int | None]]] = {}
        self._spines: dict[tuple[int, bool], tuple[list[bytes], list[int], bool]] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._pieces: dict[str, bytes] = {}

    def merge(self, data: bytes, down_to: int = 1) -> list[bytes]:
        """Plain merging, for short strings: the pair of lowest rank, leftmost first, until none or ``down_to`` parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [self.ranks.get(data[i : i + 2]) for i in range(len(data) - 1)]
        while True:
            known = [(r, i) for i, r in enumerate(ranks) if r is not None]
            if not known or len(parts) <= down_to:
                return parts
            i = min(known)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            for j in (i - 1, i):
                if 0 <= j < len(ranks):
                    ranks[j] = self.ranks.get(parts[j] + parts[j + 1])

    def _spine(self, token: int, right: bool) -> tuple[list[bytes], list[int], bool]:
        """What stands at one edge of a token while it is merged, from a byte to the whole, with its ranks.

        The flag tells whether ranks rise on the way, as they do in every vocabulary made by merging.
        """
        known = self._spines.get((token, right))
        if known is None:
            data = self.tokens[token]
            if len(data) == 1:
                known = [data], [token], True
            else:
                parts = [self.ranks[p] for p in self.merge(data, 2)]
                strings, ranks, rising = self._spine(parts[-1] if right else parts[0], right)
                known = [*strings, data], [*ranks, token], rising and max(parts) < token
            self._spines[token, right] = known
        return known

    def fits(self, before: int, token: int) -> bool:
        """Whether two tokens stay apart when their bytes are merged.

        Merges happen in the order of their ranks, so it is enough to follow what stands at the common
        edge: a merge across it must not come before the next one on either side, the left one first
        on ties. Where ranks do not rise, the bytes are merged.
        """
        known = self._pairs.get((before, token))
        if known is None:
            known = self._stay_apart(before, token)
            if len(self._pairs) >= PAIR_LIMIT:
                self._pairs.clear()
            self._pairs[before, token] = known
        return known

    def _stay_apart(self, before: int, token: int) -> bool:
        left, left_ranks, rising = self._spine(before, True)
        right, right_ranks, also = self._spine(token, False)
        i = j = 0
        while rising and also:
            across = self.ranks.get(left[i] + right[j])
            next_left = left_ranks[i + 1] if i + 1 < len(left) else _NEVER
            next_right = right_ranks[j + 1] if j + 1 < len(right) else _NEVER
            if across is not None:
                if across < max(left_ranks[i], right_ranks[j]):
                    break
                if across < next_left and across <= next_right:
                    return False
            if next_left == next_right == _NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1
        return self.merge(left[-1] + right[-1]) == [left[-1], right[-1]]

    def _endings(self, tail: bytes) -> list[tuple[int, int | None]]:
        """Sizes of the tokens a text with these last bytes may end with, longest first; None where more bytes decide."""
        short = [(size, self.ranks.get(tail[-size:])) for size in range(len(tail), 0, -1)]
        found = [(size, None) for size in self._sizes.get(tail, ())] + [(s, t) for s, t in short if t is not None]
        if len(self._tails) >= TAIL_LIMIT:
            self._tails.clear()
        self._tails[tail] = found
        return found

    def fill(self, data: bytes, last: list[int], stop: int | None = None) -> None:
        """Add to ``last`` the unique last token of every longer prefix of ``data``, up to ``stop`` bytes."""
        tails, ranks, pairs = self._tails, self.ranks, self._pairs
        for end in range(len(last) + 1, (len(data) if stop is None else stop) + 1):
            tail = data[max(0, end - TAIL) : end]
            for size, token in tails.get(tail) or self._endings(tail):
                if size >= end:
                    if size > end:
                        continue
                    token = ranks.get(data[:end]) if token is None else token
                    if token is not None:
                        break
                    continue
                if token is None:
                    token = ranks.get(data[end - size : end])
                    if token is None:
                        continue
                before = last[end - size - 1]
                apart = pairs.get((before, token))
                if apart or (apart is None and self.fits(before, token)):
                    break
            else:
                raise ValueError(f"byte {data[end - 1]} is not in the vocabulary")
            last.append(token)

    def learn(self, pieces: set[str]) -> None:
        """Remember the ids of pieces; in sorted order each shares the entries of its common prefix with the one before."""
        data, last, as_bytes = b"", [], self._as_bytes
        for piece in sorted(pieces):
            before, data = data, piece.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                self._pieces[piece], data = as_bytes[whole], before
                continue
            share, most = 0, min(len(data), len(last))
            while share < most and before[share] == data[share]:
                share += 1
            del last[share:]
            self.fill(data, last)
            self._pieces[piece] = b"".join(map(as_bytes.__getitem__, self.walk(last)))

    def walk(self, last: list[int]) -> list[int]:
        """Ids of a piece, from the last token of the whole back to the first."""
        out, end, sizes = [], len(last), self._lengths
        while end:
            out.append(last[end - 1])
            end -= sizes[out[-1]]
        return out[::-1]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if len(self._pieces) >= PIECE_LIMIT:
            self._pieces.clear()
        known, out, start = self._pieces, [], 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= CHARS):
                size, stop = size + len(texts[stop]), stop + 1
            cut = [self.pattern.findall(t) for t in texts[start:stop]]
            new = set().union(*cut).difference(known)
            self.learn(new)
            out += [b"".join(map(known.__getitem__, pieces)) for pieces in cut]
            for piece in [p for p in new if len(p) > 64]:
                del known[piece]
            start = stop
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        try:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        except KeyError as unknown:
            raise ValueError(f"no token has the id {unknown}") from None


class PrefixTable:
    """Bytes of one piece with the last token of each of their prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"", last: list[int] | None = None) -> None:
        self.vocabulary, self.data, self.last = vocabulary, data, [] if last is None else last
        vocabulary.fill(data, self.last)

    def ids(self) -> list[int]:
        return self.vocabulary.walk(self.last)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; no entry changes."""
        self.data += more
        self.vocabulary.fill(self.data, self.last)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:end]``; returns how many entries were worked out anew."""
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last, same, window = old[:start], 0, self.vocabulary.longest
        for size in range(start + 1, len(self.data) + 1):
            self.vocabulary.fill(self.data, self.last, size)
            after = size - start - len(new)
            same = same + 1 if after > 0 and old[size - shift - 1] == self.last[-1] else 0
            if same >= window:
                self.last += old[size - shift :]
                return size - start
        return len(self.data) - start


class TextTable:
    """A text, the ends of its pieces (characters) and the last token of every byte prefix of each piece."""

    def __init__(self, vocabulary: Vocabulary, text: str = "", ends: list[int] | None = None, last: list[int] | None = None) -> None:
        self.vocabulary, self.text = vocabulary, text
        if ends is None or last is None:
            ends, last = [], []
            for match in vocabulary.pattern.finditer(text):
                ends.append(match.end())
                last += PrefixTable(vocabulary, match.group().encode()).last
        self.ends, self.last = ends, last

    def _pieces(self):
        """(first character, bytes, their entries) of every piece."""
        start = at = 0
        for end in self.ends:
            data = self.text[start:end].encode()
            yield start, data, self.last[at : at + len(data)]
            start, at = end, at + len(data)

    def ids(self) -> list[int]:
        return [i for _, data, last in self._pieces() for i in PrefixTable(self.vocabulary, data, last).ids()]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in place of the characters ``start`` to ``end``; only pieces near them are cut and encoded again."""
        old_text, old_ends, old_last = self.text, self.ends, self.last
        self.text = old_text[:start] + new + old_text[end:]
        shift = len(new) - (end - start)
        # Pieces whose match never looked at a changed character, and at the end of the text, stay.
        first = bisect.bisect_left(old_ends, start - AHEAD + 1)
        at = old_ends[first - 1] if first else 0
        known = {e + shift for e in old_ends[bisect.bisect_left(old_ends, end) :]}
        ends, kept = old_ends[:first], len(old_text[:at].encode())
        last, begin = old_last[:kept], at
        first_old = old_text[at : old_ends[first]].encode() if first < len(old_ends) else b""
        while at < len(self.text) and not (at in known and at >= start + len(new)):
            match = self.vocabulary.pattern.match(self.text, at)
            data, entries = match.group().encode(), []
            if at == begin:
                # The first piece shares its unchanged prefix with the old piece.
                share = next((i for i, (a, b) in enumerate(zip(data, first_old)) if a != b), min(len(data), len(first_old)))
                entries = old_last[kept : kept + share]
            last += PrefixTable(self.vocabulary, data, entries).last
            at = match.end()
            ends.append(at)
        if at < len(self.text):
            rest = bisect.bisect_right(old_ends, at - shift)
            ends += [e + shift for e in old_ends[rest:]]
            last += old_last[len(old_last) - len(self.text[at:].encode()) :]
        self.ends, self.last = ends, last


_VOCABULARIES: dict[tuple[str | None, str | None], Vocabulary] = {}


def _vocabulary(path: str | None, pattern: str | None) -> Vocabulary:
    """One vocabulary per Python worker, kept between its tasks."""
    if (path, pattern) not in _VOCABULARIES:
        _VOCABULARIES[path, pattern] = Vocabulary(path, pattern)
    return _VOCABULARIES[path, pattern]


def _lists(flat: np.ndarray, sizes: list[int]) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int64()), pa.array(flat)).cast(pa.list_(pa.int32()))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of every row."""

    def make():
        forget_words()
        vocabulary = _vocabulary(path, pattern)

        def work(batch):
            coded = vocabulary.encode_all([t or "" for t in batch.column(1).to_pylist()])
            flat = np.frombuffer(b"".join(coded), "<i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(flat, [len(c) // 4 for c in coded])], ["doc_id", "ids"])

        return work

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(chosen, make, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids and the bytes they stand for."""

    def make():
        vocabulary = _vocabulary(path, pattern)

        def work(batch):
            data = [vocabulary.decode(ids) for ids in _id_arrays(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], ["doc_id", "ids", "data"])

        return work

    return map_batches(encoded.select("doc_id", "ids"), make, "doc_id bigint, ids array<int>, data binary")


def _id_arrays(lists: pa.Array) -> list[np.ndarray]:
    flat = np.asarray(lists.flatten(), "<u4")
    ends = np.cumsum([0, *(n or 0 for n in lists.value_lengths().to_pylist())])
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def report(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, digest of the ids and digest of the bytes decoded from them."""

    def make():
        vocabulary = _vocabulary(path, pattern)

        def work(batch):
            arrays = _id_arrays(batch.column(1))
            digests = [hashlib.sha256(a.tobytes()).hexdigest() for a in arrays]
            decoded = [hashlib.sha256(vocabulary.decode(a)).hexdigest() for a in arrays]
            columns = [batch.column(0), pa.array([len(a) for a in arrays], pa.int64()), pa.array(digests), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return work

    return map_batches(encoded.select("doc_id", "ids"), make, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


STATE = "doc_id bigint, text string, ends array<int>, last array<int>"


def _states(names: list, tables: list[TextTable]) -> pa.RecordBatch:
    ends = _lists(np.array([e for t in tables for e in t.ends], "<i4"), [len(t.ends) for t in tables])
    last = _lists(np.array([e for t in tables for e in t.last], "<i4"), [len(t.last) for t in tables])
    columns = [pa.array(names, pa.int64()), pa.array([t.text for t in tables], pa.string()), ends, last]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "ends", "last"])


def prefix_tables(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, ends of its pieces and the last token of each byte prefix: what later edits start from."""

    def make():
        vocabulary = _vocabulary(path, pattern)

        def work(batch):
            tables = [TextTable(vocabulary, t or "") for t in batch.column(1).to_pylist()]
            yield _states(batch.column(0).to_pylist(), tables)

        return work

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(chosen, make, STATE)


def edit(states: DataFrame, edits: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Stored tables after the ``edits`` (doc_id, start, stop, new): one replacement of characters per document.

    Places past the end count as the end, so an append has both there; a null ``new`` removes. Documents
    without an edit, and without an id, stay as they are. Several edits of one document raise an error.
    """

    def make():
        vocabulary = _vocabulary(path, pattern)

        def work(batch):
            tables = []
            for text, ends, last, start, stop, new in zip(*(batch.column(i).to_pylist() for i in range(1, 7))):
                table = TextTable(vocabulary, text, ends, last)
                if start is not None:
                    start = min(max(start, 0), len(text))
                    table.replace(start, min(max(stop if stop is not None else start, start), len(text)), new or "")
                tables.append(table)
            yield _states(batch.column(0).to_pylist(), tables)

        return work

    several = F.raise_error(F.lit("a document has more than one edit"))
    once = edits.where("doc_id is not null").groupBy("doc_id").agg(
        F.when(F.count("*") > 1, several).otherwise(F.max(F.struct("start", "stop", "new"))).alias("edit")
    )
    joined = states.join(once, "doc_id", "left").select("doc_id", "text", "ends", "last", "edit.start", "edit.stop", "edit.new")
    return map_batches(joined, make, STATE)


def state_ids(states: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ids read off stored tables by walking back through their last tokens."""

    def make():
        vocabulary = _vocabulary(path, pattern)

        def work(batch):
            rows = zip(*(batch.column(i).to_pylist() for i in range(1, 4)))
            ids = [TextTable(vocabulary, *row).ids() for row in rows]
            flat = np.array([i for row in ids for i in row], "<i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(flat, [len(i) for i in ids])], ["doc_id", "ids"])

        return work

    return map_batches(states.select("doc_id", "text", "ends", "last"), make, "doc_id bigint, ids array<int>")
