import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tools import SF, documents, odd_rows
from tidemark.llm import byte_bpe
from tidemark.llm.queries import op11_byte_bpe

VOCABULARY = byte_bpe.Vocabulary()
TIKTOKEN = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})
TEXTS = st.text(st.sampled_from("ab eE'rstlvd .\n\t1２é字\U0001f600 \x1c"), max_size=60)
ODD = ["", "it's we'll I'D 'x 'r 'v", "  a  b \n\n c   ", "日本語 текст Ünïcode", "<|endoftext|>", "a" * 5000, " " * 3000 + "x", "\U0001f468‍\U0001f469‍\U0001f467", "\x00\x85 "]


def ids(text):
    return np.frombuffer(VOCABULARY.encode(text), "<u4").tolist()


def test_every_token_is_the_encoding_of_its_bytes():
    rng = random.Random(1)
    for token in rng.sample(sorted(VOCABULARY.ranks), 3000):
        assert byte_bpe.PrefixTable(VOCABULARY, token).ids() == [VOCABULARY.ranks[token]]


def test_ids_equal_the_plain_library():
    rng = random.Random(2)
    letters = "abcdefgh eth .,'123\n\tüßλ"
    texts = ODD + ["".join(rng.choices(letters, k=300)) for _ in range(200)]
    for text in texts:
        assert ids(text) == TIKTOKEN.encode_ordinary(text)
        assert VOCABULARY.decode(np.array(ids(text), "<u4")).decode() == text


def test_split_agrees_on_every_code_point():
    for c in [*range(0xD800), *range(0xE000, 0x3100), *range(0xFB00, 0x11000), *range(0x1F000, 0x1F700)]:
        if 0xD800 <= c < 0xE000:
            continue
        s = chr(c)
        text = f"a{s}b {s}{s}1{s} !{s}  {s}x"
        assert ids(text) == TIKTOKEN.encode_ordinary(text), hex(c)


def test_any_bytes_merge_as_plain_merging():
    rng = random.Random(3)
    for _ in range(300):
        data = bytes(rng.choices([*range(256), *b"theaion  "], k=rng.randrange(1, 40)))
        plain = [VOCABULARY.ranks[p] for p in VOCABULARY.merge(data)]
        assert byte_bpe.PrefixTable(VOCABULARY, data).ids() == plain


def test_tokens_stay_apart_as_in_plain_merging():
    rng = random.Random(5)
    ids_ = sorted(VOCABULARY.tokens)
    pairs = [(rng.choice(ids_), rng.choice(ids_)) for _ in range(20000)]
    for text in ("thethationerentheir " * 20, "aaaaaaaabbbbabab" * 5):
        data = text.encode()
        cuts = [(rng.randrange(len(data) - 24), rng.randrange(1, 8), rng.randrange(1, 8)) for _ in range(4000)]
        both = [(data[i : i + a], data[i + a : i + a + b]) for i, a, b in cuts]
        pairs += [(VOCABULARY.ranks[a], VOCABULARY.ranks[b]) for a, b in both if a in VOCABULARY.ranks and b in VOCABULARY.ranks]
    seen = set()
    for a, b in pairs:
        left, right = VOCABULARY.tokens[a], VOCABULARY.tokens[b]
        seen.add(VOCABULARY._stay_apart(a, b))
        assert VOCABULARY._stay_apart(a, b) == (VOCABULARY.merge(left + right) == [left, right])
    assert seen == {True, False}


def test_a_vocabulary_whose_ranks_do_not_rise(tmp_path):
    tokens = [bytes([i]) for i in range(256)]
    tokens += [b"abc", b"bc", b"ab", b"abcab", b"ca", b"cabc", b"bca"]
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    odd = byte_bpe.Vocabulary(str(path), r"(?s).+")
    plain = tiktoken.Encoding("odd", pat_str=r"(?s).+", mergeable_ranks=odd.ranks, special_tokens={})
    rng = random.Random(6)
    for _ in range(500):
        text = "".join(rng.choices("abc", k=rng.randrange(1, 30)))
        assert np.frombuffer(odd.encode(text), "<u4").tolist() == plain.encode_ordinary(text)


def test_append_and_replace_of_bytes():
    rng = random.Random(4)
    for _ in range(200):
        data = bytes(rng.choices(b"theation", k=rng.randrange(0, 400)))
        table = byte_bpe.PrefixTable(VOCABULARY, data)
        a = rng.randrange(len(data) + 1)
        b = rng.randrange(a, min(len(data), a + 5) + 1)
        new = bytes(rng.choices(b"theation", k=rng.randrange(4)))
        worked = table.replace(a, b, new)
        data = data[:a] + new + data[b:]
        assert table.last == byte_bpe.PrefixTable(VOCABULARY, data).last
        assert worked <= len(data) - a
        table.append(b"ther")
        assert table.last == byte_bpe.PrefixTable(VOCABULARY, data + b"ther").last


def test_edits_far_from_the_end_stop_early():
    table = byte_bpe.PrefixTable(VOCABULARY, b"the" * 5000)
    assert table.replace(6, 7, b"x") < 300


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.data())
def test_edits_of_texts_equal_a_new_encoding(text, data):
    start = data.draw(st.integers(0, len(text)))
    end = data.draw(st.integers(start, len(text)))
    new = data.draw(TEXTS)
    table = byte_bpe.TextTable(VOCABULARY, text)
    table.replace(start, end, new)
    fresh = byte_bpe.TextTable(VOCABULARY, text[:start] + new + text[end:])
    assert (table.text, table.ends, table.last) == (fresh.text, fresh.ends, fresh.last)
    table.append(new)
    assert table.ids() == TIKTOKEN.encode_ordinary(table.text)


def digests(text):
    expect = TIKTOKEN.encode_ordinary(text or "")
    return len(expect), hashlib.sha256(np.array(expect, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_tables_of_odd_rows(spark):
    rows = odd_rows() + [(100 + i, t, None) for i, t in enumerate(ODD)]
    docs = documents(spark, rows)
    got = byte_bpe.report(byte_bpe.encode(docs)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted((str(i), *digests(t)) for i, t, _ in rows)
    data = {r["doc_id"]: bytes(r["data"]) for r in byte_bpe.decode(byte_bpe.encode(docs.where("doc_id >= 100"))).collect()}
    assert data == {100 + i: t.encode() for i, t in enumerate(ODD)}


def test_stored_tables_take_edits(spark):
    rows = [(i, t, None) for i, t in enumerate(ODD)] + [(50, None, None), (None, "no id", None)]
    states = byte_bpe.prefix_tables(documents(spark, rows))
    edits = spark.createDataFrame(
        [(1, 3, 5, "XX"), (2, 10**9, 10**9, " more"), (5, 2500, 2500, "b"), (50, 0, 0, "new"), (3, 0, 4, None), (999, 0, 1, "?")],
        "doc_id long, start int, stop int, new string",
    )
    out = byte_bpe.edit(states, edits)
    expect = {i: t or "" for i, t, _ in rows}
    expect[1] = ODD[1][:3] + "XX" + ODD[1][5:]
    expect[2] += " more"
    expect[5] = "a" * 2500 + "b" + "a" * 2500
    expect[50] = "new"
    expect[3] = ODD[3][4:]
    assert {r["doc_id"]: r["ids"] for r in byte_bpe.state_ids(out).collect()} == {i: TIKTOKEN.encode_ordinary(t) for i, t in expect.items()}
    with pytest.raises(Exception, match="more than one edit"):
        byte_bpe.edit(states, edits.unionByName(edits.limit(1))).collect()


def test_unknown_ids_are_told(spark):
    with pytest.raises(ValueError, match="no token"):
        VOCABULARY.decode(np.array([10**6], "<u4"))


def test_query_equals_the_plain_library(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in op11_byte_bpe(spark, SF).collect()}
    assert got == {i: digests(t) for i, t in texts.items()}
