import itertools
import random

import numpy as np
import pytest
from llm_tools import documents, odd_rows, sentence
from tidemark.llm import ngram_join
from tidemark.llm.components import components


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Per row (doc_id, size, component) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t, _ in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations([s for s in sets if s[0] is not None], 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            low, high = sorted((root(i), root(j)))
            parent[high] = low
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def family(seed):
    """Copies with edits, chains of copies, a passage many share, texts near the threshold."""
    rng = random.Random(seed)
    texts = []
    for _ in range(4):
        base = sentence(rng, rng.choice([7, 12, 40, 150, 400]), 5000)
        texts.append(base)
        for _ in range(6):
            texts.append(edited(rng, base, rng.randrange(0, 8)))
        step = base
        for _ in range(6):
            step = edited(rng, step, 2)
            texts.append(step)
    passage = sentence(rng, 50, 5000)
    texts += [f"{sentence(rng, rng.randrange(1, 60), 5000)} {passage} {sentence(rng, rng.randrange(1, 60), 5000)}" for _ in range(30)]
    texts += [t.upper() for t in texts[:5]] + texts[:10]
    rng.shuffle(texts)
    return [(i * 7 % 1009, t, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_all_pairs(spark, seed):
    rows = family(seed)
    assert got(ngram_join.near_duplicates(documents(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = odd_rows()
    expect = {(i, n): c for i, n, c in brute([r for r in rows if r[0] is not None])}
    for row in ngram_join.near_duplicates(documents(spark, rows)).collect():
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["n_shingles"] > 0
        else:
            assert expect[row["doc_id"], row["n_shingles"]] == row["component_id"]


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rows = family(3)
    assert got(ngram_join.near_duplicates(documents(spark, rows))) == brute(rows)


def test_ids_with_several_texts_join_their_groups(spark):
    rng = random.Random(5)
    a, b = sentence(rng, 60), sentence(rng, 80)
    rows = [(1, a, None), (2, b, None), (3, a, None), (3, b, None), (4, edited(rng, b, 1), None)]
    assert {r["component_id"] for r in ngram_join.near_duplicates(documents(spark, rows)).collect()} == {1}


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(9)
    for _ in range(400):
        size = int(rng.integers(1, 500))
        a = np.unique(rng.integers(1, 2**63, size).astype(np.uint64))
        most = len(a) // 9 + 2
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[: len(a) - int(rng.integers(0, most))]], rng.integers(1, 2**63, int(rng.integers(0, most))).astype(np.uint64)]))
        if len(b) and ngram_join.linked(len(a), len(b), len(np.intersect1d(a, b))):
            assert set(ngram_join.signatures(a).tolist()) & set(ngram_join.signatures(b).tolist())


def test_keep_one_keeps_the_smallest_and_all_columns(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 1 and sorted(i for i in ids if i) == [1, 2, 3, 4, 7, 8, 9, 10, 12]


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    random.Random(1).shuffle(links)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "x bigint, y bigint")).collect()}
    assert all(found[i] == 0 for i in range(1, 301)) and all(found[1000 + i] == 1000 for i in range(1, 200))
