import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_tools import CLASHING
from pyspark.sql import types as T
from tidemark.llm import conversation_trie as ct

TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in ["a", "b", "depth", "parent", "pos", "t1", *CLASHING]],
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(*r, *["?"] * (len(TURNS.fields) - 4)) for r in rows], TURNS)


def brute(rows, family=None):
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            own.setdefault(conv, []).append((role or "", text or ""))
    whole = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if family else 0
        whole[c] = (own.get(c - c % family, [])[:h] if family else []) + said[h:]
    members, nodes = {}, {}
    for c, said in whole.items():
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(c)
    for path, convs in members.items():
        nodes[path] = {"children": 0, "leaves": 0, "saved": 0, "ends": []}
    for c, said in whole.items():
        nodes[tuple(said)]["ends"].append(c)
    for path in members:
        if path:
            nodes[path[:-1]]["children"] += 1
    for path, convs in members.items():
        own_saved = (len(convs) - 1) * len([w for w in (path[-1][1] if path else "").split(" ") if w])
        for d in range(len(path) + 1):
            nodes[path[:d]]["leaves"] += not nodes[path]["children"]
            nodes[path[:d]]["saved"] += own_saved
    return sorted(
        (
            (min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), n["children"], n["leaves"], n["saved"])
            + (hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest(),)
            for path, convs in members.items()
            for n in [nodes[path]]
        ),
        key=str,
    )


def got(df):
    assert df.columns == ct.COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def forest(seed, convs=120, texts=3, longest=9):
    rng = random.Random(seed)
    said = ["", "one", "two words", "three short words", "a b c d"]
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, longest)):
            rows.append((c * 3 + 1, t, rng.choice(["user", None]), rng.choice(said[:texts])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("family", [None, 20])
@pytest.mark.parametrize("piece", [1, 3, 4096])
def test_equals_brute_force(spark, piece, family):
    rows = forest(piece)
    assert got(ct.trie(table(spark, rows).repartition(7), family, piece)) == brute(rows, family)


def test_long_and_hot_conversations(spark, settings):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch=50, spark__sql__shuffle__partitions=16)
    rng = random.Random(9)
    long = [("user", rng.choice(["x y", "z"])) for _ in range(700)]
    rows = [(40, t, *s) for t, s in enumerate(long)]
    rows += [(43, t, *s) for t, s in enumerate(long[:500] + [("user", "else")] * 300)]
    rows += [(c, t, *s) for c in range(100, 160) for t, s in enumerate(long[:5])]
    rows += [(c, t, *s) for c in (41, 47) for t, s in enumerate(long)]
    for family in (None, 20):
        assert got(ct.trie(table(spark, rows).repartition(5), family, 16)) == brute(rows, family)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None),
        (1, 0, "user", "hi there"),
        (1, 0, "user", "hi there"),
        (2, 0, "user", "hi there"),
        (2, 5, "", None),
        (None, 0, "user", "no conversation"),
        (25, 0, "user", "left without turns, its family's first one is absent"),
        (-7, 0, "user", "below zero"),
        (-20, 1, "user", "its base"),
        (-(2**63), 0, "user", "lowest id"),
        (2**63 - 1, 3, "user", "x" * 100_000 + " y"),
        (3, 0, "userhi", " there"),
        (4, 0, "user", "hi  there"),
    ]
    for family in (None, 20):
        assert got(ct.trie(table(spark, rows), family)) == brute(rows, family)
    assert got(ct.trie(table(spark, rows[5:6]), 20)) == []
    only = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 1)
    turnless = [(only, 0, "user", "gone")]
    assert got(ct.trie(table(spark, turnless), 20)) == brute(turnless, 20) and len(brute(turnless, 20)) == 1


def test_cut_names_equal_running_names():
    rng = np.random.default_rng(1)
    sizes = [1, 2, 3, 8, 17, 64, 100]
    own = rng.integers(0, 2**63, sum(sizes)).astype(np.uint64)
    place = np.concatenate([np.arange(n) for n in sizes])
    expect = np.concatenate([np.bitwise_xor.accumulate(p) for p in np.split(own, np.cumsum(sizes)[:-1])])
    assert (ct.name_prefixes(own, place) == expect).all()
