import hashlib
import math
import random

import numpy as np
from llm_tools import CLASHING
from pyspark.sql import types as T
from tidemark.llm import vector_codes

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        *[T.StructField(c, T.StringType()) for c in ["v", "code", "error", "part", "entry", *CLASHING] if c != "label"],
    ]
)


def table(spark, rows):
    extra = len(VECTORS.fields) - 3
    return spark.createDataFrame([(i, v, l, *["?"] * extra) for i, v, l in rows], VECTORS).repartition(3)


def brute(rows, parts=16, entries=64, rounds=2):
    """Every part against every entry, in whole numbers."""
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v], l) for i, v, l in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    length = max({len(v) for _, v, _ in fine}, key=lambda n: (sum(len(v) == n for _, v, _ in fine), n))
    fine = [(i, v + [0] * (-length % parts), l) for i, v, l in fine if len(v) == length]
    width = len(fine[0][1]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    seeds = sorted(fine, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v)[p] for _, v, _ in seeds] for p in range(parts)]

    def assign(v):
        out = []
        for part, book in zip(cut(v), books):
            out.append(min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book)))
        return out

    for _ in range(rounds):
        near = [(cut(v), assign(v)) for _, v, _ in fine]
        for p in range(parts):
            groups = {}
            for parted, found in near:
                groups.setdefault(found[p][1], []).append(parted[p])
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    rows, per_label = [], {}
    for i, v, l in fine:
        found = assign(v)
        error = sum(d for d, _ in found)
        per_label[l] = per_label.get(l, 0) + error
        rows.append((i, "".join(f"{k:02x}" for _, k in found), error, l))
    return sorted(((i, c, e, per_label[l], digest) for i, c, e, l in rows), key=str)


def got(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def test_masks_give_the_nearest_entry_and_the_lowest_on_ties():
    rng = np.random.default_rng(1)
    for k, width, spread in [(64, 4, 300), (64, 4, 4), (64, 1, 50), (1, 3, 10), (13, 7, 3), (64, 2, 10**8)]:
        entries = rng.integers(-spread, spread, (k, width))
        x = rng.integers(-2 * spread, 2 * spread, (500, width))
        slices = vector_codes.Slices(entries)
        apart = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        best, far = slices.nearest(x)
        assert (best == apart.argmin(axis=1)).all() and (far == apart.min(axis=1)).all()
        radius = np.full(len(x), spread // 2)
        inside = (np.abs(x[:, None] - entries[None]) <= radius[:, None, None]).all(axis=2)
        masks = [sum(1 << int(i) for i in np.flatnonzero(row)) for row in inside]
        assert slices.candidates(x, radius).tolist() == masks


def test_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(i * 3 - 50, [rng.gauss(0, 0.3) for _ in range(32)], rng.choice([None, 1, 2, 3])) for i in range(150)]
    same = [rng.gauss(0, 0.3) for _ in range(32)]
    rows += [(1000 + i, same, 9) for i in range(100)]
    rng.shuffle(rows)
    assert got(vector_codes.compress(table(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rng = random.Random(3)
    vector = lambda n=32: [rng.choice([-1.5, -0.001, 0.0, 0.25, 3.0]) for _ in range(n)]
    rows = [(i, vector(), i % 2) for i in range(5)] + [(None, vector(), None), (None, vector(), 1), (2, vector(), None), (2, vector(), 7)]
    rows += [(50, None, 1), (51, [], 1), (52, [None] * 32, 1), (53, [math.nan] + [0.0] * 31, 1), (54, [math.inf] * 32, 1), (55, [-math.inf] * 32, None), (56, vector(16), 1)]
    assert got(vector_codes.compress(table(spark, rows))) == brute(rows)
    uneven = [(i, vector(19), None) for i in range(40)]
    assert got(vector_codes.compress(table(spark, uneven))) == brute(uneven)
    huge = got(vector_codes.compress(table(spark, [(1, [3e38] * 32, 0), (2, [-3e38] * 32, 0), (3, [1.0] * 32, 0)])))
    assert [r[:3] for r in huge] == [(1, "00" * 16, 0), (2, "01" * 16, 0), (3, "02" * 16, 0)]


def test_codes_decode_to_their_entries(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(19)], 0) for i in range(200)]
    vectors = vector_codes.whole_vectors(table(spark, rows))
    books = vector_codes.fit(vectors)
    coded = vector_codes.encode(vectors, books)
    whole = {r["vec_id"]: np.array(r["v"]) for r in vectors.collect()}
    back = {r["vec_id"]: np.array(r["v"]) for r in vector_codes.decode(coded, books).collect()}
    for r in coded.collect():
        apart = ((whole[r["vec_id"]] - back[r["vec_id"]]) ** 2).sum()
        # The filled-up zeros may differ from their entry; entries there stay zero.
        assert len(back[r["vec_id"]]) == 19 and apart == r["error"]
