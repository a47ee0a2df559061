"""Small inputs and plain Python versions the tests share."""

import random

import duckdb
import pandas as pd
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
#: Columns whose names the operators use themselves.
CLASHING = "size slice taken target n_words kept sign label batch word c component component_id n_shingles spans base shard start ids x y".split()

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHING],
    ]
)


def documents(spark, rows):
    """Rows of (doc_id, text, source) as a documents table with clashing extra columns."""
    full = [(i, t, None, s, None, *["?"] * len(CLASHING)) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def odd_rows():
    """Nulls, empty and very long texts, repeated rows and ids, ties, odd characters."""
    rng = random.Random(3)
    base = sentence(rng, 90)
    return [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n", None),
        (None, base, None),
        (4, base, "b"),
        (4, base, "b"),
        (5, base, "b"),
        (6, base + " extra", None),
        (7, sentence(rng, 30_000, 100_000), "a"),
        (7, sentence(rng, 60), "c"),
        (8, "x" * 200_000, "c"),
        (9, "été \U0001f600 naïve word   line\x0bfeed\x1cend", "\U0001f600"),
        (10, "one two", ""),
        (11, "ONE two", ""),
        (12, "!!! ### \x00 $$$", "b"),
    ]


def duck(sql, tables):
    """Rows of a query over pandas frames or files, as a sorted list of tuples of text, and its columns."""
    con = duckdb.connect()
    for name, table in tables.items():
        if isinstance(table, str):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{table}'")
        else:
            con.register(name, table)
    return as_rows(con.execute(sql).df())


def as_rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(show(v) for v in r) for r in frame[columns].itertuples(index=False))


def show(value):
    if value is None or value is pd.NA or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, float) and value == int(value):
        return str(int(value))
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def spark_rows(df):
    return as_rows(df.toPandas())
