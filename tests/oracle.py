"""Compare registered queries with their SQL on DuckDB."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Spark type -> DuckDB types that count as the same.
SAME_TYPE = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "timestamp_ntz": {"TIMESTAMP"}, "date": {"DATE"}, "boolean": {"BOOLEAN"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return None if v is None else str(v)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    rel = con.sql(sql)
    expected = dict(zip(rel.columns, map(str, rel.types)))
    actual = dict(df.dtypes)
    if set(expected) != set(actual):
        return f"columns {sorted(actual)} expected {sorted(expected)}"
    for c, t in actual.items():
        if expected[c] not in SAME_TYPE.get(t, {t}):
            return f"column {c} is {t}, expected {expected[c]}"
    cols = sorted(expected)
    order = [rel.columns.index(c) for c in cols]
    key = lambda row: tuple((v is not None, v or "") for v in row)
    want = sorted((tuple(plain(r[i]) for i in order) for r in rel.fetchall()), key=key)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.select(*cols).collect()), key=key)
    if len(want) != len(got):
        return f"{len(got)} rows, expected {len(want)}"
    diffs = [(g, w) for g, w in zip(got, want) if g != w]
    if diffs:
        return f"{len(diffs)} of {len(want)} rows differ, first {dict(zip(cols, zip(*diffs[0])))}"
    if not want:
        return "both results are empty"
    return None
