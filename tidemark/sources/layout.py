"""Event tables stored by admission, so that measures need not move their rows.

A stored table has two parts. Rows of ordinary keys are bucketed and sorted by the key, one file
per bucket, and a join or an aggregate by the key reads them where they lie. A key with more rows
than a task should take, and rows without a key, would fill a single bucket; they are kept
beside it as a plain table, whose joins Spark can split as always.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scale import materialise, skew_join

#: Rows of one key above which it is kept out of the buckets.
UNEVEN_ROWS = 2_000_000


@dataclass(frozen=True)
class Stored:
    """A table in two parts: ``even`` is bucketed by ``keys``, ``uneven`` is not."""

    even: DataFrame
    uneven: DataFrame
    keys: tuple[str, ...]

    def whole(self) -> DataFrame:
        return self.even.unionByName(self.uneven)


def store(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    buckets: int,
    sort: Sequence[str] = (),
    uneven_rows: int = UNEVEN_ROWS,
    mode: str = "errorifexists",
) -> Stored:
    """Write ``df`` as the catalog tables ``name`` and ``name_uneven``.

    Keys are counted in one aggregate; those with more than ``uneven_rows`` rows are at most
    rows / ``uneven_rows`` many. The number of buckets should give files of a few hundred megabytes,
    and has to be the same for all tables that are joined with each other.
    """
    keys = tuple(keys)
    hot = df.dropna(subset=list(keys)).groupBy(*keys).count().where(F.col("count") > uneven_rows).select(*keys)
    hot = materialise(hot, "uneven-keys")
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    even = skew_join(df.where(known), hot, keys, "left_anti").select(*df.columns)
    uneven = skew_join(df.where(known), hot, keys, "left_semi").select(*df.columns).unionByName(df.where(~known))
    # Dealt as the buckets are, each task writes one file and no bucket is in pieces.
    writer = even.repartition(buckets, *keys).write.mode(mode).format("parquet").bucketBy(buckets, *keys)
    (writer.sortBy(*keys, *sort) if sort else writer.sortBy(*keys)).saveAsTable(name)
    uneven.write.mode(mode).format("parquet").saveAsTable(f"{name}_uneven")
    return load(df.sparkSession, name, keys)


def load(spark: SparkSession, name: str, keys: Sequence[str]) -> Stored:
    return Stored(spark.table(name), spark.table(f"{name}_uneven"), tuple(keys))


def load_measure_tables(spark: SparkSession, schema: str, names: Sequence[str], keys: Sequence[str], stored: Sequence[str]) -> Mapping[str, DataFrame | Stored]:
    """Tables ``schema.name``; those in ``stored`` were written by ``store``."""
    return {n: load(spark, f"{schema}.{n}", keys) if n in stored else spark.table(f"{schema}.{n}") for n in names}
