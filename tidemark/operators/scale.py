"""What the other operators need to stay safe on very large and uneven inputs.

One path at every size: nothing here asks how large an input is, runs a job while a plan is
built, or hints a broadcast of data without a bound. Spark broadcasts a side of a join only after
checking its size, and splits uneven partitions of the others while the query runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import ColumnLike, as_column

_KEY = "_join_key_"

#: Plan steps that pass rows on in the order in which they were read.
_KEEPS_ORDER = {"Project", "Filter", "Union", "SubqueryAlias", "View", "Generate"}


def order_is_fixed(df: DataFrame) -> bool:
    """Whether a lost task would read the same rows in the same order again.

    True for rows straight from files; false once they went through a shuffle.
    """
    try:
        todo = [df._jdf.queryExecution().analyzed()]
        while todo:
            node = todo.pop()
            below = node.children()
            leaf = below.size() == 0
            if node.nodeName() == "InMemoryRelation" or not (leaf or node.nodeName() in _KEEPS_ORDER):
                return False
            todo += [below.apply(i) for i in range(below.size())]
        return True
    except AttributeError:
        return False


def spread_number(df: DataFrame) -> Column:
    """A number per row that is the same when a lost task runs again.

    Rows straight from files are numbered, which tells exact copies apart. Rows
    from a shuffle may come in another order next time, so their content counts.
    """
    if order_is_fixed(df):
        return F.monotonically_increasing_id()
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def _named(df: DataFrame, name: str) -> str:
    """The column's own spelling; names match whatever their case, as in Spark itself."""
    if name in df.columns:
        return name
    found = [c for c in df.columns if c.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"no single column {name!r} among {df.columns}")
    return found[0]


def skew_join(
    facts: DataFrame,
    dims: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join of many ``facts`` rows per key with few ``dims`` rows per key.

    Adaptive execution cuts a partition that a hot key has filled into pieces of its real size
    and repeats the matching rows of the other side, but only where both sides come straight
    from a shuffle made for the join and nothing above relies on it. An aggregate on one side,
    or one above by the same keys, would stand in its way. So the join is made on computed copies
    of the keys: both sides are dealt out for the join alone, and any number of hot keys of any
    size is split from the sizes seen, with no count beforehand. ``greatest(k, k)`` is a copy that
    Spark does not see through, and equality finds the common type of both sides itself.

    ``how`` keeps or tests fact rows: inner, left, left_semi or left_anti. With ``null_safe``
    a NULL key meets a NULL key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join cannot preserve the dims side: {how}")
    copy = lambda c: F.greatest(F.col(f"`{c}`"), F.col(f"`{c}`"))
    left_keys = {f"{_KEY}l{i}": copy(_named(facts, k)) for i, k in enumerate(on)}
    right_keys = {f"{_KEY}r{i}": copy(_named(dims, k)) for i, k in enumerate(on)}
    others = [c for c in dims.columns if c.lower() not in {k.lower() for k in on}]
    left = facts.withColumns(left_keys)
    right = dims.withColumns(right_keys).select(*right_keys, *[F.col(f"`{c}`") for c in others])
    same = [a.eqNullSafe(b) if null_safe else a == b for a, b in ((F.col(x), F.col(y)) for x, y in zip(left_keys, right_keys))]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    joined = left.join(right, condition, how)
    return joined.drop(*left_keys, *right_keys)


def repeat_rows(df: DataFrame, times: ColumnLike, index: str) -> DataFrame:
    """Repeat each row ``times`` times and number the copies from 0.

    Two short sequences instead of one long one keep a row with very many copies
    from needing one huge array.
    """
    block = 10_000
    starts = F.expr(f"explode(sequence(0L, _times - 1L, {block}L))")
    rest = F.expr(f"explode(sequence(_start, least(_start + {block - 1}L, _times - 1L)))")
    counted = df.withColumn("_times", as_column(times).cast("bigint")).where("_times > 0")
    return counted.withColumn("_start", starts).withColumn(index, rest).drop("_start", "_times")


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    The cluster's ``spark.checkpoint.dir``; where that is unset, a folder in the session's
    warehouse, which executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/tidemark-scratch").rstrip("/")


#: Folders written per application, so that they can be removed when their readers are done.
_WRITTEN: dict[str, list[str]] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder; what is written there goes with ``remove_intermediates``."""
    path = f"{shared_folder(spark)}/tidemark-{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write an intermediate that is read several times and return the written table.

    Cuts the lineage: later reads survive the loss of executors without
    recomputing what led here, and Spark knows the table's real size. The folder stays until
    ``remove_intermediates`` is called.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_intermediates(spark: SparkSession) -> int:
    """Delete what was written under ``scratch`` names in this application; returns how many folders were there.

    To be called when no DataFrame that reads them is needed any more.
    """
    removed = 0
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        removed += bool(where.getFileSystem(hadoop).delete(where, True))
    return removed
