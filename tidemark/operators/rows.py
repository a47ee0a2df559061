"""Choosing rows: best per group, ties at the first time, top k, presence tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import ColumnLike, as_column
from ..functions.timeops import shift_us, slot_start
from .scale import skew_join, spread_number


def sort_output(df: DataFrame, *by: str, descending: bool = False) -> DataFrame:
    """Global sort for the final reader; NULLs come first when ascending.

    Rows with equal sort values are told apart by a number, so that a value that
    very many rows share is still sorted by several tasks.
    """
    order = [F.desc(c) if descending else F.asc(c) for c in by]
    return df.withColumn("_tie", spread_number(df)).orderBy(*order, "_tie").drop("_tie")


def top_k(df: DataFrame, k: int, *order: ColumnLike) -> DataFrame:
    """First k rows; give a unique last column so that ties cannot vary."""
    return df.orderBy(*[as_column(c) for c in order]).limit(k)


def best_row(df: DataFrame, partition: Sequence[str], order: Sequence[ColumnLike]) -> DataFrame:
    """Keep the first row of each partition.

    Spark cuts every task's share to one row per partition before the shuffle
    (``WindowGroupLimit``), so a hot partition costs no task more than one row
    from each of the others.
    """
    w = Window.partitionBy(*partition).orderBy(*[as_column(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_time(
    df: DataFrame, keys: Sequence[str], ts: ColumnLike, alias: str = "first_time"
) -> DataFrame:
    """Earliest time per key."""
    return df.groupBy(*keys).agg(F.min(as_column(ts)).alias(alias))


def rows_at_first(df: DataFrame, keys: Sequence[str], ts: str, where: Column | None = None) -> DataFrame:
    """All rows that carry their key's earliest time, ties kept.

    ``where`` limits which rows define the earliest time, not which are returned.
    """
    firsts = first_time(df if where is None else df.where(where), keys, ts, alias=ts)
    return skew_join(df, firsts, [*keys, ts], "left_semi")


def present(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of left whose key occurs in right."""
    return skew_join(left, right.select(*on).distinct(), on, "left_semi")


def absent(left: DataFrame, right: DataFrame, on: Sequence[str], where: Column | None = None) -> DataFrame:
    """Rows of left whose key does not occur in right (among rows passing ``where``)."""
    right = right if where is None else right.where(where)
    return skew_join(left, right.select(*on).distinct(), on, "left_anti")


def absent_within(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    anchor: str,
    ts: str,
    low_us: int,
    high_us: int,
    where: Column | None = None,
) -> DataFrame:
    """Rows of left with no row of right at ``anchor + low .. anchor + high`` (both ends in).

    Right is first reduced to the earliest and latest time per key and time
    slot. A slot is as long as the range, so a range touches two slots at most
    and never lies inside one; then the slot's latest time (for the first slot)
    or earliest time (for the second) answers the question exactly. No task sees
    a whole group of right, and no pairs within a key are formed.
    """
    width = high_us - low_us
    if width <= 0:
        raise ValueError("the range must have a positive length")
    keys = list(keys)
    right = right if where is None else right.where(where)
    slots = (
        right.withColumn("_slot", slot_start(ts, width))
        .groupBy(*keys, "_slot")
        .agg(F.min(ts).alias("_min"), F.max(ts).alias("_max"))
    )
    first_slot = slot_start("_from", width)
    ranges = (
        left.select(*keys, anchor)
        .distinct()
        .withColumn("_from", shift_us(anchor, low_us))
        .withColumn("_to", shift_us(anchor, high_us))
        .withColumn("_slot", F.explode(F.array(first_slot, first_slot + width)))
    )
    found = (
        skew_join(ranges, slots, [*keys, "_slot"])
        .where((F.col("_max") >= F.col("_from")) & (F.col("_min") <= F.col("_to")))
        .select(*keys, anchor)
        .distinct()
    )
    return skew_join(left, found, [*keys, anchor], "left_anti")
