"""Period cohorts, per-stratum rates and deterministic stratified selection."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.hashing import HASH_BITS, hash_mod, stable_hash
from ..functions.predicates import between, clamp, in_period
from ..functions.timeops import boundary_diff
from .rows import first_time, present
from .scale import materialise, repeat_rows, skew_join

#: Rows that a slice of the hash range holds on average; the number of slices follows the rows.
ROWS_PER_SLICE = 250_000
#: Bits of the hash that slices may use; a finer cut than this is never needed.
MOST_BITS = 31


def period_cohort(
    admissions: DataFrame,
    coded: DataFrame,
    events: DataFrame,
    key: str,
    admit_ts: str,
    event_ts: str,
    period: tuple,
    offset: tuple[int, int],
    unit: str = "MINUTE",
    carry: Sequence[str] = (),
    alias: str = "first_event",
) -> DataFrame:
    """Coded admissions of a period whose first event falls in an offset range.

    ``coded`` and ``events`` hold the rows that qualify. The offset counts unit
    boundaries from admission to the first event, both limits in.
    """
    admitted = admissions.where(in_period(admit_ts, *period)).select(*carry, key, admit_ts).distinct()
    firsts = first_time(events, [key], event_ts, alias)
    # Admissions are distinct here and each side is reduced to one row per key.
    joined = present(admitted, coded, [key]).join(firsts, key)
    return joined.where(between(boundary_diff(unit, admit_ts, alias), *offset))


@dataclass(frozen=True)
class RateSpec:
    """Rate in percent: ``low + hash mod span``, the hash taken from stratum and salt."""

    name: str
    low: int
    span: int
    salt: int


def stratum_rates(
    df: DataFrame, stratum: str, specs: Sequence[RateSpec], method: str = "md5"
) -> DataFrame:
    """One row per stratum with its rates between 0 and 1."""
    return df.select(stratum).distinct().select(
        stratum,
        *[
            ((F.lit(s.low) + hash_mod(s.span, stratum, s.salt, method=method)) / F.lit(100.0)).alias(s.name)
            for s in specs
        ],
    )


def _hashed(
    df: DataFrame, stratum: str, id_column: str, salt: int, method: str, rows_per_slice: int
) -> DataFrame:
    """Rows with their hash and the slice of the hash range it falls in.

    Rows and hashes are written once; counting slices, finding the cut and taking the rows read
    what was written, so the input is read and hashed a single time. There are as many slices as
    the written rows ask for.
    """
    counted = Observation("hashed rows")
    hashed = df.withColumn("_h", stable_hash(id_column, stratum, salt, method=method)).observe(counted, F.count(F.lit(1)).alias("n"))
    hashed = materialise(hashed, "hashed")
    ask = max(1.0, counted.get["n"] / rows_per_slice)
    bits = min(MOST_BITS, math.ceil(math.log2(ask)))
    return hashed.withColumn("_slice", F.shiftright("_h", HASH_BITS[method] - bits))


def _slice_offsets(hashed: DataFrame, stratum: str) -> DataFrame:
    """Per (stratum, slice): rows in it, rows in earlier slices, rows in the stratum.

    The count is merged inside each task. The windows see one row per slice.
    """
    in_stratum = Window.partitionBy(stratum)
    earlier = in_stratum.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hashed.groupBy(stratum, "_slice").agg(F.count("*").alias("_n"))
    return sizes.select(
        stratum,
        "_slice",
        "_n",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(in_stratum).alias("cnt"),
    )


def hash_rank(
    df: DataFrame,
    stratum: str,
    id_column: str,
    salt: int,
    method: str = "md5",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Rank rows of a stratum in a reproducible random order; adds ``rn`` and ``cnt``.

    A stratum may hold most of the data, so it is not sorted in one place. The
    hash range is cut into equal slices; counting them gives each slice its first
    rank, and rows are then ranked inside their (stratum, slice) only. Ids must be
    unique inside a stratum. NULL is a stratum like any other.
    """
    hashed = _hashed(df, stratum, id_column, salt, method, rows_per_slice)
    offsets = _slice_offsets(hashed, stratum).drop("_n")
    inside = Window.partitionBy(stratum, "_slice").orderBy("_h", id_column)
    ranked = skew_join(hashed, offsets, [stratum, "_slice"], null_safe=True).withColumn(
        "rn", F.col("_before") + F.row_number().over(inside)
    )
    return ranked.drop("_h", "_slice", "_before")


def share_size(
    stratum: str, rate: str, jitter_salt: int | None, count: str = "cnt", method: str = "md5"
) -> Column:
    """Rows to select of a stratum: ``floor(rate * rows)`` plus -1, 0 or 1, within 0 .. rows."""
    jitter = F.lit(0) if jitter_salt is None else hash_mod(3, stratum, jitter_salt, method=method) - 1
    wanted = F.floor(F.col(rate) * F.col(count)).cast("bigint") + jitter
    return clamp(wanted, F.lit(0).cast("bigint"), F.col(count))


def select_fraction(
    df: DataFrame,
    stratum: str,
    id_column: str,
    rates: DataFrame,
    rate: str,
    salt: int,
    jitter_salt: int | None = None,
    method: str = "md5",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The stratum's share of rows with the lowest hash ranks; the same rows every time.

    Slice counts tell in which slice each stratum's cut lies. Rows of earlier
    slices are taken as they are; only the rows of that one slice are sorted.
    ``rates`` has one row per stratum. Ids must be unique inside a stratum.
    """
    hashed = _hashed(df, stratum, id_column, salt, method, rows_per_slice)
    sized = skew_join(_slice_offsets(hashed, stratum), rates.select(stratum, rate), [stratum], null_safe=True)
    sized = sized.withColumn("_keep", share_size(stratum, rate, jitter_salt, method=method))
    # ``_left``: rows to take from the slice with the cut; NULL where the slice is taken whole.
    taken = sized.where("_before < _keep").selectExpr(
        stratum, "_slice", "if(_before + _n > _keep, _keep - _before, NULL) AS _left"
    )
    # One row per stratum and slice; written, so that both branches below read the counts, not the rows again.
    taken = materialise(taken, "taken")
    # Joined by slice as well, so even a stratum with most of the rows is spread evenly.
    tagged = skew_join(hashed, taken, [stratum, "_slice"], null_safe=True)
    in_order = Window.partitionBy(stratum, "_slice").orderBy("_h", id_column)
    edge = (
        tagged.where("_left IS NOT NULL")
        .withColumn("_rn", F.row_number().over(in_order))
        .where("_rn <= _left")
    )
    whole = tagged.where("_left IS NULL")
    return whole.select(*df.columns).unionByName(edge.select(*df.columns))


def select_nested(
    df: DataFrame,
    subset: DataFrame,
    stratum: str,
    id_column: str,
    rates: DataFrame,
    rate: str,
    salt: int,
    jitter_salt: int | None = None,
    method: str = "md5",
) -> DataFrame:
    """A share of the rows whose id is in ``subset``; ranks and sizes count only those.

    A subset that brings the stratum along is ranked as it is, without a join with ``df``.
    """
    whole = {stratum, id_column} <= set(subset.columns)
    inner = subset if whole else present(df, subset, [id_column])
    return select_fraction(inner, stratum, id_column, rates, rate, salt, jitter_salt, method)


def surrogate_ids(
    df: DataFrame, order: Sequence[str], start: Column | int, alias: str = "new_id"
) -> DataFrame:
    """Dense ids ``start + 1, start + 2, ...`` in the given order.

    Rows are range-partitioned and sorted, and each partition counts on its own;
    the partitions' offsets are then added. The sorted rows are written once,
    because the boundaries Spark samples may differ when they are computed again.
    ``order`` has to end in a unique column. ``start`` may be a scalar subquery.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(ordered.withColumn("_pos", F.monotonically_increasing_id()), "ranked")
    # The upper bits of _pos are the partition, the lower 33 the row in it.
    placed = placed.withColumn("_part", F.shiftright("_pos", 33)).withColumn(
        "_row", F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: the number of tasks, not of data rows, bounds this window.
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    # As many rows as there are partitions, so sending it to every task is safe.
    numbered = placed.join(F.broadcast(offsets), "_part")
    first = start if isinstance(start, Column) else F.lit(start)
    new_id = first + F.col("_before") + F.col("_row") + 1
    return numbered.withColumn(alias, new_id).drop("_pos", "_part", "_row", "_before")


def grid(months: DataFrame, per_row: Column | int | str, alias: str = "n") -> DataFrame:
    """Every row of ``months`` with the numbers ``1 .. per_row``; no join involved."""
    times = F.lit(per_row) if isinstance(per_row, int) else per_row
    return repeat_rows(months, times, alias).withColumn(alias, F.col(alias) + 1)
