"""Changing tables: append if absent, update from a join, raise first values.

Nothing is changed in place: each operator returns the new table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeops import HOUR_US
from ..sources.tables import append
from .rows import absent, absent_within, first_time
from .scale import skew_join


def absent_candidates(
    base: DataFrame,
    candidates: DataFrame,
    on: Sequence[str],
    existing: Column | None = None,
    time_range: tuple[str, str, int, int] | None = None,
) -> DataFrame:
    """Candidates without a matching base row.

    A base row matches if it has the candidate's ``on`` values, passes
    ``existing`` and, with ``time_range = (anchor, ts, low_us, high_us)``, its
    ``ts`` lies at ``anchor + low .. anchor + high`` of the candidate.
    """
    if time_range is None:
        return absent(candidates, base, on, existing)
    anchor, ts, low, high = time_range
    return absent_within(candidates, base, on, anchor, ts, low, high, existing)


def append_absent(
    base: DataFrame,
    candidates: DataFrame,
    on: Sequence[str],
    existing: Column | None = None,
    time_range: tuple[str, str, int, int] | None = None,
) -> DataFrame:
    """Base plus the candidates that have no matching base row.

    Running it again changes nothing when the new rows themselves match
    ``existing``. Helper columns of the candidates that base lacks are dropped.
    """
    fresh = absent_candidates(base, candidates, on, existing, time_range)
    return append(base, fresh.select(*[c for c in fresh.columns if c in base.columns]))


def hours_around(low: float, high: float) -> tuple[int, int]:
    """Range in hours as microseconds, for ``time_range``."""
    return int(low * HOUR_US), int(high * HOUR_US)


def update_from(
    base: DataFrame,
    updates: DataFrame,
    on: Sequence[str],
    values: Mapping[str, Column] | Sequence[str],
    where: Column | None = None,
) -> DataFrame:
    """Base with columns replaced in rows that have a partner in updates and pass ``where``.

    ``values`` and ``where`` may use columns of both sides. A name that both sides have means the
    base's column; the other side's is ``new.<name>``. A list of names takes these columns from
    updates. Where updates repeat a key, the row with the smallest values counts, so that base rows
    are never multiplied.
    """
    columns = base.columns
    values = values if isinstance(values, Mapping) else {c: F.col(f"new.`{c}`") for c in values}
    others = [c for c in updates.columns if c not in on]
    row = F.struct(F.lit(True).alias("_hit"), *[F.col(f"`{c}`") for c in others])
    joined = skew_join(base, updates.groupBy(*on).agg(F.min(row).alias("new")), on, "left")
    joined = joined.withColumns({c: F.col(f"new.`{c}`") for c in others if c not in columns})
    hit = F.col("new._hit").isNotNull()
    hit = hit if where is None else hit & where
    changed = {c: F.when(hit, v).otherwise(F.col(f"`{c}`")) for c, v in values.items()}
    return joined.withColumns(changed).select(*[F.col(f"`{c}`") for c in columns])


def raise_first_value(
    events: DataFrame,
    selected: DataFrame,
    key: str,
    ts: str,
    value: str,
    first_where: Column,
    floor: float,
    new_value: float,
    recheck: bool = False,
) -> DataFrame:
    """Raise low or missing values at the first qualifying time of each selected key.

    The earliest time is that of rows passing ``first_where``. All rows of the key
    at this time are raised, whatever their code; ``recheck=True`` raises only
    those that pass ``first_where`` themselves.
    """
    firsts = first_time(events.where(first_where), [key], ts, "_first")
    firsts = firsts.join(selected.select(key).distinct(), key, "left_semi")
    low = F.col(value).isNull() | (F.col(value) < floor)
    at_first = F.col(ts) == F.col("_first")
    if recheck:
        at_first = at_first & first_where
    return update_from(events, firsts, [key], {value: F.when(low, F.lit(new_value)).otherwise(F.col(value))}, at_first)
