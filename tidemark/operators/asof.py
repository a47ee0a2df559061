"""As-of lookups: the last event before a time and the first one after it, without pairs.

Probes and events go into one table, cut into time slots per key. Inside a slot a running window
carries the last event forward and the next one backward; across slots the same is done on one row
per slot. So the rows formed grow with probes plus events, and a key with most of the rows is
spread over its slots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeops import HOUR_US, ntz_literal, slot_start
from .scale import skew_join

#: Earliest time a probe can have; a probe without a time counts as being before everything.
_START = "0001-01-01 00:00:00"


def one_per_time(events: DataFrame, on: Sequence[str], ts: str, carry: Sequence[str]) -> DataFrame:
    """``on``, ``ts`` and ``found`` (struct of ts and ``carry``): of events at one time the one with the smallest values."""
    row = F.struct(F.col(ts).alias("ts"), *[F.col(f"`{c}`") for c in carry])
    return events.where(F.col(ts).isNotNull()).groupBy(*on, F.col(ts).alias("ts")).agg(F.min(row).alias("found"))


def _running(value: str | Column, window) -> Column:
    return F.last(value, ignorenulls=True).over(window)


def neighbours(
    probes: DataFrame, events: DataFrame, on: Sequence[str], probe_ts: str, carry: Sequence[str] = (), slot_us: int = HOUR_US
) -> DataFrame:
    """Rows (on, probe_ts, carry) with ``before`` (last event at or before) and ``after`` (first event later).

    ``events`` comes from ``one_per_time``. Either is NULL where there is no such event. Keys
    that are NULL have no neighbours.
    """
    on, own = list(on), [probe_ts, *carry]
    start, kinds = ntz_literal(_START), probes.schema
    asked = probes.dropna(subset=on).select(
        *on, F.coalesce(probe_ts, start).alias("ts"), F.lit(None).cast(events.schema["found"].dataType).alias("found"), F.lit(1).alias("_kind"), F.struct(*own).alias("_own")
    )
    none = F.lit(None).cast(T.StructType([T.StructField(c, kinds[c].dataType) for c in own]))
    given = events.select(*on, "ts", "found", F.lit(0).alias("_kind"), none.alias("_own"))
    # Dealt by key and slot once; the windows and the count of slots below use the same shuffle.
    rows = asked.unionByName(given).withColumn("_slot", slot_start("ts", slot_us)).repartition(*on, "_slot")

    slots = rows.groupBy(*on, "_slot").agg(F.min("found").alias("_first"), F.max("found").alias("_last"))
    of_key = Window.partitionBy(*on)
    earlier = of_key.orderBy(F.asc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    later = of_key.orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select(*on, "_slot", _running("_last", earlier).alias("_carried"), _running("_first", later).alias("_coming"))

    inside = Window.partitionBy(*on, "_slot")
    # Events of the probe's own time come before it: they count as "at or before". Probes of one time stand side by side.
    forward = inside.orderBy(F.asc("ts"), F.asc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    backward = inside.orderBy(F.desc("ts"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.withColumns({"before": _running("found", forward), "after": _running("found", backward)}).where("_kind = 1")
    joined = skew_join(seen, carried, [*on, "_slot"], "left")
    return joined.select(*on, "_own.*", F.coalesce("before", "_carried").alias("before"), F.coalesce("after", "_coming").alias("after"))
