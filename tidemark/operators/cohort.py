"""Cohorts, first events, time zero and nearest measurements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import (
    ColumnLike,
    as_column,
    between,
    code_in,
    in_sql,
    normalise_units,
    source_priority,
)
from ..functions.timeops import earliest, ntz, sentinel, whole_hours, years_by_calendar_sql
from .asof import neighbours, one_per_time
from .rows import best_row, top_k
from .scale import materialise, repeat_rows, skew_join

KEYS = ("subject_id", "hadm_id")


def first_event(
    events: DataFrame,
    keys: Sequence[str],
    ts: ColumnLike,
    fallback: ColumnLike | None = None,
    k: int | None = None,
) -> DataFrame:
    """First event time per key; where the time is missing the fallback date counts.

    With ``k`` only the k earliest keys are returned, ordered.
    """
    time = as_column(ts) if fallback is None else F.coalesce(as_column(ts), ntz(fallback))
    out = events.groupBy(*keys).agg(F.min(time).alias("first_time"))
    return out if k is None else top_k(out, k, "first_time", *keys)


def coded_status(
    diagnoses: DataFrame, keys: Sequence[str], rules: Mapping[str, Sequence[str]], code: str
) -> DataFrame:
    """One row per key with a 0/1 column per rule: does any code of the list occur?"""
    return diagnoses.groupBy(*keys).agg(
        *[F.expr(f"max(if({in_sql(code, codes)}, 1, 0)) AS {name}") for name, codes in rules.items()]
    )


def build_cohort(
    admissions: DataFrame,
    patients: DataFrame,
    diagnoses: DataFrame,
    codes: Sequence[str],
    flags: Mapping[str, Sequence[str]],
    min_age: int = 18,
) -> DataFrame:
    """Admissions with one of the codes whose patient is old enough, with code flags.

    Diagnoses are reduced to one row per admission before any join.
    """
    coded = coded_status(diagnoses.where(code_in("icd9_code", codes)), KEYS, flags, "icd9_code")
    people = patients.select("subject_id", "dob").distinct()
    age = years_by_calendar_sql("dob", "admittime")
    # Admissions meet the codes first: most of them have none and go no further.
    admitted = skew_join(admissions.select(*KEYS, "admittime"), coded, KEYS)
    admitted = admitted.groupBy(*KEYS, "admittime").agg(*[F.expr(f"max({f}) AS {f}") for f in flags])
    cohort = skew_join(admitted, people, ["subject_id"])
    return cohort.where(f"{age} >= {min_age}").selectExpr(
        *KEYS, "admittime", "dob", f"{age} AS age_at_admission", *flags
    )


def with_stays(cohort: DataFrame, icustays: DataFrame, grain: str = "icustay") -> DataFrame:
    """Add ``in_icu``; at ``icustay`` grain an admission has one row per distinct stay.

    An admission without a stay keeps its single row.
    """
    if grain not in ("icustay", "admission"):
        raise ValueError(f"unknown grain {grain!r}")
    # Distinct stays first: a stay listed very often is merged inside each task.
    stays = icustays.select(*KEYS, "icustay_id").distinct()
    counted = stays.groupBy(*KEYS).agg(
        F.count("icustay_id").cast("int").alias("_stays"), F.count("*").cast("int").alias("_all")
    )
    known = cohort.join(counted, list(KEYS), "left")
    if grain == "admission":
        return known.withColumn("in_icu", F.expr("if(_stays > 0, 1, 0)")).drop("_stays", "_all")
    # The stays of an admission differ in nothing that is returned, so their number is enough.
    copies = repeat_rows(known, F.expr("coalesce(_all, 1)"), "_copy")
    return copies.withColumn("in_icu", F.expr("if(_copy < _stays, 1, 0)")).drop("_stays", "_all", "_copy")


def first_times(events: DataFrame, families: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """First time of every event family per key, as columns ``first_<family>``.

    ``events`` has the key columns, ``family`` and ``ts``. The shuffle carries
    one row per key and task.
    """
    return events.groupBy(*keys).agg(
        *[F.expr(f"min(ts) FILTER (WHERE family = '{f}') AS first_{f}") for f in families]
    )


def time_zero(
    cohort: DataFrame,
    firsts: DataFrame,
    families: Sequence[str],
    keys: Sequence[str] = KEYS,
    alias: str = "time_zero",
    missing: str = "sentinel",
) -> DataFrame:
    """Cohort with the earliest of the families' first times.

    Without any such event the time is the far-future sentinel, or NULL with
    ``missing="null"``.
    """
    if missing not in ("sentinel", "null"):
        raise ValueError(f"unknown choice {missing!r}")
    zero = earliest(*[f"first_{f}" for f in families])
    if missing == "sentinel":
        zero = F.coalesce(zero, sentinel())
    return cohort.join(firsts, list(keys), "left").withColumn(alias, zero)


def nearest_measurement(
    anchors: DataFrame,
    events: DataFrame,
    on: Sequence[str],
    partition: Sequence[str],
    anchor_ts: str,
    event_ts: str,
    factors: Mapping,
    bounds: tuple[float, float],
    code: str = "itemid",
    value: str = "valuenum",
    alias: str = "weight_kg",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Best plausible measurement for each anchor, found without pairing anchors and measurements.

    The unit source listed first in ``factors`` wins over the others whatever its
    distance; then the distance in whole hours, then the earlier time, then ``tie_break``.
    Values are converted and checked against ``bounds`` first; measurements without a time do
    not count. Anchors may repeat a key; per ``partition`` the best one is kept.

    The last measurement before an anchor tells the distance on that side, and the first one
    after the hour before it is the earliest of that distance; the next one after the anchor
    stands for the other side. So two as-of lookups are enough, however many measurements a key has.
    """
    on, names = list(on), [*tie_break, alias]
    plausible = (
        events.where(code_in(code, list(factors)) & F.col(value).isNotNull() & F.col(event_ts).isNotNull())
        .withColumn(alias, normalise_units(code, value, factors))
        .where(between(alias, *bounds))
        .withColumn("_priority", source_priority(code, list(factors)))
        .select(*on, event_ts, alias, "_priority", *tie_break)
    )
    # Per key only the sources of the first rank it has count.
    first = plausible.groupBy(*on).agg(F.min("_priority").alias("_first"))
    ranked = skew_join(plausible, first, on).where("_priority = _first")
    times = one_per_time(ranked, on, event_ts, ["_priority", *names])
    times = materialise(times, "measurements")

    anchors = anchors.dropna(subset=on)
    beside = neighbours(anchors.select(*on, anchor_ts).distinct(), times, on, anchor_ts)
    hours = lambda side: F.abs(whole_hours(anchor_ts, F.col(f"{side}.ts")))
    beside = beside.where("before IS NOT NULL OR after IS NOT NULL").withColumns({"_back": hours("before"), "_ahead": hours("after")})
    # On equal distances the earlier time wins, which is the one before. The second lookup starts where the
    # hours of that distance begin, or at the anchor itself when the next measurement is the nearest.
    beside = beside.withColumn("_use_after", F.expr("before IS NULL OR coalesce(_ahead < _back, false)"))
    wanted = beside.select(
        *on,
        anchor_ts,
        F.expr(f"if(_use_after, `{anchor_ts}`, timestampadd(HOUR, -(_back + 1), `{anchor_ts}`))").alias("_from"),
        F.expr("if(_use_after, _ahead, _back)").alias("_distance"),
    )
    found = neighbours(wanted, times, on, "_from", [anchor_ts, "_distance"]).select(*on, anchor_ts, "_distance", F.col("after").alias("_found"))

    chosen = skew_join(anchors, found, [*on, anchor_ts], null_safe=True)
    chosen = chosen.withColumns({event_ts: F.col("_found.ts"), "_priority": F.col("_found._priority"), **{n: F.col(f"_found.`{n}`") for n in names}})
    best = best_row(chosen, partition, ["_priority", "_distance", event_ts, *tie_break])
    others = [c for c in anchors.columns if c not in on]
    return best.select(*on, event_ts, F.round(alias, 1).alias(alias), *others)
