"""Baseline measure: cohort, time zero, components, composites."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.cohort import build_cohort, first_times, time_zero, with_stays
from ..operators.components import (
    WindowFlag,
    add_derived,
    attach_components,
    event_relation,
    event_scans,
    family_value_tests,
    from_first_times,
    window_components,
)
from ..operators.scale import materialise
from ..sources.layout import Stored
from ..operators.status import add_composites, mask_components
from .spec import SEPSIS, MeasureSpec

Tables = Mapping[str, DataFrame | Stored]


def cohort(tables: Tables, spec: MeasureSpec = SEPSIS) -> DataFrame:
    """Coded admissions of old enough patients, one row per admission."""
    return build_cohort(
        tables["admissions"],
        tables["patients"],
        tables["diagnoses_icd"],
        spec.cohort_codes,
        spec.path_codes,
        spec.min_age,
    )


def anchored_cohort(tables: Tables, spec: MeasureSpec = SEPSIS) -> DataFrame:
    """Cohort with time zero and the first time of each onset family."""
    onset = event_relation(tables, [spec.family(f) for f in spec.onset])
    return time_zero(
        cohort(tables, spec),
        first_times(onset, spec.onset),
        spec.onset,
        alias=spec.anchor,
        missing=spec.missing,
    )


def needs_only_first_time(c, spec: MeasureSpec) -> bool:
    return (
        isinstance(c, WindowFlag)
        and c.family in spec.onset
        and c.span.lo is None
        and c.value_test() is None
    )


def with_components(tables: Tables, anchored: DataFrame, spec: MeasureSpec = SEPSIS) -> DataFrame:
    """All component columns beside an anchored cohort.

    The anchored cohort is used twice: as windows for the events and as the rows
    of the result. It is written once and read back, so its sources are scanned once. Steps whose family also defines time zero follow from its first time. The
    others come from one pass over the remaining events.
    """
    early = [c for c in spec.components if needs_only_first_time(c, spec)]
    rest = [c for c in spec.components if c not in early]
    anchored = materialise(anchored, "anchored")
    out = anchored.withColumns(from_first_times(early, spec.anchor)) if early else anchored
    if rest:
        names = list(dict.fromkeys(c.family for c in rest))
        scans = event_scans(
            tables, [spec.family(n) for n in names], value_tests=family_value_tests(rest)
        )
        events, dealt = ([rows for rows, d in scans if d is want] for want in (False, True))
        found = window_components(events, anchored, rest, spec.anchor, dealt=dealt)
        out = attach_components(out, found, rest)
    return add_derived(out, spec.derived).drop(*[f"first_{f}" for f in spec.onset])


def admission_flags(tables: Tables, spec: MeasureSpec = SEPSIS) -> DataFrame:
    """One row per cohort admission with masked components, before composites and stays."""
    return mask_components(with_components(tables, anchored_cohort(tables, spec), spec), spec.masks)


def baseline_flags(tables: Tables, spec: MeasureSpec = SEPSIS) -> DataFrame:
    """One row per cohort admission and ICU stay (or per admission) with all flags."""
    flagged = add_composites(admission_flags(tables, spec), spec.composites)
    return with_stays(flagged, tables["icustays"], spec.grain).select(*spec.columns())
