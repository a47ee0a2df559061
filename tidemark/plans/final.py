"""Final view: corrected antibiotic timing and severity, recomputed composites."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame

from ..operators.cohort import KEYS, coded_status, with_stays
from ..operators.components import (
    EventFamily,
    Span,
    WindowFlag,
    event_parts,
    window_components,
)
from ..operators.status import add_composites, mask_components, reconcile_status
from ..operators.scale import skew_join
from ..functions.predicates import or_zero
from . import codes
from .baseline import admission_flags
from .spec import SEPSIS, MeasureSpec


def antibiotic_starts(time_column: str = "startdate") -> EventFamily:
    """Antibiotic prescriptions by either drug name, at their stated start."""
    return EventFamily(
        "antibiotic", "prescriptions", time_column,
        text_columns=("drug", "drug_name_generic"), patterns=codes.TIME_ZERO_DRUGS,
    )


def antibiotic_within_3h(
    base: DataFrame, prescriptions: DataFrame, anchor: str, time_column: str = "startdate"
) -> DataFrame:
    """Per admission: an antibiotic started at or after time zero and less than 3 hours later."""
    step = WindowFlag("antibiotics_3h", "antibiotic", Span(3, lo=0, mode="half_open"))
    events = event_parts({"prescriptions": prescriptions}, [antibiotic_starts(time_column)])
    return window_components(events, base, [step], anchor)


def corrected_base(
    base: DataFrame,
    prescriptions: DataFrame,
    diagnoses: DataFrame,
    spec: MeasureSpec = SEPSIS,
    time_column: str = "startdate",
) -> DataFrame:
    """Base rows with corrected severity and antibiotic flag, masked again."""
    base = base.dropna(subset=list(KEYS)).drop("antibiotics_3h")
    status = coded_status(diagnoses, ["hadm_id"], spec.code_rules, "icd9_code")
    antibiotic = antibiotic_within_3h(base, prescriptions, spec.anchor, time_column)
    flags = skew_join(reconcile_status(base, status, ["hadm_id"]), antibiotic, KEYS, "left")
    return mask_components(
        flags.withColumn("antibiotics_3h", or_zero("antibiotics_3h")), spec.masks
    )


def final_flags(
    base: DataFrame,
    prescriptions: DataFrame,
    diagnoses: DataFrame,
    spec: MeasureSpec = SEPSIS,
    time_column: str = "startdate",
) -> DataFrame:
    """The table reports read. The 6-hour bundle needs the 3-hour bundle here."""
    fixed = corrected_base(base, prescriptions, diagnoses, spec, time_column)
    return add_composites(fixed, spec.final_composites).select(*spec.columns())


def measure(
    tables: Mapping[str, DataFrame], spec: MeasureSpec = SEPSIS, time_column: str = "startdate"
) -> DataFrame:
    """Baseline and correction in one go.

    The corrected antibiotic step is one more component of the baseline's pass over the events;
    severity is corrected per admission, and rows are repeated per stay after everything else.
    """
    starts = replace(antibiotic_starts(time_column), name="antibiotic_start")
    step = WindowFlag("_antibiotic_started", starts.name, Span(3, lo=0, mode="half_open"))
    wider = spec.with_(families=(*spec.families, starts), components=(*spec.components, step))
    flagged = admission_flags(tables, wider).dropna(subset=list(KEYS)).drop("antibiotics_3h")
    flagged = flagged.withColumnRenamed("_antibiotic_started", "antibiotics_3h")
    status = coded_status(tables["diagnoses_icd"], ["hadm_id"], spec.code_rules, "icd9_code")
    fixed = mask_components(reconcile_status(flagged, status, ["hadm_id"]), spec.masks)
    rows = with_stays(add_composites(fixed, spec.final_composites), tables["icustays"], spec.grain)
    return rows.select(*spec.columns())
