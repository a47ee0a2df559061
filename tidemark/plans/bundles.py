"""The sepsis bundles: which steps complete the 3-hour and the 6-hour bundle."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column

from ..operators.status import Composite, all_done
from . import codes

BASIC_STEPS = ("lactate_measured_3h", "blood_culture_3h", "antibiotics_3h")

#: Columns of the final table, in order.
OUTPUT_COLUMNS = (
    "subject_id", "hadm_id", "age_at_admission", "severe_sepsis", "septic_shock",
    "sepsis_time_zero", "lactate_measured_3h", "initial_lactate_value", "blood_culture_3h",
    "antibiotics_3h", "fluids_administered_3h", "repeat_lactate_6h",
    "vasopressors_administered_6h", "persistent_hypotension_6h", "bundle_complete_3h",
    "bundle_complete_6h", "bundle_complete_overall",
)


_NO_REPEAT_NEEDED = f"coalesce(initial_lactate_value <= {codes.LACTATE_REPEAT_ABOVE}, true)"
_HIGH_LACTATE = f"coalesce(initial_lactate_value >= {codes.LACTATE_HIGH}, false)"

#: Severe path: the basic steps. Shock path: fluids as well.
THREE_HOURS = Composite(
    "bundle_complete_3h",
    (
        ("severe_sepsis", all_done(*BASIC_STEPS)),
        ("septic_shock", all_done(*BASIC_STEPS, "fluids_administered_3h")),
    ),
)
#: Severe path: lactate repeated unless it was low or missing. Shock path: vasopressor, with low
#: pressure or high lactate.
SIX_HOURS = Composite(
    "bundle_complete_6h",
    (
        ("severe_sepsis", f"{_NO_REPEAT_NEEDED} OR {all_done('repeat_lactate_6h')}"),
        (
            "septic_shock",
            f"{all_done('vasopressors_administered_6h')} AND ({all_done('persistent_hypotension_6h')} OR {_HIGH_LACTATE})",
        ),
    ),
)
OVERALL = Composite("bundle_complete_overall", ((None, all_done("bundle_complete_3h", "bundle_complete_6h")),))

BASELINE_COMPOSITES = (THREE_HOURS, SIX_HOURS, OVERALL)
#: The final view counts the 6-hour bundle only where the 3-hour bundle is complete.
FINAL_COMPOSITES = (THREE_HOURS, replace(SIX_HOURS, gate="bundle_complete_3h"), OVERALL)


def composite_3h() -> Column:
    return THREE_HOURS.column()


def composite_6h(gate_on: str | None = None) -> Column:
    return replace(SIX_HOURS, gate=gate_on).column()
