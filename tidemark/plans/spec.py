"""A measure as data, and the sepsis measure as one instance of it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from ..operators.cohort import KEYS
from ..operators.components import Component, Derived, EventFamily, Span, WindowFlag, WindowValue
from ..operators.status import Composite
from . import bundles, codes


@dataclass(frozen=True)
class MeasureSpec:
    """Everything that distinguishes one time-anchored measure from another."""

    cohort_codes: tuple[str, ...]
    path_codes: Mapping[str, tuple[str, ...]]
    families: tuple[EventFamily, ...]
    onset: tuple[str, ...]
    components: tuple[Component, ...]
    masks: Mapping[str, str]
    min_age: int = 18
    anchor: str = "time_zero"
    grain: str = "icustay"
    missing: str = "sentinel"
    code_rules: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    derived: tuple[Derived, ...] = ()
    composites: tuple[Composite, ...] = ()
    final_composites: tuple[Composite, ...] = ()
    #: Columns of the result, in order; without any the keys, paths, anchor, flags and composites.
    output: tuple[str, ...] = ()

    def columns(self) -> list[str]:
        """Columns of the result."""
        named = [x.name for x in (*self.components, *self.derived, *self.composites)]
        return list(self.output) or [*KEYS, "age_at_admission", *self.path_codes, self.anchor, *named]

    def family(self, name: str) -> EventFamily:
        return next(f for f in self.families if f.name == name)

    def tables(self) -> list[str]:
        """Input tables of the measure."""
        fixed = ["admissions", "patients", "diagnoses_icd", "icustays"]
        return list(dict.fromkeys([*fixed, *(f.table for f in self.families)]))

    def with_(self, **changes) -> "MeasureSpec":
        return replace(self, **changes)


SEPSIS = MeasureSpec(
    cohort_codes=(codes.SEPSIS, codes.SEVERE_SEPSIS, codes.SEPTIC_SHOCK),
    path_codes={
        "severe_sepsis": (codes.SEVERE_SEPSIS,),
        "septic_shock": (codes.SEPTIC_SHOCK,),
    },
    families=(
        EventFamily(
            "culture", "microbiologyevents", "charttime",
            code_column="spec_itemid", codes=(codes.BLOOD_CULTURE,),
        ),
        EventFamily(
            "antibiotic", "prescriptions", "startdate",
            text_columns=("drug",), patterns=codes.TIME_ZERO_DRUGS, noon_hours=12,
        ),
        EventFamily(
            "lactate", "labevents", "charttime",
            code_column="itemid", codes=(codes.LACTATE,), value_column="valuenum",
        ),
        EventFamily(
            "fluid", "chartevents", "charttime",
            code_column="itemid", codes=codes.FLUIDS, value_column="valuenum",
        ),
        EventFamily(
            "vasopressor", "chartevents", "charttime",
            code_column="itemid", codes=codes.VASOPRESSORS, value_column="valuenum",
        ),
        EventFamily(
            "pressure", "chartevents", "charttime",
            code_column="itemid", codes=codes.MEAN_ARTERIAL_PRESSURE, value_column="valuenum",
        ),
    ),
    onset=("culture", "antibiotic"),
    components=(
        WindowFlag("lactate_measured_3h", "lactate", Span(3)),
        WindowValue("initial_lactate_value", "lactate", Span(3)),
        WindowFlag("blood_culture_3h", "culture", Span(3)),
        WindowFlag("antibiotics_3h", "antibiotic", Span(3)),
        WindowFlag("fluids_administered_3h", "fluid", Span(3)),
        WindowFlag("repeat_lactate_6h", "lactate", Span(6, lo=3)),
        WindowFlag("vasopressors_administered_6h", "vasopressor", Span(6)),
        WindowFlag(
            "persistent_hypotension_6h", "pressure", Span(6, lo=3), value_below=codes.LOW_PRESSURE
        ),
    ),
    masks={
        "fluids_administered_3h": "septic_shock",
        "repeat_lactate_6h": "severe_sepsis",
        "vasopressors_administered_6h": "septic_shock",
        "persistent_hypotension_6h": "septic_shock",
    },
    anchor="sepsis_time_zero",
    code_rules={
        "shock_icd": (codes.SEPTIC_SHOCK,),
        "sepsis_icd": (codes.SEVERE_SEPSIS, codes.SEPTIC_SHOCK),
    },
    composites=bundles.BASELINE_COMPOSITES,
    final_composites=bundles.FINAL_COMPOSITES,
    output=bundles.OUTPUT_COLUMNS,
)
