"""Looking for the measure's codes in clinical tables, before running the measure.

Thin compositions of the discovery operators with the sepsis measure's patterns.
``tables`` maps table names to DataFrames, as ``load_tables`` returns them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators import discovery
from ..operators.cohort import KEYS, first_event, nearest_measurement
from ..operators.rows import sort_output
from . import codes

Tables = Mapping[str, DataFrame]


def sepsis_admissions(tables: Tables) -> DataFrame:
    """Admissions with a sepsis-like diagnosis title, one row per matching code, by admission time."""
    titles = tables["d_icd_diagnoses"].select("icd9_code", "short_title", "long_title")
    found = discovery.admissions_by_description(
        tables["admissions"], tables["diagnoses_icd"], titles,
        "long_title", codes.SEPSIS_TITLES, "icd9_code", KEYS,
    )
    return sort_output(found, "admittime")


def _items(dictionary: DataFrame, label: str, include, exclude=(), distinct=True, columns=None) -> DataFrame:
    found = discovery.find_concepts(dictionary, label, include, exclude, columns, distinct)
    return sort_output(found, label)


def lactate_items(tables: Tables) -> DataFrame:
    wanted = ["itemid", "label", "fluid", "category", "loinc_code"]
    return _items(
        tables["d_labitems"], "label", codes.LACTATE_LABELS, codes.LACTATE_LABELS_EXCLUDED, columns=wanted
    )


def lactate_counts(tables: Tables) -> DataFrame:
    """Lab rows per lactate item, most frequent first."""
    counts = discovery.concept_counts(
        tables["labevents"], tables["d_labitems"], "itemid", "label",
        codes.LACTATE_LABELS, codes.LACTATE_LABELS_EXCLUDED,
    )
    return sort_output(counts, "n", descending=True)


def lactate_sample(tables: Tables, k: int = 200) -> DataFrame:
    """The first k lactate rows, to see values and units."""
    columns = ["hadm_id", "charttime", "itemid", "valuenum", "valueuom"]
    return discovery.sample_events(
        tables["labevents"], "itemid", codes.LACTATE, k, ["charttime", "hadm_id", "valuenum"], columns
    )


def blood_specimens(tables: Tables) -> DataFrame:
    return _items(
        tables["microbiologyevents"], "spec_type_desc", codes.BLOOD_SPECIMENS,
        columns=["spec_itemid", "spec_type_desc"],
    )


def first_cultures(tables: Tables, k: int | None = 100) -> DataFrame:
    """First blood culture per admission, the k earliest; the date counts where the time is missing."""
    cultures = tables["microbiologyevents"].where(f"spec_itemid = {codes.BLOOD_CULTURE}")
    return first_event(cultures, KEYS, "charttime", "chartdate", k)


def weight_items(tables: Tables) -> DataFrame:
    return _items(
        tables["d_items"], "label", codes.WEIGHT_LABELS, distinct=False, columns=["itemid", "label"]
    )


def nearest_weights(tables: Tables) -> DataFrame:
    """Plausible weight in kg next to each ICU admission; kg readings before lb readings."""
    weights = tables["chartevents"].select("icustay_id", "charttime", "itemid", "valuenum")
    best = nearest_measurement(
        tables["icustays"].select(*KEYS, "icustay_id", "intime"), weights,
        on=["icustay_id"], partition=["icustay_id"], anchor_ts="intime", event_ts="charttime",
        factors={codes.WEIGHT_KG: 1, codes.WEIGHT_LB: codes.KG_PER_LB}, bounds=codes.WEIGHT_RANGE_KG,
    )
    return sort_output(best.select(*KEYS, "icustay_id", "intime", "charttime", "weight_kg"), "intime")


def pressure_items(tables: Tables) -> DataFrame:
    return _items(tables["d_items"], "label", codes.PRESSURE_LABELS, columns=["itemid", "label"])


def crystalloid_items(tables: Tables) -> DataFrame:
    return _items(tables["d_items"], "label", codes.CRYSTALLOID_LABELS, columns=["itemid", "label"])


def vasopressor_items(tables: Tables) -> DataFrame:
    return _items(tables["d_items"], "label", codes.VASOPRESSOR_LABELS, columns=["itemid", "label"])


def antibiotic_names(tables: Tables, dedup: bool = True) -> DataFrame:
    """Spellings of broad-spectrum antibiotics in the three drug name columns."""
    names = discovery.alias_inventory(
        tables["prescriptions"], ["drug", "drug_name_poe", "drug_name_generic"], codes.ANTIBIOTIC_NAMES, dedup
    )
    return sort_output(names, "cnt", descending=True)
