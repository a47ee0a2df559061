"""Clinical tables derived from the generic ``events`` and ``customer`` tables.

One encounter is one user's calendar week of the month. Each clinical table is a
projection of one event type, so its filter reaches the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import load_tables

KEYS = ("subject_id", "hadm_id")


class LazyTables(dict):
    """Tables by name, each planned when it is first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self._makers = makers

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._makers[name]()
        return self[name]


def _one_of(values: str, n: int) -> str:
    """The value whose place is the event's remainder."""
    return f"element_at(array({values}), int(event_id % {n}) + 1)"


#: Per table: its event type and its columns besides the keys. Codes and spellings rotate over all that the
#: measure knows and over others it must pass by; some values and times are missing.
PROJECTIONS = {
    "diagnoses_icd": ("signup", _one_of("'99591', '99592', '78552', '4019', '0389', '99592', '78552'", 7) + " AS icd9_code"),
    "icustays": ("signup", "event_id AS icustay_id", "ts AS intime"),
    "microbiologyevents": (
        "error",
        _one_of("70012, 70079, 70012, 70013, 70012", 5) + " AS spec_itemid",
        _one_of("'BLOOD CULTURE', 'URINE', 'BLOOD CULTURE', 'Fluid (blood)', 'Blood culture'", 5) + " AS spec_type_desc",
        "if(event_id % 11 = 3, NULL, ts) AS charttime",
        "date(ts) AS chartdate",
    ),
    "prescriptions": (
        "purchase",
        _one_of("'CefePIME', 'Aspirin', 'Vancomycin 1 g', NULL, 'PIPERACILLIN-Tazobactam', 'Heparin', 'Zosyn', 'cefepime', 'Linezolid', NULL", 10)
        + " AS drug",
        _one_of("NULL, 'Meropenem', NULL, 'cefazolin', NULL, NULL, 'UNASYN', 'insulin', NULL, NULL, 'Aztreonam'", 11) + " AS drug_name_poe",
        _one_of("'Cefepime', NULL, 'vancomycin HCl', 'heparin', NULL, 'PiperaciLLin', 'Vancomycin', 'aspirin', 'ceftriaxone'", 9)
        + " AS drug_name_generic",
        "date(ts) AS startdate",
        "ts AS startts",
    ),
    "labevents": (
        "view",
        "ts AS charttime",
        _one_of("50813, 50954, 50813, 51222, 50813, 50885, 50813", 7) + " AS itemid",
        "if(event_id % 13 = 5, NULL, value / 25) AS valuenum",
        "'mmol/L' AS valueuom",
        "event_id",
    ),
    "chartevents": (
        "click",
        "ts AS charttime",
        _one_of(
            "30061, 221906, 52, 30062, 221289, 456, 30063, 221749, 6702, 30064, 222315, 443, 30061, 221662, 220052, "
            "30062, 220045, 220181, 30063, 221906, 225312, 221653, 51, 220050",
            24,
        )
        + " AS itemid",
        "if(event_id % 17 = 6, NULL, value) AS valuenum",
        "event_id",
    ),
    "weights": (
        "click",
        "ts AS charttime",
        "CASE event_id % 2 WHEN 0 THEN 226512 ELSE 226531 END AS itemid",
        "value AS valuenum",
        "event_id",
    ),
}

#: Dictionary labels, dealt out over the parts; near misses among them.
ITEM_LABELS = (
    "Admission Weight (Kg)", "Daily Weight", "Height", "WEIGHT change", "Weighted score", "Mean BP", "Arterial Mean Blood BP", "ART BP Mean",
    "Non Invasive Blood Pressure mean", "MAP (mmHg)", "Bitmap", "Normal Saline 500 ml", "NaCl 0.9%", "Na Cl 0.9%", "Sodium Chloride 0.9%  (Flush)",
    "Sodium Chloride 0.45%", "Lactated Ringers", "Ringer's Lactate", "Ringers solution", "Plasma-Lyte A", "Plasma", "0.9% saline",
    "Norepinephrine", "LEVOPHED drip", "Epinephrine", "Vasopressin", "Dopamine", "Dobutamine", "Phenylephrine 10 mg", "Ephedrine",
)


def encounter_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id", "ts", "event_type", "value", "user_id AS subject_id",
        "user_id * 10 + (day(ts) - 1) div 7 AS hadm_id",
    )


def clinical_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    raw = LazyTables(
        {
            "events": lambda: encounter_events(load_tables(spark, sf_dir, ["events"])["events"]),
            "customer": lambda: load_tables(spark, sf_dir, ["customer"])["customer"],
        }
    )

    def projected(name: str) -> DataFrame:
        event_type, *columns = PROJECTIONS[name]
        chosen = raw["events"].where(f"event_type = '{event_type}'")
        if name == "icustays":
            chosen = chosen.where("event_id % 4 = 0")
        return chosen.selectExpr(*KEYS, *columns)

    makers = {n: lambda n=n: projected(n) for n in PROJECTIONS}
    def coded(codes: dict, code: str, columns: dict[str, int]) -> list[str]:
        """Columns of a dictionary, one CASE each."""
        cases = lambda i: " ".join(f"WHEN {k} THEN '{v[i]}'" for k, v in codes.items())
        return [f"CASE {code} {cases(i)} END AS {name}" for name, i in columns.items()]

    makers["d_labitems"] = lambda: projected("labevents").select("itemid").distinct().selectExpr(
        "itemid",
        *coded(
            {50813: ("Lactate", "Blood Gas"), 50954: ("Lactate Dehydrogenase (LD)", "Chemistry"), 51222: ("Hemoglobin", "Hematology"), 50885: ("LACTATE, venous", "Chemistry")},
            "itemid", {"label": 0, "category": 1},
        ),
        "'Blood' AS fluid",
        "concat('L-', itemid) AS loinc_code",
    )
    makers["d_icd_diagnoses"] = lambda: projected("diagnoses_icd").select("icd9_code").distinct().selectExpr(
        "icd9_code",
        *coded(
            {"'99591'": ("Sepsis", "Sepsis"), "'99592'": ("Severe sepsis", "SEVERE SEPSIS"), "'78552'": ("Septic shock", "Septic shock"), "'4019'": ("Hypertension NOS", "Unspecified essential hypertension"), "'0389'": ("Septicemia NOS", "Unspecified septicemia")},
            "icd9_code", {"short_title": 0, "long_title": 1},
        ),
    )
    labels = ", ".join("'" + label.replace("'", "\\'") + "'" for label in ITEM_LABELS)
    makers["d_items"] = lambda: load_tables(spark, sf_dir, ["part"])["part"].selectExpr(
        "int(p_partkey) AS itemid", f"element_at(array({labels}), int(p_partkey % {len(ITEM_LABELS)}) + 1) AS label"
    )
    makers["patients"] = lambda: raw["customer"].selectExpr(
        "c_custkey AS subject_id",
        "date_add(DATE '1950-01-01', int(c_custkey * 7919 % 24000)) AS dob",
    )
    makers["admissions"] = lambda: (
        raw["events"].groupBy(*KEYS).agg({"ts": "min"}).toDF(*KEYS, "admittime")
    )
    return LazyTables(makers)
