"""The ready-made searches on small dictionaries."""

import datetime as dt

import pytest

from conftest import as_set
from tidemark.plans import explore
from tidemark.plans.groups import Group, choose_groups, mark_groups
from tidemark.operators import strata

T0 = dt.datetime(2024, 1, 10, 8)
H = dt.timedelta(hours=1)


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    return {
        "d_icd_diagnoses": make(
            [("99591", "Sepsis", "Sepsis"), ("0389", "Septicemia NOS", "Unspecified septicemia"),
             ("4019", "Hypertension", "Essential hypertension")],
            "icd9_code string, short_title string, long_title string",
        ),
        "diagnoses_icd": make(
            [(1, 10, "99591"), (1, 10, "0389"), (2, 20, "4019"), (3, 30, "0389")],
            "subject_id bigint, hadm_id bigint, icd9_code string",
        ),
        "admissions": make(
            [(1, 10, T0 + H, "EMERGENCY"), (2, 20, T0, "ELECTIVE"), (3, 30, T0, "URGENT")],
            "subject_id bigint, hadm_id bigint, admittime timestamp_ntz, admission_type string",
        ),
        "d_labitems": make(
            [(50813, "Lactate", "Blood", "Gas", "x"), (50813, "Lactate", "Blood", "Gas", "x"),
             (50954, "Lactate Dehydrogenase (LD)", "Blood", "Chem", "y"), (1, "Glucose", "Blood", "Chem", "z")],
            "itemid int, label string, fluid string, category string, loinc_code string",
        ),
        "labevents": make(
            [(10, T0 + i * H, 50813, 1.0 + i, "mmol/L") for i in range(5)] + [(10, T0, 1, 5.0, "mg/dL")],
            "hadm_id bigint, charttime timestamp_ntz, itemid int, valuenum double, valueuom string",
        ),
        "microbiologyevents": make(
            [(1, 10, 70012, "BLOOD CULTURE", None, T0.date()), (1, 10, 70012, "BLOOD CULTURE", T0, T0.date()),
             (2, 20, 70013, "Urine", T0, T0.date()), (3, 30, 70012, "BLOOD CULTURE", T0, T0.date())],
            "subject_id bigint, hadm_id bigint, spec_itemid int, spec_type_desc string,"
            "charttime timestamp_ntz, chartdate date",
        ),
        "d_items": make(
            [(226512, "Admission Weight (Kg)"), (226531, "Admission Weight (lbs.)"), (52, "Arterial BP Mean"),
             (456, "NBP Mean"), (6702, "Arterial BP Mean #2"), (220052, "Arterial Blood Pressure mean"),
             (443, "Manual BP Mean(calc)"), (1, "Mean BP"), (2, "MAP"), (30061, "Lactated Ringers"),
             (30062, "PLASMA-LYTE A"), (221906, "Norepinephrine"), (221662, "Dopamine")],
            "itemid int, label string",
        ),
        "chartevents": make(
            [(7, T0, 226531, 150.0), (7, T0 + 9 * H, 226512, 70.0), (8, T0, 226531, 200.0), (8, T0, 226512, 10.0)],
            "icustay_id bigint, charttime timestamp_ntz, itemid int, valuenum double",
        ),
        "icustays": make(
            [(1, 10, 7, T0), (2, 20, 8, T0), (3, 30, 9, T0)],
            "subject_id bigint, hadm_id bigint, icustay_id bigint, intime timestamp_ntz",
        ),
        "prescriptions": make(
            [("Zosyn 4.5g", None, "piperacillin-tazobactam"), ("zosyn 4.5G", "Vancomycin", None), ("aspirin",) * 3],
            "drug string, drug_name_poe string, drug_name_generic string",
        ),
    }


def test_sepsis_admissions_have_a_row_per_code(tables):
    got = explore.sepsis_admissions(tables).select("hadm_id", "icd9_code", "admission_type").collect()
    assert [tuple(r) for r in got][0] == (30, "0389", "URGENT")
    assert sorted(r[:2] for r in map(tuple, got)) == [(10, "0389"), (10, "99591"), (30, "0389")]


def test_lactate(tables):
    assert [r.itemid for r in explore.lactate_items(tables).collect()] == [50813]
    assert as_set(explore.lactate_counts(tables)) == {(50813, "Lactate", 10)}
    assert [r.valuenum for r in explore.lactate_sample(tables, 2).collect()] == [1.0, 2.0]


def test_cultures(tables):
    assert as_set(explore.blood_specimens(tables)) == {(70012, "BLOOD CULTURE")}
    midnight = dt.datetime(2024, 1, 10)
    assert [tuple(r) for r in explore.first_cultures(tables).collect()] == [(1, 10, midnight), (3, 30, T0)]


def test_weights(tables):
    assert [r.itemid for r in explore.weight_items(tables).collect()] == [226512, 226531]
    got = explore.nearest_weights(tables).select("icustay_id", "charttime", "weight_kg")
    assert as_set(got) == {(7, T0 + 9 * H, 70.0), (8, T0, 90.7)}


def test_item_searches(tables):
    items = lambda df: {r.itemid for r in df.collect()}
    assert items(explore.pressure_items(tables)) == {1, 2}
    assert items(explore.crystalloid_items(tables)) == {30061, 30062}
    assert items(explore.vasopressor_items(tables)) == {221906, 221662}


def test_antibiotic_spellings(tables):
    names = {"zosyn 4.5g", "piperacillin-tazobactam", "vancomycin"}
    assert as_set(explore.antibiotic_names(tables)) == {(n, 1) for n in names}
    assert dict(explore.antibiotic_names(tables, dedup=False).collect())["zosyn 4.5g"] == 2


@pytest.mark.parametrize("hot", [False, True])
def test_groups(spark, uneven, hot):
    if hot:
        uneven()
    cohort = spark.range(600).selectExpr("id", "if(id % 3 < 2, 'big', concat('s', id % 7)) AS stratum")
    specs = [strata.RateSpec("few", 20, 1, 1), strata.RateSpec("many", 50, 1, 1)]
    rates = strata.stratum_rates(cohort, "stratum", specs)
    groups = {"a": Group("few", 5), "b": Group("many", 5), "c": Group("many", 9, within="b")}
    marked = mark_groups(cohort, "id", choose_groups(cohort, "stratum", "id", rates, groups)).collect()
    assert len(marked) == 600
    assert all(r.a <= r.b and r.c <= r.b for r in marked)
    for s in {r.stratum for r in marked}:
        rows = [r for r in marked if r.stratum == s]
        n, b = len(rows), sum(r.b for r in rows)
        assert sum(r.a for r in rows) == int(0.2 * n) and b == n // 2 and sum(r.c for r in rows) == b // 2
