"""The whole measure against its row-by-row definition, on random and hand-made rows."""

import datetime as dt

import pytest

from clinic import FAR, T0, Clinic, baseline_rows, final_rows, random_clinic
from tidemark.plans import codes
from tidemark.plans.baseline import baseline_flags
from tidemark.plans.bundles import OUTPUT_COLUMNS
from tidemark.plans.final import final_flags, measure
from tidemark.plans.spec import SEPSIS

H = dt.timedelta(hours=1)
BY_ADMISSION = SEPSIS.with_(grain="admission")


def ordered(rows):
    rows = [tuple(r[c] for c in OUTPUT_COLUMNS) for r in rows]
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def one(tables, spec=BY_ADMISSION):
    (row,) = baseline_flags(tables, spec).collect()
    return row


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_baseline_equals_definition(spark, seed):
    c = random_clinic(seed)
    got = baseline_flags(c.tables(spark)).collect()
    want = baseline_rows(c)
    assert len(want) > 60 and any(r["bundle_complete_overall"] for r in want)
    assert any(r["sepsis_time_zero"] == FAR for r in want)
    assert ordered(got) == ordered(want)


def test_baseline_equals_definition_when_all_keys_are_hot(spark, uneven):
    c = random_clinic(4)
    uneven()
    assert ordered(baseline_flags(c.tables(spark)).collect()) == ordered(baseline_rows(c))


@pytest.mark.parametrize("seed", [5, 6])
def test_final_equals_definition(spark, seed):
    c = random_clinic(seed)
    tables = c.tables(spark)
    got = measure(tables, BY_ADMISSION).collect()
    want = final_rows(c, baseline_rows(c, "admission"))
    assert ordered(got) == ordered(want)


def test_final_on_a_stale_base(spark):
    """Base rows whose severity flags disagree with the codes in every way, and with repeats."""
    c = random_clinic(7)
    tables = c.tables(spark)
    base = baseline_rows(c)
    for i, r in enumerate(base):
        r = base[i] = dict(r)
        r["severe_sepsis"] = [0, 1, None][i % 3]
        r["septic_shock"] = [0, 1, None, 1][i % 4]
    schema = (
        "subject_id bigint, hadm_id bigint, age_at_admission int, severe_sepsis int, septic_shock int,"
        "sepsis_time_zero timestamp_ntz, lactate_measured_3h int, initial_lactate_value double,"
        "blood_culture_3h int, antibiotics_3h int, fluids_administered_3h int, repeat_lactate_6h int,"
        "vasopressors_administered_6h int, persistent_hypotension_6h int, bundle_complete_3h int,"
        "bundle_complete_6h int, bundle_complete_overall int"
    )
    df = spark.createDataFrame([tuple(r[k] for k in OUTPUT_COLUMNS) for r in base], schema)
    got = final_flags(df, tables["prescriptions"], tables["diagnoses_icd"]).collect()
    assert ordered(got) == ordered(final_rows(c, base))


def test_window_edges(spark):
    """Late by a second or not, for the up-to-3 and the 3-to-6 hour windows."""
    cases = {
        # offset from time zero: (up to 3 hours, 3 to 6 hours)
        -5 * H: (1, 0),
        3 * H - dt.timedelta(seconds=1): (1, 0),
        3 * H: (1, 1),
        4 * H - dt.timedelta(seconds=1): (1, 1),
        4 * H: (0, 1),
        7 * H - dt.timedelta(seconds=1): (0, 1),
        7 * H: (0, 0),
    }
    c = Clinic()
    for h, offset in enumerate(cases):
        c.admit(h, [codes.SEVERE_SEPSIS]).culture(h, T0).lab(h, T0 + offset, 3.0)
    got = baseline_flags(c.tables(spark), BY_ADMISSION).orderBy("hadm_id").collect()
    assert [(r.lactate_measured_3h, r.repeat_lactate_6h) for r in got] == list(cases.values())


def test_half_open_window_edges(spark):
    offsets = [-dt.timedelta(seconds=1), 0 * H, 3 * H - dt.timedelta(seconds=1), 3 * H]
    c = Clinic()
    for h, offset in enumerate(offsets):
        c.admit(h, [codes.SEVERE_SEPSIS]).culture(h, T0).drug(h, T0 + offset, "x", "Vancomycin")
    got = measure(c.tables(spark), BY_ADMISSION).orderBy("hadm_id").collect()
    assert [r.antibiotics_3h for r in got] == [0, 1, 1, 0]


def test_no_qualifying_event(spark):
    tables = Clinic().admit(1, [codes.SEVERE_SEPSIS]).lab(1, T0, 1.0).tables(spark)
    row = one(tables)
    assert row.sepsis_time_zero == FAR and row.lactate_measured_3h == 1 and row.initial_lactate_value == 1.0
    strict = one(tables, BY_ADMISSION.with_(missing="null"))
    assert strict.sepsis_time_zero is None and strict.lactate_measured_3h == 0


def test_both_codes_take_different_paths(spark):
    both = [codes.SEVERE_SEPSIS, codes.SEPTIC_SHOCK]
    c = Clinic().admit(1, both).culture(1, T0).lab(1, T0, 1.0).drug(1, T0 - 12 * H, "cefepime")
    c.drug(1, T0 + H, "cefepime")
    tables = c.tables(spark)
    base = one(tables)
    assert (base.severe_sepsis, base.septic_shock, base.bundle_complete_3h) == (1, 1, 1)
    (fixed,) = measure(tables, BY_ADMISSION).collect()
    assert (fixed.severe_sepsis, fixed.septic_shock) == (0, 1)
    assert fixed.bundle_complete_3h == 0 and fixed.repeat_lactate_6h is None


def test_age_counts_calendar_years(spark):
    c = Clinic()
    for h, year in enumerate([2006, 2007]):
        c.admit(h, [codes.SEPSIS], born=dt.date(year, 12, 31), time=dt.datetime(2024, 1, 1))
    rows = baseline_flags(c.tables(spark)).collect()
    assert [(r.hadm_id, r.age_at_admission) for r in rows] == [(0, 18)]


def test_stays_repeat_rows_only_at_stay_grain(spark):
    tables = Clinic().admit(1, [codes.SEPSIS], stays=[5, 6, 6]).admit(2, [codes.SEPSIS]).tables(spark)
    assert sorted(r.hadm_id for r in baseline_flags(tables).collect()) == [1, 1, 2]
    assert sorted(r.hadm_id for r in baseline_flags(tables, BY_ADMISSION).collect()) == [1, 2]


@pytest.mark.parametrize("copies", ["patients", "admissions", "diagnoses_icd", "icustays", "labevents"])
def test_repeated_input_rows_change_nothing(spark, copies):
    tables = random_clinic(8, 40).tables(spark)
    want = ordered(baseline_flags(tables).collect())
    tables[copies] = tables[copies].unionByName(tables[copies]).unionByName(tables[copies])
    assert ordered(baseline_flags(tables).collect()) == want


def test_planted_outcomes(spark):
    """Admissions built to pass or to fail, with the outcome known beforehand."""
    minutes = lambda m: T0 + dt.timedelta(minutes=m)
    c = Clinic()
    want = {}
    for h in range(24):
        shock, passes3, passes6 = h % 2 == 0, h % 3 != 0, h % 4 < 2
        c.admit(h, [codes.SEPTIC_SHOCK] if shock else [codes.SEVERE_SEPSIS])
        c.culture(h, minutes(8 + h % 8))
        c.drug(h, minutes(110 + h) if passes3 else minutes(300 + h))
        c.lab(h, minutes(60 + h), 4.6 if shock or not passes6 else 1.8)
        if shock:
            c.chart(h, minutes(70 + h), codes.FLUIDS[h % 3], 1000.0)
            if passes6:
                c.chart(h, minutes(150 + h), codes.VASOPRESSORS[h % 5], 0.1)
        want[h] = (int(passes3), int(passes3 and passes6))
    got = measure(c.tables(spark), BY_ADMISSION).collect()
    assert {r.hadm_id: (r.bundle_complete_3h, r.bundle_complete_6h) for r in got} == want


def test_relations_between_the_flags(spark):
    tables = random_clinic(9, 200).tables(spark)
    for r in measure(tables, BY_ADMISSION).collect():
        assert r.bundle_complete_overall <= min(r.bundle_complete_3h, r.bundle_complete_6h)
        assert r.bundle_complete_6h <= r.bundle_complete_3h
        assert (r.fluids_administered_3h is None) == (r.septic_shock == 0)
        assert (r.vasopressors_administered_6h is None) == (r.septic_shock == 0)
        assert (r.repeat_lactate_6h is None) == (r.severe_sepsis == 0)


def test_partitioning_does_not_change_results(spark, settings):
    c = random_clinic(10, 60)
    want = ordered(baseline_flags(c.tables(spark)).collect())
    tables = {n: d.repartition(7) for n, d in c.tables(spark).items()}
    settings(spark__sql__shuffle__partitions=13)
    assert ordered(baseline_flags(tables).collect()) == want
