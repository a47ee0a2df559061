"""Small clinical tables for tests, and the measure worked out row by row in Python."""

from __future__ import annotations

import datetime as dt
import random

from tidemark.plans import codes

FAR = dt.datetime(9999, 12, 31)
T0 = dt.datetime(2024, 1, 10, 8)

SCHEMAS = {
    "patients": "subject_id bigint, dob date",
    "admissions": "subject_id bigint, hadm_id bigint, admittime timestamp_ntz",
    "diagnoses_icd": "subject_id bigint, hadm_id bigint, icd9_code string",
    "icustays": "subject_id bigint, hadm_id bigint, icustay_id bigint, intime timestamp_ntz",
    "microbiologyevents": "subject_id bigint, hadm_id bigint, spec_itemid int, charttime timestamp_ntz, chartdate date",
    "prescriptions": "subject_id bigint, hadm_id bigint, drug string, drug_name_generic string, startdate timestamp_ntz",
    "labevents": "subject_id bigint, hadm_id bigint, charttime timestamp_ntz, itemid int, valuenum double",
    "chartevents": "subject_id bigint, hadm_id bigint, charttime timestamp_ntz, itemid int, valuenum double",
}


class Clinic:
    """Collects rows per table and hands them over as DataFrames."""

    def __init__(self):
        self.rows = {name: [] for name in SCHEMAS}

    def admit(self, hadm, diagnoses, born=dt.date(1960, 5, 5), time=T0, stays=()):
        self.rows["patients"].append((hadm, born))
        self.rows["admissions"].append((hadm, hadm, time))
        self.rows["diagnoses_icd"] += [(hadm, hadm, c) for c in diagnoses]
        self.rows["icustays"] += [(hadm, hadm, s, time) for s in stays]
        return self

    def culture(self, hadm, time, item=codes.BLOOD_CULTURE):
        self.rows["microbiologyevents"].append((hadm, hadm, item, time, (time or T0).date()))
        return self

    def drug(self, hadm, time, name="cefepime 2 g iv", generic=None):
        self.rows["prescriptions"].append((hadm, hadm, name, generic, time))
        return self

    def lab(self, hadm, time, value, item=codes.LACTATE):
        self.rows["labevents"].append((hadm, hadm, time, item, value))
        return self

    def chart(self, hadm, time, item, value=None):
        self.rows["chartevents"].append((hadm, hadm, time, item, value))
        return self

    def tables(self, spark):
        return {n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in self.rows.items()}


def random_clinic(seed: int, admissions: int = 120) -> Clinic:
    """Events close to the window edges, many ties, some admissions with nothing at all."""
    rnd = random.Random(seed)
    c = Clinic()
    edge = [dt.timedelta(hours=h, microseconds=d) for h in range(-2, 9) for d in (-1, 0, 1)]
    moment = lambda: T0 + rnd.choice(edge) + dt.timedelta(hours=rnd.randint(0, 3))
    all_codes = [codes.SEPSIS, codes.SEVERE_SEPSIS, codes.SEPTIC_SHOCK, "4019"]
    items = [*codes.FLUIDS, *codes.VASOPRESSORS, *codes.MEAN_ARTERIAL_PRESSURE, 99]
    for h in range(admissions):
        c.admit(
            h,
            rnd.sample(all_codes, rnd.randint(0, 3)),
            dt.date(rnd.choice([1950, 2005, 2006, 2007]), rnd.choice([1, 12]), rnd.choice([1, 28])),
            stays=range(h * 10, h * 10 + rnd.choice([0, 0, 1, 1, 2, 3])),
        )
        for _ in range(rnd.choice([0, 1, 1, 2])):
            c.culture(h, rnd.choice([moment(), moment(), None]), rnd.choice([70012, 70012, 70012, 1]))
        for _ in range(rnd.choice([0, 1, 2])):
            names = ["Cefepime", "vancomycin iv", "aspirin", None]
            early = dt.timedelta(hours=rnd.choice([0, 12]))
            c.drug(h, moment() - early, rnd.choice(names), rnd.choice(names))
        for _ in range(rnd.choice([0, 1, 2, 3])):
            c.lab(h, moment(), rnd.choice([None, 1.9, 2.0, 2.1, 3.9, 4.0, 4.1]), rnd.choice([50813, 50813, 5]))
        for _ in range(rnd.choice([0, 2, 5])):
            c.chart(h, moment(), rnd.choice(items), rnd.choice([None, 64.9, 65.0, 65.1]))
    return c


def hours(later, earlier):
    us = (later - earlier) // dt.timedelta(microseconds=1)
    whole = abs(us) // 3_600_000_000
    return whole if us >= 0 else -whole


def is_antibiotic(*names):
    return any(n and any(p in n.lower() for p in codes.TIME_ZERO_DRUGS) for n in names)


def bundles(r, gated):
    """The two bundle flags of one row."""
    basic = r["lactate_measured_3h"] and r["blood_culture_3h"] and r["antibiotics_3h"]
    lac = r["initial_lactate_value"]
    if r["severe_sepsis"]:
        three = basic
        six = lac is None or lac <= 2 or r["repeat_lactate_6h"]
    elif r["septic_shock"]:
        three = basic and r["fluids_administered_3h"]
        six = r["vasopressors_administered_6h"] and (
            r["persistent_hypotension_6h"] or (lac is not None and lac >= 4)
        )
    else:
        three = six = 0
    three, six = int(bool(three)), int(bool(six))
    return three, six * three if gated else six


def masked(r):
    for step, path in (
        ("fluids_administered_3h", "septic_shock"), ("repeat_lactate_6h", "severe_sepsis"),
        ("vasopressors_administered_6h", "septic_shock"), ("persistent_hypotension_6h", "septic_shock"),
    ):
        if not r[path]:
            r[step] = None
    return r


def finish(r, gated):
    three, six = bundles(r, gated)
    r = masked(dict(r))
    r.update(bundle_complete_3h=three, bundle_complete_6h=six, bundle_complete_overall=three * six)
    return r


def baseline_rows(c: Clinic, grain="icustay"):
    """The baseline measure by definition, one admission after the other."""
    out = []
    noon = dt.timedelta(hours=12)
    for subject, hadm, admitted in c.rows["admissions"]:
        found = [x for _, h, x in c.rows["diagnoses_icd"] if h == hadm]
        born = next(d for s, d in c.rows["patients"] if s == subject)
        age = admitted.year - born.year
        if age < 18 or not {codes.SEPSIS, codes.SEVERE_SEPSIS, codes.SEPTIC_SHOCK} & set(found):
            continue
        cultures = [t for _, h, i, t, _ in c.rows["microbiologyevents"] if h == hadm and i == 70012 and t]
        drugs = [t + noon for _, h, n, _, t in c.rows["prescriptions"] if h == hadm and is_antibiotic(n)]
        zero = min([*cultures, *drugs, FAR])
        labs = [(t, v) for _, h, t, i, v in c.rows["labevents"] if h == hadm and i == 50813]
        charts = [(t, i, v) for _, h, t, i, v in c.rows["chartevents"] if h == hadm]
        early = [v for t, v in labs if hours(t, zero) <= 3]
        row = {
            "subject_id": subject, "hadm_id": hadm, "age_at_admission": age,
            "severe_sepsis": int(codes.SEVERE_SEPSIS in found),
            "septic_shock": int(codes.SEPTIC_SHOCK in found),
            "sepsis_time_zero": zero,
            "lactate_measured_3h": int(bool(early)),
            "initial_lactate_value": max([v for v in early if v is not None], default=None),
            "blood_culture_3h": int(any(hours(t, zero) <= 3 for t in cultures)),
            "antibiotics_3h": int(any(hours(t, zero) <= 3 for t in drugs)),
            "fluids_administered_3h": int(
                any(i in codes.FLUIDS and hours(t, zero) <= 3 for t, i, _ in charts)
            ),
            "repeat_lactate_6h": int(any(3 <= hours(t, zero) <= 6 for t, _ in labs)),
            "vasopressors_administered_6h": int(
                any(i in codes.VASOPRESSORS and hours(t, zero) <= 6 for t, i, _ in charts)
            ),
            "persistent_hypotension_6h": int(
                any(
                    i in codes.MEAN_ARTERIAL_PRESSURE and v is not None and v < 65
                    and 3 <= hours(t, zero) <= 6
                    for t, i, v in charts
                )
            ),
        }
        stays = {s for _, h, s, _ in c.rows["icustays"] if h == hadm}
        copies = max(1, len(stays)) if grain == "icustay" else 1
        out += [finish(row, gated=False)] * copies
    return out


def final_rows(c: Clinic, base):
    """The corrected table by definition, from base rows."""
    out = []
    for b in base:
        hadm = b["hadm_id"]
        found = {x for _, h, x in c.rows["diagnoses_icd"] if h == hadm}
        shock_code = codes.SEPTIC_SHOCK in found
        any_code = bool(found & {codes.SEVERE_SEPSIS, codes.SEPTIC_SHOCK})
        r = dict(b)
        r["septic_shock"] = int(bool(b["septic_shock"]) or shock_code)
        if b["severe_sepsis"]:
            r["severe_sepsis"] = int(not b["septic_shock"])
        else:
            r["severe_sepsis"] = int(any_code and not shock_code)
        starts = [
            t for _, h, n, g, t in c.rows["prescriptions"] if h == hadm and is_antibiotic(n, g)
        ]
        zero = b["sepsis_time_zero"]
        r["antibiotics_3h"] = int(
            any(t >= zero and t - zero < dt.timedelta(hours=3) for t in starts)
        )
        out.append(finish(masked(r), gated=True))
    return out
