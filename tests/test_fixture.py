"""The derived clinical tables tell every code and pattern of the measure apart."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators.components import event_relation
from tidemark.plans import baseline
from tidemark.plans.final import antibiotic_starts
from tidemark.plans.spec import SEPSIS
from tidemark_checks.encounters import clinical_tables

SF = "/root/testdata/sf0.01"
# Written out here, so that a code lost from the measure is seen.
CODES = {
    "culture": (70012,),
    "lactate": (50813,),
    "fluid": (30061, 30062, 30063),
    "vasopressor": (221906, 221289, 221749, 222315, 221662),
    "pressure": (52, 456, 6702, 443, 220052, 220181, 225312),
}
DRUGS = ("cefepime", "vancomycin", "piperacillin")


@pytest.fixture(scope="module")
def clinic(spark):
    return clinical_tables(spark, SF)


def rows(tables, family):
    """Events of a family as the registered query ``family_events`` counts them."""
    found = event_relation(tables, [family]).groupBy("family", F.to_date("ts").alias("day")).agg(F.count("*"), F.sum("value"))
    return {tuple(r) for r in found.collect()}


@pytest.mark.parametrize("name", list(CODES))
def test_every_code_of_a_family_counts(clinic, name):
    family = SEPSIS.family(name)
    assert set(family.codes) == set(CODES[name])
    everything = rows(clinic, family)
    for code in CODES[name]:
        rest = tuple(c for c in CODES[name] if c != code) or (-1,)
        assert rows(clinic, replace(family, codes=rest)) != everything, code
    every = tuple(r[0] for r in clinic[family.table].select(family.code_column).distinct().collect())
    assert set(every) - set(CODES[name]) and rows(clinic, replace(family, codes=every)) != everything


@pytest.mark.parametrize("family", [SEPSIS.family("antibiotic"), replace(antibiotic_starts("startts"), name="antibiotic")], ids=["onset", "final"])
def test_every_drug_and_column_counts(clinic, family):
    assert set(family.patterns) == set(DRUGS)
    count = lambda f: event_relation(clinic, [f]).count()
    everything = count(family)
    for drug in DRUGS:
        assert count(replace(family, patterns=tuple(d for d in DRUGS if d != drug))) < everything
    for column in family.text_columns:
        rest = tuple(c for c in family.text_columns if c != column)
        assert not rest or count(replace(family, text_columns=rest)) < everything
    assert everything < count(replace(family, text_columns=("drug", "drug_name_poe", "drug_name_generic"), patterns=("e",)))


def test_cohort_codes_count(clinic):
    tables = clinic
    assert set(SEPSIS.cohort_codes) == {"99591", "99592", "78552"}
    everything = baseline.cohort(tables).count()
    for code in SEPSIS.cohort_codes:
        fewer = SEPSIS.with_(cohort_codes=tuple(c for c in SEPSIS.cohort_codes if c != code))
        assert baseline.cohort(tables, fewer).count() < everything
    assert baseline.cohort(tables, SEPSIS.with_(cohort_codes=(*SEPSIS.cohort_codes, "4019"))).count() > everything
