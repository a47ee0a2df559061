"""Registered queries against their SQL, and the shape of their plans."""

import re

import pytest

import __spark_entry__ as entry
import oracle
from conftest import plan_text
from tidemark.plans import baseline
from tidemark_checks.oracles import ORACLES as SQL
from tidemark_checks.queries import BY_ADMISSION
from tidemark_checks.queries import REGISTRY as QUERIES
from tidemark_checks.encounters import clinical_tables

SMALL = "/root/testdata/sf0.001"
# Operators with a join, a rank or a write in them, for the run where every key is hot.
SKEWED = (
    "label_codes coded_admissions nearest_measurement adult_cohort window_flags window_values "
    "half_open_flags baseline_flags final_flags select_fraction select_nested append_absent_range "
    "append_absent_code update_from_join raise_first_value rows_at_first present_absent"
).split()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert oracle.compare(QUERIES[name](spark, SMALL), duck, SQL[name]) is None


@pytest.mark.parametrize("name", SKEWED)
def test_query_equals_sql_when_all_keys_are_hot(spark, duck, uneven, name):
    uneven()
    assert oracle.compare(QUERIES[name](spark, SMALL), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_all_rows(spark, name):
    text = plan_text(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def test_events_of_one_table_are_read_once(spark):
    tables = clinical_tables(spark, SMALL)
    anchored = baseline.anchored_cohort(tables, BY_ADMISSION)
    text = plan_text(baseline.with_components(tables, anchored, BY_ADMISSION))
    filters = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
    assert sum("click" in f for f in filters) == 1
    assert sum("view" in f for f in filters) == 1
    assert all("EqualTo(event_type" in f for f in filters if "event_type" in f)


def test_only_used_columns_are_read(spark):
    text = plan_text(QUERIES["concept_counts"](spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert sorted(schemas) == ["l_partkey:bigint", "p_partkey:bigint,p_name:string"]


def test_facts_are_counted_before_they_meet_the_dictionary(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold=-1)
    text = plan_text(QUERIES["concept_counts"](spark, SMALL))
    assert "partial_count(1)" in text[text.index("Join"):]
