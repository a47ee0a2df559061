"""Dirty rows are refused with reasons and counted; selections read what was written."""

import datetime as dt

import pytest
from conftest import as_set, plan_text
from tidemark.operators import cohort
from tidemark.operators.components import EventFamily, event_relation
from tidemark.sources.checked import checked
from tidemark_checks.queries import REGISTRY as QUERIES

SMALL = "/root/testdata/sf0.001"
ROWS = [
    ("1", " 2020-01-01 10:00:00 ", "5", "x"),
    ("2", "soon", "5.5", "x"),
    ("3", None, None, None),
    ("", "2020-01-02", "7", "x"),
    (None, " ", "999999999999", "x"),
    ("1", " 2020-01-01 10:00:00 ", "5", "x"),
]
TYPES = {"t": "timestamp_ntz", "v": "int"}


def test_rows_are_split_and_counted(spark):
    df = spark.createDataFrame(ROWS, "id string, t string, v string, reasons_text string")
    found = checked(df, TYPES, ["id", "t"])
    good = found.good.collect()
    assert [tuple(r) for r in good] == [("1", dt.datetime(2020, 1, 1, 10), 5, "x")] * 2
    refused = {(r.id, r.t): r.reasons for r in found.refused.collect()}
    assert refused == {("2", "soon"): ["wrong t", "wrong v"], ("3", None): ["missing t"], ("", "2020-01-02"): ["missing id"], (None, " "): ["missing id", "missing t", "wrong v"]}
    assert found.counts.get == {"rows": 6, "refused": 4, "wrong t": 1, "wrong v": 2, "missing id": 2, "missing t": 2}


def test_clean_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 2)], "id long, v long")
    assert as_set(checked(df, {"v": "int"}).good) == {(1, 2)} and checked(df, {}).refused.count() == 0
    assert checked(df.limit(0), {"v": "int"}, ["id"]).good.count() == 0
    with pytest.raises(ValueError, match="no such columns"):
        checked(df, {"w": "int"})


def test_one_dirty_time_does_not_end_the_job(spark):
    events = spark.createDataFrame([(1, 1, "2020-01-02", 7), (1, 1, "not a time", 7), (2, 2, "x", 7)], "subject_id long, hadm_id long, charttime string, itemid int")
    family = EventFamily("lab", "labevents", "charttime", code_column="itemid", codes=(7,))
    firsts = cohort.first_times(event_relation({"labevents": events}, [family]), ["lab"])
    assert as_set(firsts) == {(1, 1, dt.datetime(2020, 1, 2)), (2, 2, None)}


@pytest.mark.parametrize(("name", "most"), [("select_nested", 4), ("select_fraction", 4), ("hash_rank", 2)])
def test_selections_read_what_was_written(spark, name, most):
    text = plan_text(QUERIES[name](spark, SMALL))
    assert 0 < text.count("FileScan") <= most and "orders.parquet" not in text and "events.parquet" not in text
