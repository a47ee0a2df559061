"""Stored tables: versions, untouched files, stopped and repeated changes, stable ids, refreshed measures."""

import datetime as dt

import pytest
from conftest import as_set
from pyspark.sql import functions as F
from tidemark.operators import stored
from tidemark.operators.cohort import KEYS
from tidemark.plans import baseline, refresh
from tidemark.sources import versions
from tidemark_checks.encounters import clinical_tables
from tidemark_checks.queries import BY_ADMISSION

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(100).selectExpr("if(id = 99, NULL, id % 20) AS k", "id AS v", "TIMESTAMP_NTZ '2020-01-01' + make_dt_interval(0, int(id)) AS t")
    return versions.create(rows, str(tmp_path / "t"), ["k"], 8)


def files(table):
    return {p: d for p, d in table.places.items()}


def test_a_change_rewrites_its_parts_only(spark, table):
    updates = spark.createDataFrame([(3, 1000), (3, 7), (77, 1)], "k long, n long")
    new = stored.update_stored(table, updates, ["k"], {"v": F.col("n")})
    before, after = files(table), files(new)
    touched = set(table.touched(updates))
    assert {p for p in before if before[p] != after.get(p)} <= touched and len(touched) < len(before)
    expect = {(r.k, 7 if r.k == 3 else r.v) for r in table.read().collect()}
    assert as_set(new.read().select("k", "v").distinct()) == expect and new.read().count() == 100
    assert as_set(table.at(0).read()) == as_set(table.read()) and versions.open_table(spark, table.path).version == 1


def test_a_change_that_stops_leaves_the_version_before(spark, table):
    def fails(base):
        return base.withColumn("v", F.when(F.col("v") == 43, F.raise_error(F.lit("stopped"))).otherwise(F.col("v")))

    rows = spark.sql("SELECT 3L AS k UNION ALL SELECT 5L")
    with pytest.raises(Exception, match="stopped"):
        table.change(rows, fails)
    now = versions.open_table(spark, table.path)
    assert now.version == 0 and as_set(now.read()) == as_set(table.read())
    # What the stopped change left behind is in nobody's way and goes with the old versions.
    after = now.change(rows, lambda base: base.where("k <> 3"))
    assert after.version == 1 and after.read().count() == 95
    kept = set(after.places.values())
    assert after.forget() > 0
    again = versions.open_table(spark, table.path)
    assert set(again.places.values()) == kept and again.read().count() == 95
    with pytest.raises(Exception):
        again.at(0)


def test_two_writers_do_not_overwrite_each_other(spark, table):
    rows = spark.sql("SELECT 3L AS k")
    table.change(rows, lambda base: base.where("k <> 3"))
    with pytest.raises(RuntimeError, match="someone else"):
        table.change(rows, lambda base: base.limit(0))


def test_rows_may_not_move_to_other_parts(spark, table):
    with pytest.raises(Exception, match="outside the parts"):
        table.change(spark.sql("SELECT 3L AS k"), lambda base: base.withColumn("k", F.col("k") + 1))


def test_named_changes_happen_once(spark, table):
    add = spark.createDataFrame([(3, 5)], "k long, n long")
    once = stored.update_stored(table, add, ["k"], {"v": F.col("v") + F.col("n")}, name="add")
    twice = stored.update_stored(once, add, ["k"], {"v": F.col("v") + F.col("n")}, name="add")
    assert twice.version == once.version and twice.done == ("add",)
    other = stored.update_stored(once, add, ["k"], {"v": F.col("v") + F.col("n")}, name="add more")
    assert other.read().where("k = 3").agg(F.sum("v")).first()[0] == once.read().where("k = 3").agg(F.sum("v")).first()[0] + 25


def test_append_absent_twice_adds_once(spark, table):
    new = spark.createDataFrame([(3, 1, None, "?"), (50, 2, None, "?"), (51, 3, dt.datetime(2021, 1, 1), "?")], "k long, v long, t timestamp_ntz, extra string")
    once = stored.append_absent_stored(table, new, ["k"])
    assert stored.append_absent_stored(once, new, ["k"]).version == once.version == 1
    assert as_set(once.read().where("k >= 50")) == {(50, 2, None), (51, 3, dt.datetime(2021, 1, 1))}
    with pytest.raises(ValueError, match="must be among"):
        stored.append_absent_stored(table, new, ["v"])


def test_first_values_are_raised_in_place(spark, table):
    chosen = spark.sql("SELECT 4L AS k")
    raised = stored.raise_first_stored(table, chosen, "k", "t", "v", F.lit(True), 10, 500)
    assert as_set(raised.read().where("k = 4").select("v")) == {(500,), (24,), (44,), (64,), (84,)}
    assert stored.raise_first_stored(raised, chosen, "k", "t", "v", F.lit(True), 10, 500).read().where("v = 500").count() == 1


def test_ids_stay_over_runs(spark, tmp_path):
    registry = versions.create(spark.createDataFrame([], "a long, b string, id int"), str(tmp_path / "ids"), ["a", "b"], 4)
    rows = spark.createDataFrame([(2, "x"), (1, "y"), (1, "y"), (None, "z")], "a int, b string")
    first = stored.register(registry, rows, start=10)
    assert as_set(first.read()) == {(1, "y", 11), (2, "x", 12)}
    assert stored.register(first, rows).version == first.version
    more = stored.register(first, rows.unionByName(spark.createDataFrame([(0, "a"), (9, "b")], "a int, b string")))
    assert as_set(more.read()) == {(1, "y", 11), (2, "x", 12), (0, "a", 13), (9, "b", 14)}
    assert stored.register(more, rows.limit(0)).version == more.version


def test_late_events_move_time_zero(spark, tmp_path):
    tables = {n: clinical_tables(spark, SMALL)[n] for n in BY_ADMISSION.tables()}
    # The earliest events of each admission come last.
    late = {}
    for n in ("microbiologyevents", "prescriptions", "labevents", "chartevents"):
        early = F.col("hadm_id") % 2 == 0
        late[n], tables[n] = tables[n].where(early), tables[n].where(~early)
    live = refresh.start(tables, str(tmp_path / "live"), BY_ADMISSION, 8)
    before = live.flags.read()
    part = {n: rows.where("hadm_id % 8 = 2") for n, rows in late.items()}
    some = refresh.refresh(live, part, "some")
    changed = as_set(some.flags.read()) - as_set(before)
    assert changed and {r[1] % 8 for r in changed} == {2}
    assert refresh.refresh(some, part, "some").flags.version == some.flags.version
    # A batch that had reached the event tables only is finished by running it again.
    rest = {n: rows.where("hadm_id % 8 <> 2") for n, rows in late.items()}
    half = dict(some.tables)
    half["labevents"] = half["labevents"].change(rest["labevents"], lambda base: base.unionByName(rest["labevents"]), "rest")
    done = refresh.refresh(refresh.LiveMeasure(half, some.patients, some.flags, some.spec), rest, "rest")
    expect = baseline.baseline_flags(clinical_tables(spark, SMALL), BY_ADMISSION)
    assert sorted(map(str, done.flags.read().collect())) == sorted(map(str, expect.collect()))
    assert done.flags.read().dropDuplicates(list(KEYS)).count() == done.flags.read().count()


def test_empty_tables(spark, tmp_path):
    empty = versions.create(spark.createDataFrame([], "k long"), str(tmp_path / "e"), ["k"])
    assert empty.read().count() == 0 and empty.touched(empty.read()) == []
    assert empty.change(empty.read(), lambda base: base).read().count() == 0
    with pytest.raises(ValueError, match="no versioned table"):
        versions.open_table(spark, str(tmp_path / "none"))
