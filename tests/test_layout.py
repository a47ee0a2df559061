"""Tables stored by admission: no event row is moved, uneven keys still split."""

import datetime as dt

import pytest
from conftest import as_set, plan_text
from tidemark.operators.cohort import KEYS
from tidemark.operators.components import EventFamily, Span, WindowFlag, event_parts, window_components
from tidemark.operators.scale import materialise
from tidemark.plans import baseline
from tidemark.sources import layout
from tidemark_checks.encounters import clinical_tables
from tidemark_checks.queries import BY_ADMISSION

SMALL = "/root/testdata/sf0.001"
EVENTS = ("microbiologyevents", "prescriptions", "labevents", "chartevents")


def tree(plan, above=()):
    """(names of the operators above, text) of every leaf of a physical plan."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from tree(plan.executedPlan(), above)
        return
    below = plan.children()
    if below.size() == 0:
        yield above, plan.toString()
    for i in range(below.size()):
        yield from tree(below.apply(i), (*above, name))


def moved_raw(df, table):
    """Whether rows of a scan of ``table`` are exchanged before a join or an aggregate took them in."""
    found = []
    for above, text in tree(df._jdf.queryExecution().executedPlan()):
        if table in text:
            for name in reversed(above):
                if "Join" in name or "Aggregate" in name:
                    found.append(False)
                    break
                if name == "Exchange":
                    found.append(True)
                    break
    assert found
    return any(found)


@pytest.fixture(scope="module")
def stored(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS layout_test")
    tables = dict(clinical_tables(spark, SMALL).items())
    lazy = clinical_tables(spark, SMALL)
    for name in (*EVENTS, "admissions", "patients", "diagnoses_icd", "icustays"):
        tables[name] = layout.store(lazy[name], f"layout_test.{name}", KEYS, 8, uneven_rows=40) if name in EVENTS else lazy[name]
    yield tables
    spark.sql("DROP DATABASE layout_test CASCADE")


def test_uneven_keys_lie_beside_the_buckets(spark, stored):
    lazy = clinical_tables(spark, SMALL)
    for name in EVENTS:
        table, plain = stored[name], lazy[name]
        assert sorted(map(str, table.whole().collect())) == sorted(map(str, plain.collect()))
        sizes = {tuple(r[:2]): r["count"] for r in plain.groupBy(*KEYS).count().collect()}
        hot = {k for k, n in sizes.items() if n > 40}
        assert {tuple(r) for r in table.uneven.select(*KEYS).distinct().collect()} == hot


def test_measure_on_stored_tables_is_the_same(spark, stored):
    expect = baseline.baseline_flags(clinical_tables(spark, SMALL), BY_ADMISSION)
    got = baseline.baseline_flags(stored, BY_ADMISSION)
    assert sorted(map(str, got.collect())) == sorted(map(str, expect.collect()))


def test_events_are_not_moved(spark, stored, settings):
    settings(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1)
    anchored = materialise(baseline.anchored_cohort(stored, BY_ADMISSION), "anchored")
    flags = baseline.with_components(stored, anchored, BY_ADMISSION)
    for name in ("labevents", "chartevents"):
        assert not moved_raw(flags, f"layout_test.{name}[")
        assert moved_raw(flags, f"layout_test.{name}_uneven[")
    plain = baseline.with_components(clinical_tables(spark, SMALL), anchored, BY_ADMISSION)
    assert moved_raw(plain, "events.parquet")


def shuffled_rows(df):
    """Rows that all exchanges of an executed plan wrote."""
    df.collect()

    def walk(plan):
        name, below = plan.nodeName(), plan.children()
        if name == "AdaptiveSparkPlan":
            return walk(plan.executedPlan())
        if name.endswith("QueryStage"):
            return walk(plan.plan())
        rows = plan.metrics().get("shuffleRecordsWritten")
        return (rows.get().value() if rows.isDefined() else 0) + sum(walk(below.apply(i)) for i in range(below.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_a_bloom_filter_of_the_cohort_drops_other_events_in_the_scan(spark, settings, tmp_path):
    settings(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1)
    settings(**{f"spark__sql__optimizer__runtime__bloomFilter__{k}": v for k, v in (("applicationSideScanSizeThreshold", 0), ("creationSideThreshold", "1g"))})
    at = "timestampadd(MINUTE, id % 300, TIMESTAMP_NTZ '2020-01-01')"
    spark.range(20_000).selectExpr("id % 1000 AS subject_id", "id % 1000 AS hadm_id", f"{at} AS charttime", "id % 2 + 1 AS itemid").write.parquet(str(tmp_path / "events"))
    events = {"labevents": spark.read.parquet(str(tmp_path / "events"))}
    family = EventFamily("lab", "labevents", "charttime", code_column="itemid", codes=(1,))
    anchors = spark.range(10).selectExpr("id AS subject_id", "id AS hadm_id", "TIMESTAMP_NTZ '2020-01-01' AS zero")
    spec = [WindowFlag("early", "lab", Span(1))]

    def found():
        return window_components(event_parts(events, [family]), anchors, spec, "zero")

    filtered = found()
    assert "might_contain" in plan_text(filtered) and filtered.where("early = 1").count() == 5
    few = shuffled_rows(filtered)
    settings(spark__sql__optimizer__runtime__bloomFilter__enabled="false")
    plain = found()
    assert "might_contain" not in plan_text(plain) and sorted(plain.collect()) == sorted(found().collect())
    # 100 of 10,000 events belong to the cohort; some more may slip through the filter.
    assert few < 400 < 10_000 <= shuffled_rows(plain)


def test_anchors_without_a_time_have_no_window(spark):
    events = spark.sql("SELECT 1L AS subject_id, 1L AS hadm_id, 'lab' AS family, TIMESTAMP_NTZ '2020-01-01' AS ts, 1D AS value")
    anchors = spark.sql("SELECT 1L AS subject_id, 1L AS hadm_id, CAST(NULL AS TIMESTAMP_NTZ) AS zero")
    assert window_components(events, anchors, [WindowFlag("early", "lab", Span(1))], "zero").count() == 0


def test_rows_without_key_and_repeated_writes(spark):
    rows = [(1, 1, dt.datetime(2020, 1, 1)), (None, 2, None), (3, None, None), (1, 1, None)]
    df = spark.createDataFrame(rows, "subject_id long, hadm_id long, t timestamp_ntz")
    spark.sql("CREATE DATABASE IF NOT EXISTS layout_odd")
    try:
        table = layout.store(df, "layout_odd.e", KEYS, 4, sort=["t"], mode="overwrite")
        table = layout.store(df, "layout_odd.e", KEYS, 4, sort=["t"], mode="overwrite")
        assert as_set(table.uneven) == {rows[1], rows[2]} and table.even.count() == 2
        assert layout.store(df.limit(0), "layout_odd.empty", KEYS, 4).whole().count() == 0
    finally:
        spark.sql("DROP DATABASE layout_odd CASCADE")
