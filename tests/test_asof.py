"""As-of lookups and nearest measurements against plain Python."""

import datetime as dt
import random

import pytest
from tidemark.operators import asof, cohort

T0 = dt.datetime(2020, 1, 1)
FACTORS, BOUNDS = {1: 1, 2: 0.5}, (30, 300)


def minutes(m):
    return T0 + dt.timedelta(minutes=m)


def hours(a, b):
    return int(abs((b - a).total_seconds()) // 3600)


def brute(anchors, events):
    out = []
    for anchor, key, start in anchors:
        found = []
        for k, ts, code, value, tie in events:
            if k == key and k is not None and ts is not None and code in FACTORS and value is not None and 30 <= value * FACTORS[code] <= 300:
                found.append((code, -1 if start is None else hours(start, ts), ts, tie, value * FACTORS[code]))
        if found:
            best = min(found)
            out.append((anchor, key, start, best[2], round(best[4], 1)))
    return sorted(out, key=str)


def nearest(spark, anchors, events):
    left = spark.createDataFrame(anchors, "anchor int, stay int, intime timestamp_ntz")
    right = spark.createDataFrame(events, "stay int, ts timestamp_ntz, itemid int, valuenum double, tie int")
    got = cohort.nearest_measurement(left, right, ["stay"], ["anchor"], "intime", "ts", FACTORS, BOUNDS, tie_break=["tie"])
    assert got.columns == ["stay", "ts", "weight_kg", "anchor", "intime"]
    return sorted(((r.anchor, r.stay, r.intime, r.ts, r.weight_kg) for r in got.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_nearest_measurement_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    spread = [90, 600, 20_000][seed]
    anchors = [(i, rng.randrange(6), minutes(rng.randrange(spread))) for i in range(80)]
    anchors += [(100, 2, None), (101, None, minutes(5)), (102, 99, minutes(5))]
    events = [
        (rng.randrange(5), minutes(rng.randrange(-200, spread + 200)), rng.choice([1, 2, 2, 3]), rng.choice([None, 10.0, 64.0, 80.0, 500.0]), i)
        for i in range(400)
    ]
    events += [(2, None, 1, 70.0, 1), (None, minutes(3), 1, 70.0, 2), *events[:30]]
    assert nearest(spark, anchors, events) == brute(anchors, events)


def test_neighbours(spark):
    events = spark.createDataFrame(
        [("a", minutes(0), 1), ("a", minutes(0), 2), ("a", minutes(300), 3), ("b", minutes(10), 4)], "k string, t timestamp_ntz, v int"
    )
    probes = spark.createDataFrame([("a", minutes(m)) for m in (-1, 0, 1, 299, 300, 5000)] + [("b", None), ("c", minutes(0))], "k string, p timestamp_ntz")
    reduced = asof.one_per_time(events, ["k"], "t", ["v"])
    got = {(r.k, r.p): (r.before and r.before.v, r.after and r.after.v) for r in asof.neighbours(probes, reduced, ["k"], "p").collect()}
    assert got == {
        ("a", minutes(-1)): (None, 1),
        ("a", minutes(0)): (1, 3),
        ("a", minutes(1)): (1, 3),
        ("a", minutes(299)): (1, 3),
        ("a", minutes(300)): (3, None),
        ("a", minutes(5000)): (3, None),
        ("b", None): (None, 4),
        ("c", minutes(0)): (None, None),
    }


def most_rows(plan):
    """Largest number of rows any step of an executed plan put out."""
    name, below = plan.nodeName(), plan.children()
    if name == "AdaptiveSparkPlan":
        return most_rows(plan.executedPlan())
    if name.endswith("QueryStage"):
        return most_rows(plan.plan())
    rows = plan.metrics().get("numOutputRows")
    return max([rows.get().value() if rows.isDefined() else 0, *(most_rows(below.apply(i)) for i in range(below.size()))])


def test_rows_grow_with_anchors_plus_measurements(spark):
    anchors = spark.range(2000).selectExpr("int(id) AS anchor", "1 AS stay", "timestampadd(MINUTE, id, TIMESTAMP_NTZ '2020-01-01 00:00:30') AS intime")
    events = spark.range(2000).selectExpr("1 AS stay", "timestampadd(MINUTE, id, TIMESTAMP_NTZ '2020-01-01') AS ts", "1 AS itemid", "70D AS valuenum")
    got = cohort.nearest_measurement(anchors, events, ["stay"], ["anchor"], "intime", "ts", FACTORS, BOUNDS)
    assert got.count() == 2000
    got.collect()
    assert most_rows(got._jdf.queryExecution().executedPlan()) <= 3 * 4000
