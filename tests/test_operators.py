"""Discovery, cohort, strata and change operators against brute force."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import as_set, plan_text
from tidemark.functions import timeops as t
from tidemark.operators import changes, cohort, discovery, extensions, rows, status, strata
from tidemark.plans import codes
from tidemark.plans.bundles import composite_3h, composite_6h

H = dt.timedelta(hours=1)
HOUR = t.HOUR_US
T0 = dt.datetime(2024, 1, 10, 8)


def md5(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)


# --- discovery and rows --------------------------------------------------------


def test_counts_with_a_repeated_dictionary_entry(spark):
    facts = spark.createDataFrame([(1,)] * 5 + [(2,)] * 2 + [(3,)], "code int")
    names = spark.createDataFrame(
        [(1, "Lactate"), (1, "Lactate"), (1, "lactate v"), (2, "Lactate dehydrogenase"), (9, "lactate")],
        "code int, label string",
    )
    got = discovery.concept_counts(facts, names, "code", "label", ["lactate"], ["dehydrogenase"])
    assert as_set(got) == {(1, "Lactate", 10), (1, "lactate v", 5)}


def test_alias_inventory_reads_once_and_skips_null(spark):
    df = spark.createDataFrame(
        [("Cefepime", None, "cefepime"), ("cefepime", "CEFEPIME IV", "x")], "a string, b string, c string"
    )
    cols = ["a", "b", "c"]
    assert as_set(discovery.alias_inventory(df, cols, ["cefepime"])) == {("cefepime", 1), ("cefepime iv", 1)}
    counted = discovery.alias_inventory(df, cols, ["cefepime"], dedup=False)
    assert plan_text(counted).count("Scan") == 1
    assert as_set(counted) == {("cefepime", 3), ("cefepime iv", 1)}


def test_first_event_uses_the_date_where_the_time_is_missing(spark):
    df = spark.createDataFrame(
        [(1, T0, T0.date()), (1, None, T0.date()), (2, None, None), (3, T0, T0.date())],
        "k int, charttime timestamp_ntz, chartdate date",
    )
    midnight = dt.datetime(2024, 1, 10)
    got = cohort.first_event(df, ["k"], "charttime", "chartdate")
    assert as_set(got) == {(1, midnight), (2, None), (3, T0)}
    assert as_set(cohort.first_event(df, ["k"], "charttime")) == {(1, T0), (2, None), (3, T0)}


def test_best_row_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    best = rows.best_row(df, ["k"], ["v"])
    text = plan_text(best)
    assert "WindowGroupLimit" in text and text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert as_set(best) == {(0, 0), (1, 1), (2, 2)}


def test_sort_splits_a_value_that_most_rows_share(spark, settings):
    settings(spark__sql__adaptive__enabled="false")
    df = spark.range(3000, numPartitions=4).selectExpr("id", "if(id % 3 < 2, 5, id) AS v")
    got = rows.sort_output(df, "v")
    parts = got.where("v = 5").groupBy(F.spark_partition_id()).count()
    assert got.columns == ["id", "v"] and parts.count() > 1
    values = [r.v for r in got.collect()]
    assert values == sorted(values) and len(values) == 3000
    down = [r.v for r in rows.sort_output(df, "v", descending=True).collect()]
    assert down == values[::-1]


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_text(rows.top_k(spark.range(100), 3, "id"))


def nearest(spark, weights, anchors=((1, T0),)):
    events = spark.createDataFrame(weights, "stay int, ts timestamp_ntz, itemid int, valuenum double")
    stays = spark.createDataFrame(list(anchors), "stay int, intime timestamp_ntz")
    return cohort.nearest_measurement(
        stays, events, ["stay"], ["stay"], "intime", "ts",
        {codes.WEIGHT_KG: 1, codes.WEIGHT_LB: codes.KG_PER_LB}, codes.WEIGHT_RANGE_KG,
    )


def test_kg_wins_over_a_nearer_lb(spark):
    (row,) = nearest(spark, [(1, T0, codes.WEIGHT_LB, 150.0), (1, T0 + 10 * H, codes.WEIGHT_KG, 70.04)]).collect()
    assert (row.ts, row.weight_kg) == (T0 + 10 * H, 70.0)


def test_weight_bounds_and_ties(spark):
    kg = codes.WEIGHT_KG
    bounds = [(i, T0, kg, v) for i, v in enumerate([29.9, 30.0, 300.0, 300.1, None])]
    got = nearest(spark, bounds, [(i, T0) for i in range(5)])
    assert {(r.stay, r.weight_kg) for r in got.collect()} == {(1, 30.0), (2, 300.0)}
    half = dt.timedelta(minutes=50)
    # Both are 0 whole hours away, so the earlier one is taken although it is farther.
    ties = [(1, T0 - half, kg, 60.0), (1, T0 + dt.timedelta(minutes=1), kg, 80.0)]
    assert nearest(spark, ties).first().weight_kg == 60.0


# --- status --------------------------------------------------------------------


def test_reconciliation_truth_table(spark):
    values = [0, 1, None]
    base, expected = [], set()
    for i, (sev, sho, any_, cs) in enumerate(
        (a, b, c, d) for a in values for b in values for c in values for d in values
    ):
        base.append((i, sev, sho, any_, cs))
        sev, sho, any_, cs = (bool(x) for x in (sev, sho, any_, cs))
        severe = (sev and not sho) or (not sev and any_ and not cs)
        expected.add((i, int(severe), int(sho or cs)))
    df = spark.createDataFrame(base, "hadm_id int, severe_sepsis int, septic_shock int, sepsis_icd int, shock_icd int")
    got = status.reconcile_status(
        df.select("hadm_id", "severe_sepsis", "septic_shock"),
        df.select("hadm_id", "sepsis_icd", "shock_icd").where("hadm_id % 9 != 8"),
        ["hadm_id"],
    )
    assert as_set(got.where("hadm_id % 9 != 8")) == {e for e in expected if e[0] % 9 != 8}
    assert got.count() == 81


def test_lactate_limits_of_the_6_hour_bundle(spark):
    df = spark.sql(
        "SELECT *, 0 AS repeat_lactate_6h, 1 AS vasopressors_administered_6h, 0 AS persistent_hypotension_6h,"
        " 1 AS blocked FROM VALUES (NULL), (2.0D), (2.1D), (4.0D) AS v(initial_lactate_value)"
    )
    severe = df.selectExpr("*", "1 AS severe_sepsis", "0 AS septic_shock").select(composite_6h())
    shock = df.selectExpr("*", "0 AS severe_sepsis", "1 AS septic_shock").select(composite_6h())
    neither = df.selectExpr("*", "0 AS severe_sepsis", "NULL AS septic_shock").select(composite_6h())
    gated = df.selectExpr("*", "1 AS severe_sepsis", "0 AS septic_shock", "0 AS g").select(composite_6h("g"))
    values = lambda d: [r[0] for r in d.collect()]
    assert values(severe) == [1, 1, 0, 0] and values(shock) == [0, 0, 0, 1]
    assert values(neither) == [0] * 4 and values(gated) == [0] * 4


def test_3_hour_bundle_for_all_flag_combinations(spark):
    names = ["severe_sepsis", "septic_shock", "lactate_measured_3h", "blood_culture_3h", "antibiotics_3h",
             "fluids_administered_3h"]
    grid = spark.range(3 ** 6).selectExpr(
        "id", *[f"nullif(int(id div {3 ** i} % 3), 2) AS {n}" for i, n in enumerate(names)]
    )
    for r in grid.withColumn("out", composite_3h()).collect():
        basic = r.lactate_measured_3h == r.blood_culture_3h == r.antibiotics_3h == 1
        if r.severe_sepsis == 1:
            want = basic
        else:
            want = r.septic_shock == 1 and basic and r.fluids_administered_3h == 1
        assert r.out == int(want)


def test_summary(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1), (0, 1), (NULL, 0) AS v(a, b)")
    got = status.cohort_summary(df, {"x": F.col("a") == 1, "y": F.col("b") == 1}).first()
    assert tuple(got) == (3, 1, 2)
    assert tuple(status.scalar_summary(df.where("false"), "a", 50).first()) == (50, 0)


# --- strata --------------------------------------------------------------------


def uneven_strata(spark):
    """2,000 ids, two thirds of them in one stratum."""
    return spark.range(2000).selectExpr("id", "if(id % 3 < 2, 'big', concat('s', id % 7)) AS stratum")


def brute_selection(rows_, rate, salt, jitter_salt):
    by = {}
    for i, s in rows_:
        by.setdefault(s, []).append(i)
    chosen = set()
    for s, ids in by.items():
        k = int(rate[s] * len(ids) // 1) + (md5(s, jitter_salt) % 3 - 1 if jitter_salt else 0)
        k = max(0, min(len(ids), k))
        ids.sort(key=lambda i: (md5(i, s, salt), i))
        chosen |= {(i, s) for i in ids[:k]}
    return chosen


@pytest.mark.parametrize("per_slice", [250_000, 1000, 2])
@pytest.mark.parametrize("percent", [0, 37, 100])
def test_selection_equals_brute_force(spark, per_slice, percent):
    df = uneven_strata(spark)
    rates = strata.stratum_rates(df, "stratum", [strata.RateSpec("p", percent, 1, 5)])
    got = strata.select_fraction(df, "stratum", "id", rates, "p", 42, jitter_salt=7, rows_per_slice=per_slice)
    plain = [(r.id, r.stratum) for r in df.collect()]
    rate = {r.stratum: r.p for r in rates.collect()}
    assert set(rate.values()) == {percent / 100}
    assert as_set(got, "id", "stratum") == brute_selection(plain, rate, 42, 7)


def test_selection_on_large_input_settings(spark, uneven):
    df = uneven_strata(spark)
    rates = strata.stratum_rates(df, "stratum", [strata.RateSpec("p", 30, 20, 5)])
    want = as_set(strata.select_fraction(df, "stratum", "id", rates, "p", 1), "id")
    uneven()
    assert as_set(strata.select_fraction(df, "stratum", "id", rates, "p", 1), "id") == want


def test_same_salt_gives_nested_selections(spark):
    df = uneven_strata(spark)
    specs = [strata.RateSpec("small", 20, 1, 1), strata.RateSpec("large", 60, 1, 1)]
    rates = strata.stratum_rates(df, "stratum", specs)
    small = as_set(strata.select_fraction(df, "stratum", "id", rates, "small", 9), "id")
    large = as_set(strata.select_fraction(df, "stratum", "id", rates, "large", 9), "id")
    assert small < large
    inner = strata.select_nested(df, df.where("id < 300"), "stratum", "id", rates, "large", 9)
    assert {r.id for r in inner.collect()} <= set(range(300))


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_ranks_are_dense_and_independent_of_the_slices(spark, method):
    df = uneven_strata(spark)
    ranked = strata.hash_rank(df, "stratum", "id", 3, method)
    for r in ranked.groupBy("stratum", "cnt").agg(F.sort_array(F.collect_list("rn")).alias("r")).collect():
        assert r.r == list(range(1, r.cnt + 1))
    other = strata.hash_rank(df, "stratum", "id", 3, method, rows_per_slice=8)
    assert as_set(ranked, "id", "rn") == as_set(other, "id", "rn")


def test_ranking_never_sorts_a_whole_stratum(spark):
    text = plan_text(strata.hash_rank(uneven_strata(spark), "stratum", "id", 3))
    windows = [line for line in text.splitlines() if "Window [row_number" in line]
    assert windows and all("_slice" in line for line in windows)


def test_a_null_stratum_is_ranked_like_any_other(spark):
    df = spark.range(60).selectExpr("id", "if(id % 3 = 0, NULL, concat('s', id % 2)) AS stratum")
    ranked = strata.hash_rank(df, "stratum", "id", 3, rows_per_slice=4)
    assert sorted(r.rn for r in ranked.where("stratum IS NULL").collect()) == list(range(1, 21))
    rates = strata.stratum_rates(df, "stratum", [strata.RateSpec("p", 50, 1, 5)])
    picked = strata.select_fraction(df, "stratum", "id", rates, "p", 42, rows_per_slice=4)
    assert picked.where("stratum IS NULL").count() == 10


def test_groups_stay_small_where_one_stratum_holds_most_rows(spark):
    df = spark.range(20_000).selectExpr("id", "if(id % 10 < 9, 'big', concat('s', id % 7)) AS stratum")
    sliced = strata._hashed(df, "stratum", "id", 3, "md5", 100)
    largest = sliced.groupBy("stratum", "_slice").count().agg(F.max("count")).first()[0]
    assert largest < 200


def test_rates_stay_in_their_range(spark):
    df = uneven_strata(spark)
    spec = strata.RateSpec("p", 42, 27, 31415)
    for r in strata.stratum_rates(df, "stratum", [spec]).collect():
        assert r.p == (42 + md5(r.stratum, 31415) % 27) / 100


def test_surrogate_ids_follow_the_order(spark):
    df = spark.range(1000, numPartitions=6).selectExpr("id", "if(id % 3 = 0, 0, (id * 7919) % 50) AS k")
    got = strata.surrogate_ids(df.repartition(5), ["k", "id"], 100).orderBy("k", "id").collect()
    assert [r.new_id for r in got] == list(range(101, 1101))


def test_grid_has_no_join(spark):
    months = spark.createDataFrame([(1, 2), (2, 0), (3, 3)], "m int, per int")
    got = strata.grid(months, "per")
    assert as_set(got, "m", "n") == {(1, 1), (1, 2), (3, 1), (3, 2), (3, 3)}
    assert as_set(strata.grid(months.select("m"), 2)) == {(m, n) for m in (1, 2, 3) for n in (1, 2)}
    assert "Join" not in plan_text(got) and "Cartesian" not in plan_text(got)


def test_period_cohort(spark):
    adm = spark.createDataFrame(
        [(1, T0), (1, T0), (2, T0), (3, T0 - 24 * H), (4, T0 + 24 * H), (5, T0), (6, T0)],
        "hadm int, admit timestamp_ntz",
    )
    coded = spark.createDataFrame([(h,) for h in (1, 1, 2, 3, 4, 6)], "hadm int")
    events = spark.createDataFrame(
        [(1, T0 + dt.timedelta(minutes=90)), (1, T0 + 5 * H), (2, T0 + dt.timedelta(minutes=89, seconds=59)),
         (3, T0), (4, T0), (5, T0 + 2 * H), (6, T0 + dt.timedelta(minutes=180, seconds=59))],
        "hadm int, ts timestamp_ntz",
    )
    got = strata.period_cohort(
        adm, coded, events, "hadm", "admit", "ts",
        (t.ntz_literal("2024-01-10"), t.ntz_literal("2024-01-11")), (90, 180),
    )
    assert {r.hadm for r in got.collect()} == {1, 6} and got.count() == 2


# --- changes -------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("hot", [False, True])
def test_absent_within_equals_brute_force(spark, uneven, seed, hot):
    rnd = random.Random(seed)
    low, high = rnd.choice([(-1 * HOUR, 6 * HOUR), (200 * 60_000_000, 360 * 60_000_000), (0, 1), (-HOUR, -1)])
    us = lambda n: dt.timedelta(microseconds=n)
    left = [(rnd.randint(0, 4), T0 + us(rnd.choice([0, 1, HOUR]) * rnd.randint(0, 30)), i) for i in range(80)]
    right = []
    for _ in range(25):
        k, anchor, _i = rnd.choice(left)
        right.append((rnd.choice([k, k, 99]), anchor + us(rnd.choice([low, high]) + rnd.choice([-1, 0, 1]))))
    right += [(1, None), (None, T0)]
    want = {
        l for l in left
        if not any(k == l[0] and ts and l[1] + us(low) <= ts <= l[1] + us(high) for k, ts in right)
    }
    ldf = spark.createDataFrame(left, "k int, a timestamp_ntz, i int")
    rdf = spark.createDataFrame(right, "k int, ts timestamp_ntz")
    if hot:
        uneven()
    got = rows.absent_within(ldf, rdf, ["k"], "a", "ts", low, high)
    assert as_set(got, "k", "a", "i") == want and 0 < len(want)


def test_absent_within_needs_a_range(spark):
    with pytest.raises(ValueError):
        rows.absent_within(spark.range(1), spark.range(1), ["id"], "id", "id", 5, 5)


def test_append_absent_twice_is_once(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, code string")
    new = spark.createDataFrame([(1, "b", 5), (2, "b", 5), (3, "b", 5)], "k int, code string, extra int")
    once = changes.append_absent(base, new, ["k", "code"])
    assert as_set(once) == {(1, "a"), (2, "b"), (1, "b"), (3, "b")}
    assert as_set(changes.append_absent(once, new, ["k", "code"])) == as_set(once)
    any_row = changes.append_absent(base, new, ["k"])
    assert as_set(any_row) == {(1, "a"), (2, "b"), (3, "b")}
    only_a = changes.append_absent(base, new, ["k"], F.col("code") == "a")
    assert only_a.count() == 4


def test_update_from(spark, uneven):
    base = spark.createDataFrame([(1, "x", 10), (1, "y", 10), (2, "x", 10), (3, "x", None)], "k int, s string, v int")
    new = spark.createDataFrame([(1, 78), (1, 77), (3, 99)], "k int, nv int")
    want = {(1, "x", 77), (1, "y", 10), (2, "x", 10), (3, "x", 99)}
    update = lambda: changes.update_from(base, new, ["k"], {"v": F.col("nv")}, F.col("s") == "x")
    assert as_set(update()) == want
    uneven()
    assert as_set(update()) == want


def test_update_from_a_table_with_the_same_names(spark):
    base = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, v int")
    new = spark.createDataFrame([(1, 11), (3, 33), (4, 44)], "id int, v int")
    assert as_set(changes.update_from(base, new, ["id"], ["v"])) == {(1, 11), (2, 20), (3, 33)}
    larger = F.greatest(F.col("v"), F.col("new.v") - 5)
    assert as_set(changes.update_from(base, new, ["id"], {"v": larger}, F.col("v").isNotNull())) == {(1, 10), (2, 20), (3, None)}


def test_raise_first_value(spark):
    lac = codes.LACTATE
    labs = spark.createDataFrame(
        [(1, T0, lac, 1.8), (1, T0, 7, 2.0), (1, T0, lac, 5.0), (1, T0 + H, lac, 1.0), (1, T0 - H, 7, 1.0),
         (2, T0, lac, None), (3, T0, lac, 1.0)],
        "hadm int, ts timestamp_ntz, itemid int, v double",
    )
    chosen = spark.createDataFrame([(1,), (2,), (2,)], "hadm int")
    run = lambda re: [
        r.v
        for r in changes.raise_first_value(
            labs, chosen, "hadm", "ts", "v", F.col("itemid") == lac, 4.0, 4.3, re
        ).orderBy("hadm", "ts", F.col("itemid").desc(), "v").collect()
    ]
    assert run(False) == [1.0, 4.3, 5.0, 4.3, 1.0, 4.3, 1.0]
    assert run(True) == [1.0, 4.3, 5.0, 2.0, 1.0, 4.3, 1.0]


# --- stricter readings ---------------------------------------------------------


def test_extensions(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 2), (2, 1), (1, 1), (1, NULL), (NULL, 1) AS v(a, b)")
    assert [r[0] for r in df.select(extensions.ordered_before("a", "b")).collect()] == [1, 0, 1, 1, 0]
    doses = spark.createDataFrame([(1, 1000.0), (1, 1100.0), (2, 100.0), (3, 1.0)], "k int, ml double")
    weights = spark.createDataFrame([(1, 70.0), (2, 70.0), (3, 0.0)], "k int, kg double")
    got = extensions.dose_per_kg(doses, weights, ["k"], "ml", "kg", 30)
    assert as_set(got, "k", "dose_reached") == {(1, 1), (2, 0), (3, 0)}
