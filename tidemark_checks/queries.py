"""Queries over the test tables, one or more per operator.

Each takes ``(spark, sf_dir)`` and reads whole tables. The clinical ones use the
encounter tables derived from ``events`` and ``customer``.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import predicates as p
from tidemark.functions import timeops as t
from tidemark.functions.hashing import hash_mod, stable_hash
from tidemark.operators import changes, cohort, components, discovery, extensions, rows, status, strata
from tidemark.operators.components import Span, WindowFlag, WindowValue
from tidemark.operators.status import Composite
from tidemark.sources.tables import (
    append,
    export_snapshot,
    literal_rows,
    load_tables,
    publish_table,
    publish_view,
    read_snapshot,
)
from tidemark.operators import stored
from tidemark.operators.scale import materialise, scratch
from tidemark.plans import baseline, bundles, codes, explore, final, refresh, view
from tidemark.plans.groups import Group, choose_groups, mark_groups
from tidemark.plans.spec import SEPSIS, MeasureSpec
from tidemark.sources import checked, layout, versions

from .encounters import clinical_tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
KEYS = list(cohort.KEYS)
BY_ADMISSION = SEPSIS.with_(grain="admission")


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _raw(spark: SparkSession, sf_dir: str, *names: str):
    tables = load_tables(spark, sf_dir, names)
    return [tables[n] for n in names]


def without_sentinel(df: DataFrame, column: str = "sepsis_time_zero") -> DataFrame:
    """NULL instead of the far-future time, for readers whose dates end earlier."""
    return df.withColumn(column, F.nullif(F.col(column), t.sentinel()))


# --- discovery -----------------------------------------------------------------


@query
def concept_search(spark, sf_dir):
    (part,) = _raw(spark, sf_dir, "part")
    found = discovery.find_concepts(
        part, "p_name", ["RED", "blue"], ["bolt"], ["p_partkey", "p_name", "p_type"]
    )
    return rows.sort_output(found, "p_name", "p_partkey")


@query
def concept_search_wildcards(spark, sf_dir):
    (part,) = _raw(spark, sf_dir, "part")
    return discovery.find_concepts(part, "p_name", ["re% b%t", "s%l%ring"], [], ["p_name", "p_brand"])


@query
def concept_search_all_rows(spark, sf_dir):
    (part,) = _raw(spark, sf_dir, "part")
    return discovery.find_concepts(part, "p_name", ["widget"], [], ["p_name", "p_type"], distinct=False)


@query
def concept_counts(spark, sf_dir):
    lineitem, part = _raw(spark, sf_dir, "lineitem", "part")
    used = lineitem.withColumnRenamed("l_partkey", "p_partkey")
    counts = discovery.concept_counts(used, part, "p_partkey", "p_name", ["ring"], ["small"])
    return rows.sort_output(counts, "n", descending=True)


@query
def label_codes(spark, sf_dir):
    lineitem, part = _raw(spark, sf_dir, "lineitem", "part")
    facts = lineitem.withColumnRenamed("l_partkey", "p_partkey")
    labelled = discovery.label_codes(facts, part.select("p_partkey", "p_name"), "p_partkey")
    return labelled.select("l_orderkey", "l_linenumber", "p_partkey", "p_name", "l_quantity")


@query
def coded_admissions(spark, sf_dir):
    orders, lineitem, part = _raw(spark, sf_dir, "orders", "lineitem", "part")
    found = discovery.admissions_by_description(
        orders.select("o_orderkey", "o_custkey", "o_orderdate"),
        lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey")),
        part.select("p_partkey", "p_name", "p_type"),
        "p_name", ["red", "small ring"], "p_partkey", ["o_orderkey"],
    )
    return rows.sort_output(found, "o_orderdate", "o_orderkey", "p_partkey")


def _inventory(spark, sf_dir, dedup):
    (part,) = _raw(spark, sf_dir, "part")
    return discovery.alias_inventory(
        part, ["p_name", "p_type", "p_brand"], ["economy", "brand#1", "red", "large", "s%g"], dedup
    )


@query
def alias_inventory(spark, sf_dir):
    return _inventory(spark, sf_dir, True)


@query
def alias_inventory_counts(spark, sf_dir):
    return _inventory(spark, sf_dir, False)


@query
def value_sample(spark, sf_dir):
    labs = clinical_tables(spark, sf_dir)["labevents"]
    return discovery.sample_events(
        labs, "itemid", codes.LACTATE, 200, ["charttime", "event_id"],
        ["hadm_id", "charttime", "itemid", "valuenum", "valueuom"],
    )


def _cultures_with_gaps(spark, sf_dir):
    """Every fifth culture has a date but no time."""
    (events,) = _raw(spark, sf_dir, "events")
    errors = events.where("event_type = 'error'")
    return errors.select(
        F.col("user_id").alias("subject_id"),
        F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("charttime"),
        F.col("ts").cast("date").alias("chartdate"),
    )


@query
def first_event(spark, sf_dir):
    return cohort.first_event(_cultures_with_gaps(spark, sf_dir), ["subject_id"], "charttime", "chartdate")


@query
def first_event_top(spark, sf_dir):
    return cohort.first_event(
        clinical_tables(spark, sf_dir)["microbiologyevents"], KEYS, "charttime", "chartdate", k=100
    )


# --- cohort and time zero ------------------------------------------------------


@query
def nearest_measurement(spark, sf_dir):
    """Weight next to the start of each encounter's first ICU stay."""
    tables = clinical_tables(spark, sf_dir)
    firsts = tables["icustays"].groupBy(*KEYS).agg(F.min(F.struct("intime", "icustay_id")).alias("s"))
    best = cohort.nearest_measurement(
        firsts.select(*KEYS, "s.*"),
        tables["weights"].drop("subject_id"),
        on=["hadm_id"], partition=["icustay_id"], anchor_ts="intime", event_ts="charttime",
        factors={codes.WEIGHT_KG: 1, codes.WEIGHT_LB: codes.KG_PER_LB},
        bounds=codes.WEIGHT_RANGE_KG, tie_break=["event_id"],
    )
    return best.select(*KEYS, "icustay_id", "intime", "charttime", "weight_kg")


@query
def adult_cohort(spark, sf_dir):
    tables = clinical_tables(spark, sf_dir)
    return cohort.with_stays(baseline.cohort(tables), tables["icustays"]).drop("dob")


@query
def adult_cohort_by_admission(spark, sf_dir):
    tables = clinical_tables(spark, sf_dir)
    return cohort.with_stays(baseline.cohort(tables), tables["icustays"], "admission").drop("dob")


@query
def time_zero(spark, sf_dir):
    anchored = baseline.anchored_cohort(clinical_tables(spark, sf_dir))
    return without_sentinel(
        anchored.select(*KEYS, "first_culture", "first_antibiotic", "sepsis_time_zero")
    )


@query
def time_zero_null(spark, sf_dir):
    """Flags when a missing time zero is NULL: nothing is on time without one."""
    spec = SEPSIS.with_(missing="null")
    tables = clinical_tables(spark, sf_dir)
    flagged = baseline.with_components(tables, baseline.anchored_cohort(tables, spec), spec)
    return flagged.select(*KEYS, "sepsis_time_zero", "lactate_measured_3h", "vasopressors_administered_6h")


# --- components ----------------------------------------------------------------


#: A measure of other admissions, anchored at the first culture, a missing culture time counting as its date.
PRESSURE_CARE = MeasureSpec(
    cohort_codes=("4019", "0389"),
    path_codes={"hypertension": ("4019",), "septicemia": ("0389",)},
    families=(
        replace(SEPSIS.family("culture"), fallback_column="chartdate"),
        *(SEPSIS.family(f) for f in ("pressure", "vasopressor", "lactate")),
    ),
    onset=("culture",),
    components=(
        WindowFlag("high_pressure_24h", "pressure", Span(24, lo=0, mode="half_open"), test=(">=", 60)),
        WindowFlag("low_pressure_24h", "pressure", Span(24, lo=0, mode="half_open"), test=("<=", 30)),
        WindowFlag("vasopressor_12h", "vasopressor", Span(12)),
        WindowFlag("lactate_above_2", "lactate", Span(24), test=(">", 2)),
    ),
    masks={"vasopressor_12h": "septicemia"},
    composites=(
        Composite("treated", (("septicemia", status.all_done("vasopressor_12h")), ("hypertension", "high_pressure_24h = 0"))),
        Composite("steady", ((None, "high_pressure_24h + low_pressure_24h = 0"),), gate="treated"),
    ),
    anchor="first_culture_time",
    missing="null",
    grain="admission",
)

#: The sepsis measure with both stricter readings as steps of its 3-hour bundle.
STRICT = BY_ADMISSION.with_(
    families=(*SEPSIS.families, components.EventFamily("weight", "weights", "charttime", "itemid", (226512,), value_column="valuenum")),
    components=(
        *SEPSIS.components,
        WindowValue("fluid_ml_3h", "fluid", Span(3), agg="sum"),
        WindowValue("weight_kg", "weight", Span(1000), agg="max"),
    ),
    derived=(
        components.happened_before("culture_first", "culture", "antibiotic"),
        components.dose_reached("enough_fluid", "fluid_ml_3h", "weight_kg", 2),
    ),
    composites=(Composite("strict_3h", ((None, status.all_done("blood_culture_3h", "culture_first", "enough_fluid")),)),),
    output=(*KEYS, "fluid_ml_3h", "weight_kg", "culture_first", "enough_fluid", "strict_3h"),
)


@query
def other_measure(spark, sf_dir):
    return baseline.baseline_flags(clinical_tables(spark, sf_dir), PRESSURE_CARE)


@query
def strict_measure(spark, sf_dir):
    found = baseline.baseline_flags(clinical_tables(spark, sf_dir), STRICT)
    return found.withColumn("fluid_ml_3h", F.round("fluid_ml_3h", 6))


@query
def family_events(spark, sf_dir):
    """Events of every family of the measure per day, with their values."""
    events = components.event_relation(clinical_tables(spark, sf_dir), [*SEPSIS.families, _final_starts()])
    per_day = events.groupBy("family", F.to_date("ts").alias("day"))
    return per_day.agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))


def _final_starts():
    return replace(final.antibiotic_starts("startts"), name="antibiotic_start")


@query
def window_flags(spark, sf_dir):
    tables = clinical_tables(spark, sf_dir)
    flagged = baseline.with_components(tables, baseline.anchored_cohort(tables))
    return flagged.select(*KEYS, *[c.name for c in SEPSIS.components])


@query
def window_values(spark, sf_dir):
    """Largest and first lactate value up to 3 whole hours after time zero."""
    tables = clinical_tables(spark, sf_dir)
    wanted = [
        WindowValue("max_lactate", "lactate", Span(3)),
        WindowValue("first_lactate", "lactate", Span(3), agg="first"),
    ]
    anchored = materialise(baseline.anchored_cohort(tables).select(*KEYS, "sepsis_time_zero"), "anchored")
    events = components.event_relation(tables, [SEPSIS.family("lactate")])
    found = components.window_components(events, anchored, wanted, "sepsis_time_zero")
    return components.attach_components(anchored, found, wanted).drop("sepsis_time_zero")


@query
def half_open_flags(spark, sf_dir):
    tables = clinical_tables(spark, sf_dir)
    anchored = materialise(baseline.anchored_cohort(tables).select(*KEYS, "sepsis_time_zero"), "anchored")
    found = final.antibiotic_within_3h(anchored, tables["prescriptions"], "sepsis_time_zero", "startts")
    step = WindowFlag("antibiotics_3h", "antibiotic", Span(3, lo=0, mode="half_open"))
    return components.attach_components(anchored, found, [step]).drop("sepsis_time_zero")


# --- status and composites -----------------------------------------------------


@query
def code_status(spark, sf_dir):
    diagnoses = clinical_tables(spark, sf_dir)["diagnoses_icd"]
    return cohort.coded_status(diagnoses, ["hadm_id"], SEPSIS.code_rules, "icd9_code")


def _stale_base(tables):
    """Base flags from every second stay only, so that they disagree with the codes."""
    base = tables["icustays"].groupBy(*KEYS).agg(
        F.max((F.col("icustay_id") % 8 == 0).cast("int")).alias("severe_sepsis"),
        F.max(F.when(F.col("icustay_id") % 3 != 1, (F.col("icustay_id") % 3 == 0).cast("int"))).alias(
            "septic_shock"
        ),
    )
    return base


@query
def reconcile_status(spark, sf_dir):
    tables = clinical_tables(spark, sf_dir)
    rules = SEPSIS.code_rules
    codes_say = cohort.coded_status(tables["diagnoses_icd"], ["hadm_id"], rules, "icd9_code")
    return status.reconcile_status(_stale_base(tables), codes_say, ["hadm_id"])


@query
def masked_components(spark, sf_dir):
    tables = clinical_tables(spark, sf_dir)
    flagged = baseline.with_components(tables, baseline.anchored_cohort(tables))
    masked = status.mask_components(flagged, SEPSIS.masks)
    return masked.select(*KEYS, "severe_sepsis", "septic_shock", *SEPSIS.masks)


@query
def composites(spark, sf_dir):
    """All three composites with and without the 3-hour gate on the 6-hour bundle."""
    tables = clinical_tables(spark, sf_dir)
    flagged = baseline.with_components(tables, baseline.anchored_cohort(tables))
    both = status.add_composites(flagged, bundles.BASELINE_COMPOSITES).withColumn(
        "gated_6h", bundles.composite_6h("bundle_complete_3h")
    )
    return both.select(
        *KEYS, "bundle_complete_3h", "bundle_complete_6h", "bundle_complete_overall", "gated_6h"
    )


@query
def baseline_flags(spark, sf_dir):
    return without_sentinel(baseline.baseline_flags(clinical_tables(spark, sf_dir)))


@query
def baseline_flags_by_admission(spark, sf_dir):
    return without_sentinel(baseline.baseline_flags(clinical_tables(spark, sf_dir), BY_ADMISSION))


def _final(spark, sf_dir):
    return final.measure(clinical_tables(spark, sf_dir), BY_ADMISSION, time_column="startts")


@query
def final_flags(spark, sf_dir):
    return without_sentinel(_final(spark, sf_dir))


@query
def cohort_summary(spark, sf_dir):
    one = lambda c: F.col(c) == 1
    return status.cohort_summary(
        _final(spark, sf_dir),
        {
            "pass3": one("bundle_complete_3h"),
            "shock": one("septic_shock"),
            "pass6": one("bundle_complete_6h"),
        },
    )


# --- strata --------------------------------------------------------------------


@query
def period_cohort(spark, sf_dir):
    orders, lineitem = _raw(spark, sf_dir, "orders", "lineitem")
    lines = lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    found = strata.period_cohort(
        orders,
        coded=lines.where(p.flag(F.col("l_returnflag") == "R") == 1),
        events=lines.where(F.col("l_linestatus") == "F"),
        key="o_orderkey", admit_ts="o_orderdate", event_ts="l_shipdate",
        period=(t.ntz_literal("1996-01-01"), t.ntz_literal("1998-04-01")),
        offset=(0, 365), unit="DAY", carry=["o_custkey"], alias="first_ship",
    )
    return found


def _orders_by_month(spark, sf_dir):
    (orders,) = _raw(spark, sf_dir, "orders")
    return orders.select("o_orderkey", t.month_key("o_orderdate").alias("month_key"))


# Any rates will do: percent, width of the range, salt.
PASS3 = strata.RateSpec("p_pass3", 38, 31, 101)
SHOCK = strata.RateSpec("p_shock", 29, 22, 202)
PASS6 = strata.RateSpec("p_pass6", 51, 19, 303)


def _rates(by_month):
    return strata.stratum_rates(by_month, "month_key", [PASS3, SHOCK, PASS6])


@query
def stratum_rates(spark, sf_dir):
    return _rates(_orders_by_month(spark, sf_dir))


@query
def hash_rank(spark, sf_dir):
    ranked = strata.hash_rank(_orders_by_month(spark, sf_dir), "month_key", "o_orderkey", 5150)
    return ranked.select("o_orderkey", "month_key", "rn", "cnt")


def _selected_shock(by_month):
    return strata.select_fraction(
        by_month, "month_key", "o_orderkey", _rates(by_month), "p_shock", 5150, jitter_salt=31
    )


@query
def select_fraction(spark, sf_dir):
    return _selected_shock(_orders_by_month(spark, sf_dir))


@query
def select_nested(spark, sf_dir):
    by_month = _orders_by_month(spark, sf_dir)
    return strata.select_nested(
        by_month, _selected_shock(by_month), "month_key", "o_orderkey", _rates(by_month), "p_pass6",
        6160, jitter_salt=32,
    )


# Two groups share a salt, so one is part of the other within a month.
GROUPS = {
    "pass3": Group("p_pass3", 5150, 33),
    "shock": Group("p_shock", 5150, 31),
    "pass6": Group("p_pass6", 6160, 32, within="shock"),
}


def _grouped(spark, sf_dir):
    by_month = _orders_by_month(spark, sf_dir)
    chosen = choose_groups(by_month, "month_key", "o_orderkey", _rates(by_month), GROUPS)
    return mark_groups(by_month, "o_orderkey", chosen)


@query
def group_flags(spark, sf_dir):
    return _grouped(spark, sf_dir)


@query
def group_summary(spark, sf_dir):
    """Size of the cohort and of its groups, in one row."""
    return status.cohort_summary(_grouped(spark, sf_dir), {g: F.col(g) == 1 for g in GROUPS})


@query
def surrogate_ids(spark, sf_dir):
    (orders,) = _raw(spark, sf_dir, "orders")
    largest = status.scalar_summary(orders, "o_orderkey", 1_000_000).select("max_value").scalar()
    ids = strata.surrogate_ids(
        orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], largest + 100
    )
    return ids.select("o_orderkey", "new_id")


@query
def month_grid(spark, sf_dir):
    """As many numbered rows per month as a tenth of its orders, at least one, with new ids."""
    by_month = _orders_by_month(spark, sf_dir)
    months = by_month.groupBy("month_key").agg(F.count("*").alias("cnt"))
    cells = strata.grid(months, F.expr("greatest(1, cnt div 10)")).drop("cnt")
    largest = status.scalar_summary(by_month, "o_orderkey", 1_000_000).select("max_value").scalar()
    return strata.surrogate_ids(cells, ["month_key", "n"], largest + 100)


@query
def scalar_summary(spark, sf_dir):
    (orders,) = _raw(spark, sf_dir, "orders")
    return status.scalar_summary(orders, "o_orderkey", 1_000_000)


# --- changes -------------------------------------------------------------------


def _coded_admissions(tables, code):
    coded = tables["diagnoses_icd"].where(F.col("icd9_code") == code)
    return rows.present(tables["admissions"], coded, KEYS)


@query
def append_absent(spark, sf_dir):
    """Cultures shortly after admission for severe cases that have none."""
    tables = clinical_tables(spark, sf_dir)
    time = t.shift("admittime", 12 + hash_mod(17, "hadm_id", 41), "MINUTE")
    candidates = _coded_admissions(tables, codes.SEVERE_SEPSIS).select(
        *KEYS, F.lit(codes.BLOOD_CULTURE).alias("spec_itemid"), time.alias("charttime"),
        time.cast("date").alias("chartdate"),
    )
    return changes.append_absent(tables["microbiologyevents"], candidates, ["hadm_id"])


@query
def append_absent_code(spark, sf_dir):
    """Shock codes for admissions with a culture that lack this code."""
    tables = clinical_tables(spark, sf_dir)
    candidates = (
        tables["microbiologyevents"].select(*KEYS).distinct()
        .withColumn("icd9_code", F.lit(codes.SEPTIC_SHOCK))
    )
    return changes.append_absent(tables["diagnoses_icd"], candidates, ["hadm_id", "icd9_code"])


@query
def append_absent_range(spark, sf_dir):
    """Fluids for admissions without any from 1 hour before to 6 hours after admission."""
    tables = clinical_tables(spark, sf_dir)
    candidates = tables["admissions"].select(
        *KEYS, "admittime",
        t.shift("admittime", 95 + hash_mod(50, "hadm_id", 44), "MINUTE").alias("charttime"),
        p.choose(stable_hash("hadm_id", 45), list(codes.FLUIDS)).alias("itemid"),
        F.lit(1000.0).alias("valuenum"),
    )
    return changes.append_absent(
        tables["chartevents"].drop("event_id"),
        candidates,
        ["hadm_id"],
        p.code_in("itemid", codes.FLUIDS),
        ("admittime", "charttime", *changes.hours_around(-1, 6)),
    )


@query
def drug_names(spark, sf_dir):
    """Antibiotic spellings in all prescriptions, with the number of times each occurs."""
    return explore.antibiotic_names(clinical_tables(spark, sf_dir), dedup=False)


@query
def drug_names_found(spark, sf_dir):
    """The same spellings, each once."""
    return explore.antibiotic_names(clinical_tables(spark, sf_dir))


@query
def blood_specimens(spark, sf_dir):
    return explore.blood_specimens(clinical_tables(spark, sf_dir))


@query
def sepsis_admissions(spark, sf_dir):
    return explore.sepsis_admissions(clinical_tables(spark, sf_dir))


@query
def lactate_items(spark, sf_dir):
    return explore.lactate_items(clinical_tables(spark, sf_dir))


@query
def lactate_counts(spark, sf_dir):
    return explore.lactate_counts(clinical_tables(spark, sf_dir))


@query
def lactate_sample(spark, sf_dir):
    return explore.lactate_sample(clinical_tables(spark, sf_dir))


@query
def first_cultures(spark, sf_dir):
    return explore.first_cultures(clinical_tables(spark, sf_dir))


@query
def weight_items(spark, sf_dir):
    return explore.weight_items(clinical_tables(spark, sf_dir))


@query
def pressure_items(spark, sf_dir):
    return explore.pressure_items(clinical_tables(spark, sf_dir))


@query
def crystalloid_items(spark, sf_dir):
    return explore.crystalloid_items(clinical_tables(spark, sf_dir))


@query
def vasopressor_items(spark, sf_dir):
    return explore.vasopressor_items(clinical_tables(spark, sf_dir))


@query
def nearest_weights(spark, sf_dir):
    """Weights at the stay they belong to: that of their admission with the same remainder."""
    tables = clinical_tables(spark, sf_dir)
    stays = tables["icustays"].groupBy(*KEYS).agg(F.max("icustay_id").alias("icustay_id"))
    weighed = tables["weights"].join(stays, KEYS).select("icustay_id", "charttime", "itemid", "valuenum")
    # One reading per stay and time, so that ties cannot vary.
    single = weighed.groupBy("icustay_id", "charttime").agg(F.min(F.struct("itemid", "valuenum")).alias("r"))
    return explore.nearest_weights(
        {"icustays": tables["icustays"], "chartevents": single.select("icustay_id", "charttime", "r.*")}
    )


@query
def append_rows(spark, sf_dir):
    """Two tables of different width as one."""
    tables = clinical_tables(spark, sf_dir)
    labs = tables["labevents"].drop("event_id")
    return append(labs, tables["weights"].drop("event_id"))


@query
def update_from_join(spark, sf_dir):
    """Open orders take the date of their first shipment, a day later."""
    orders, lineitem = _raw(spark, sf_dir, "orders", "lineitem")
    firsts = rows.first_time(
        lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], "l_shipdate", "first_ship"
    )
    return changes.update_from(
        orders.select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice"),
        firsts, ["o_orderkey"],
        {"o_orderdate": t.shift("first_ship", 1, "DAY")},
        F.col("o_orderstatus") == "O",
    )


def _day_labs(tables):
    """All lab rows at day precision with two item codes, so that first times have ties."""
    return tables["labevents"].select(
        "event_id", "hadm_id", F.col("charttime").cast("date").alias("chartday"),
        p.choose("event_id", [codes.LACTATE, codes.LACTATE + 1]).alias("itemid"), "valuenum",
    )


def _raised(spark, sf_dir, recheck):
    tables = clinical_tables(spark, sf_dir)
    return changes.raise_first_value(
        _day_labs(tables), _coded_admissions(tables, codes.SEPTIC_SHOCK), "hadm_id", "chartday",
        "valuenum", F.col("itemid") == codes.LACTATE, 4.0, 4.3, recheck,
    )


@query
def raise_first_value(spark, sf_dir):
    return _raised(spark, sf_dir, False)


@query
def raise_first_value_rechecked(spark, sf_dir):
    return _raised(spark, sf_dir, True)


@query
def rows_at_first(spark, sf_dir):
    labs = _day_labs(clinical_tables(spark, sf_dir))
    return rows.rows_at_first(labs, ["hadm_id"], "chartday", F.col("itemid") == codes.LACTATE)


@query
def present_absent(spark, sf_dir):
    """Customers with orders but without any open one."""
    customer, orders = _raw(spark, sf_dir, "customer", "orders")
    by_customer = orders.withColumnRenamed("o_custkey", "c_custkey")
    buyers = rows.present(customer, by_customer, ["c_custkey"])
    return rows.absent(buyers, by_customer, ["c_custkey"], F.col("o_orderstatus") == "O").select(
        "c_custkey", "c_name"
    )


# --- column functions ----------------------------------------------------------


@query
def time_functions(spark, sf_dir):
    (events,) = _raw(spark, sf_dir, "events")
    day = F.col("ts").cast("date")
    start = t.ntz_literal("2024-01-15 06:30:30")
    return events.select(
        "event_id",
        t.whole_hours(start, "ts").alias("hours"),
        t.boundary_diff("MINUTE", start, "ts").alias("minutes"),
        t.boundary_diff("HOUR", start, "ts").alias("hour_marks"),
        t.boundary_diff("DAY", start, "ts").alias("days"),
        t.years_by_calendar(F.date_sub(day, 20), "ts").alias("years"),
        t.month_key("ts").alias("month_key"),
        t.impute_time(day).alias("noon"),
        t.shift("ts", F.col("event_id") % 97, "MINUTE").alias("later"),
        t.shift_us("ts", -t.HOUR_US).alias("hour_before"),
        t.earliest(t.impute_time(day), "ts").alias("earliest"),
    )


@query
def value_functions(spark, sf_dir):
    (lines,) = _raw(spark, sf_dir, "lineitem")
    code = F.col("l_linenumber")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        p.normalise_units(code, "l_quantity", {1: 1, 2: 0.5, 3: 2}).alias("scaled"),
        p.source_priority(code, [2, 1, 3]).alias("priority"),
        p.clamp(F.col("l_quantity") - 25, -10, 10).alias("clamped"),
        p.choose("l_orderkey", ["a", "b", "c"]).alias("chosen"),
        p.mask(F.col("l_quantity"), p.flag(F.col("l_returnflag") == "R")).alias("masked"),
        p.or_zero(p.mask(code, p.flag(code > 3))).alias("defaulted"),
        p.flag(p.between("l_quantity", 10, 20)).alias("in_range"),
        p.flag(p.in_period("l_shipdate", t.ntz_literal("1997-01-01"), t.ntz_literal("1998-01-01"))).alias(
            "in_1997"
        ),
        p.flag(p.is_not_null(p.mask(code, p.flag(code == 1)))).alias("known"),
        F.concat(F.upper("l_returnflag"), F.lit("-"), F.lower("l_linestatus")).alias("tag"),
        F.abs(F.floor(F.col("l_quantity") / 3) - 8).cast("int").alias("third"),
    )


@query
def hash_functions(spark, sf_dir):
    (orders,) = _raw(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    return orders.select(
        "o_orderkey",
        stable_hash("o_orderkey", day, 7).alias("hash"),
        hash_mod(60, "o_orderkey", 1).alias("below_60"),
    )


@query
def text_filters(spark, sf_dir):
    """Patterns over two text columns, one of them NULL for every third row."""
    (part,) = _raw(spark, sf_dir, "part")
    sparse = part.withColumn("alt", F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")))
    hits = sparse.where(p.contains_any_of(["p_name", "alt"], ["bolt", "PROMO"]))
    return hits.where(p.code_in("p_size", [1, 2, 3, 5, 8, 13, 21, 34])).select("p_partkey", "p_name", "alt")


@query
def literal_lookup(spark, sf_dir):
    """Rows of a small table given in the program text, joined with nations."""
    nation, customer = _raw(spark, sf_dir, "nation", "customer")
    wanted = literal_rows(spark, [(1, "first"), (2, "second"), (3, "third")], "n_regionkey int, note string")
    named = nation.withColumn("n_regionkey", F.col("n_regionkey").cast("int")).join(wanted, "n_regionkey")
    per_nation = customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return named.join(per_nation, "n_nationkey").select("n_nationkey", "n_name", "note", "n")


# --- publishing ----------------------------------------------------------------


@query
def published_view(spark, sf_dir):
    publish_view(_final(spark, sf_dir), "bundle_flags_final")
    return without_sentinel(spark.sql("SELECT * FROM bundle_flags_final"))


def _snapshot(spark, sf_dir, fmt):
    table = without_sentinel(_final(spark, sf_dir))
    path = scratch(spark, "snapshot")
    export_snapshot(table, path, fmt)
    return read_snapshot(spark, path, table.schema, fmt)


@query
def snapshot_parquet(spark, sf_dir):
    return _snapshot(spark, sf_dir, "parquet")


@query
def snapshot_csv(spark, sf_dir):
    return _snapshot(spark, sf_dir, "csv")


@query
def materialised_twice(spark, sf_dir):
    """A written intermediate that two branches read."""
    labs = clinical_tables(spark, sf_dir)["labevents"]
    per_key = materialise(labs.groupBy(*KEYS).agg(F.max("valuenum").alias("top"), F.count("*").alias("n")))
    high = per_key.where("top >= 4").select(*KEYS, F.lit("high").alias("level"), "n")
    low = per_key.where("top < 4").select(*KEYS, F.lit("low").alias("level"), "n")
    return high.unionByName(low)


@query
def published_table(spark, sf_dir):
    """The final table as a catalog table, read by another session."""
    name = f"bundle_flags_final_{uuid.uuid4().hex}"
    publish_table(_final(spark, sf_dir), name)
    return without_sentinel(spark.newSession().table(name))


@query
def update_same_names(spark, sf_dir):
    """Parts take the price of a table with the same column names; odd keys only, where it is higher."""
    (part,) = _raw(spark, sf_dir, "part")
    prices = part.where("p_partkey % 2 = 1").selectExpr("p_partkey", "if(p_partkey % 3 = 0, p_retailprice - 5, p_retailprice + 5) AS p_retailprice")
    dearer = F.col("new.p_retailprice") > F.col("p_retailprice")
    return changes.update_from(part.select("p_partkey", "p_retailprice"), prices, ["p_partkey"], ["p_retailprice"], dearer)


@query
def hash_rank_null_stratum(spark, sf_dir):
    """Orders of a tenth of the customers have no stratum and are ranked as one."""
    (orders,) = _raw(spark, sf_dir, "orders")
    loose = orders.select("o_orderkey", F.when(F.col("o_custkey") % 10 != 0, F.col("o_orderpriority")).alias("priority"))
    return strata.hash_rank(loose, "priority", "o_orderkey", 77).select("o_orderkey", "priority", "rn", "cnt")


@query
def final_flags_by_stay(spark, sf_dir):
    return without_sentinel(final.measure(clinical_tables(spark, sf_dir), time_column="startts"))


# --- stricter readings ---------------------------------------------------------


@query
def ordered_before(spark, sf_dir):
    anchored = baseline.anchored_cohort(clinical_tables(spark, sf_dir))
    return anchored.select(
        *KEYS, extensions.ordered_before("first_culture", "first_antibiotic").alias("culture_first")
    )


@query
def dose_per_kg(spark, sf_dir):
    tables = clinical_tables(spark, sf_dir)
    fluids = tables["chartevents"].where(p.code_in("itemid", codes.FLUIDS))
    weights = tables["weights"].where("itemid = 226512 AND valuenum BETWEEN 30 AND 300")
    per_key = weights.groupBy(*KEYS).agg(F.max("valuenum").alias("weight_kg"))
    doses = fluids.withColumn("ml", (F.col("valuenum") * 100).cast("bigint"))
    found = extensions.dose_per_kg(doses, per_key, KEYS, "ml", "weight_kg", 30)
    return found.select(*KEYS, "total_dose", "dose_reached")


# --- stored tables -------------------------------------------------------------


def _place(spark) -> str:
    return scratch(spark, "stored")


@query
def bucketed_flags(spark, sf_dir):
    """The baseline on event tables stored by admission; keys of more than 30 events lie beside the buckets."""
    tables = clinical_tables(spark, sf_dir)
    name = f"bucketed_{uuid.uuid4().hex}"
    events = ("microbiologyevents", "prescriptions", "labevents", "chartevents")
    held = {n: layout.store(tables[n], f"{name}_{n}", KEYS, 8, uneven_rows=30) for n in events}
    others = {n: tables[n] for n in ("admissions", "patients", "diagnoses_icd", "icustays")}
    return without_sentinel(baseline.baseline_flags(held | others, BY_ADMISSION))


@query
def refreshed_flags(spark, sf_dir):
    """Two thirds of all events first, the rest in two batches, the second one given twice."""
    tables = clinical_tables(spark, sf_dir)
    events = ("microbiologyevents", "prescriptions", "labevents", "chartevents")
    third = lambda n, k: tables[n].where(F.pmod(F.xxhash64(*tables[n].columns), F.lit(6)).isin(k))
    live = refresh.start({n: third(n, [0, 1, 2, 3]) if n in events else tables[n] for n in BY_ADMISSION.tables()}, _place(spark), BY_ADMISSION, 16)
    for name, rest in (("a", [4]), ("b", [5]), ("b", [5])):
        live = refresh.refresh(live, {n: third(n, rest) for n in events}, name)
    return without_sentinel(live.flags.read())


@query
def stored_update(spark, sf_dir):
    """The update of ``update_from_join`` on a stored table, run twice."""
    orders, lineitem = _raw(spark, sf_dir, "orders", "lineitem")
    firsts = rows.first_time(lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], "l_shipdate", "first_ship")
    table = versions.create(orders.select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice"), _place(spark), ["o_orderkey"], 16)
    for _ in range(2):
        table = stored.update_stored(table, firsts, ["o_orderkey"], {"o_orderdate": t.shift("first_ship", 1, "DAY")}, F.col("o_orderstatus") == "O")
    return versions.open_table(spark, table.path).read()


@query
def stored_append(spark, sf_dir):
    """The cultures of ``append_absent`` added to a stored table, run twice."""
    tables = clinical_tables(spark, sf_dir)
    time = t.shift("admittime", 12 + hash_mod(17, "hadm_id", 41), "MINUTE")
    candidates = _coded_admissions(tables, codes.SEVERE_SEPSIS).select(
        *KEYS, F.lit(codes.BLOOD_CULTURE).alias("spec_itemid"), time.alias("charttime"), time.cast("date").alias("chartdate")
    )
    table = versions.create(tables["microbiologyevents"], _place(spark), ["hadm_id"], 16)
    for _ in range(2):
        table = stored.append_absent_stored(table, candidates, ["hadm_id"])
    return versions.open_table(spark, table.path).read()


@query
def registered_ids(spark, sf_dir):
    """Ids of customers in three rounds: odd ones, all, all again; known ids stay."""
    (customer,) = _raw(spark, sf_dir, "customer")
    table = versions.create(spark.createDataFrame([], "c_custkey long, id long"), _place(spark), ["c_custkey"], 16)
    for some in (customer.where("c_custkey % 2 = 1"), customer, customer):
        table = stored.register(table, some, start=100)
    return table.read()


@query
def stored_view(spark, sf_dir):
    """The final table as a view in the catalog, read by another session; no copy of its rows."""
    tables = clinical_tables(spark, sf_dir)
    schema = f"view_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    for name in BY_ADMISSION.tables():
        tables[name].write.saveAsTable(f"{schema}.{name}")
    view.create_view(spark, f"{schema}.bundle_flags_final", schema, BY_ADMISSION, time_column="startts")
    return without_sentinel(spark.newSession().table(f"{schema}.bundle_flags_final"))


def _dirty_events(spark, sf_dir):
    """Events as text, some times and values spoilt."""
    (events,) = _raw(spark, sf_dir, "events")
    return events.selectExpr(
        "event_id",
        "CASE WHEN event_id % 97 = 5 THEN 'no time' WHEN event_id % 97 = 6 THEN '' WHEN event_id % 97 = 7 THEN NULL ELSE concat(' ', date_format(ts, 'yyyy-MM-dd HH:mm:ss')) END AS ts",
        "if(event_id % 89 = 3, 'n/a', cast(event_id % 1000 AS string)) AS value",
        "event_type",
    )


_EVENT_TYPES = {"ts": "timestamp_ntz", "value": "int"}


@query
def refused_rows(spark, sf_dir):
    found = checked.checked(_dirty_events(spark, sf_dir), _EVENT_TYPES, ["ts"]).refused
    return found.select("event_id", F.array_join("reasons", ", ").alias("reasons"))


@query
def accepted_rows(spark, sf_dir):
    """Rows that passed, typed, counted and added up per event type."""
    good = checked.checked(_dirty_events(spark, sf_dir), _EVENT_TYPES, ["ts"]).good
    return good.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.min("ts").alias("first_ts"))
