"""A measure as one SQL statement, so that a stored view can hold it.

Any reader of the catalog then selects the measure from the tables as they are now, without a
copied table and without this package. The text is made from the same ``MeasureSpec``, windows,
value tests, derived flags and composites as the DataFrame plans.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..functions.predicates import in_sql, quoted, sql_literal
from ..functions.timeops import SENTINEL, after_sql, years_by_calendar_sql
from ..operators.cohort import KEYS
from ..operators.components import Span, WindowFlag, component_sql, scan_texts
from ..operators.status import Composite, reconciled_sql
from .final import antibiotic_starts
from .spec import SEPSIS, MeasureSpec

_KEYS = ", ".join(KEYS)


def _step(name: str, text: str) -> str:
    return f"{name} AS (\n{text})"


def _with(columns: Mapping[str, str], source: str) -> str:
    """All columns of ``source``, some replaced or added."""
    new = ", ".join(f"{text} AS {quoted(name)}" for name, text in columns.items())
    return f"SELECT * EXCEPT ({', '.join(quoted(n) for n in columns)}), {new} FROM {source}"


def _code_flags(rules: Mapping[str, tuple[str, ...]]) -> str:
    return ", ".join(f"max(if({in_sql('icd9_code', listed)}, 1, 0)) AS {quoted(name)}" for name, listed in rules.items())


def _cohort(spec: MeasureSpec, at: Mapping[str, str]) -> list[str]:
    age = years_by_calendar_sql("dob", "admittime")
    flags = ", ".join(map(quoted, spec.path_codes))
    return [
        _step("coded", f"SELECT {_KEYS}, {_code_flags(spec.path_codes)} FROM {at['diagnoses_icd']} WHERE {in_sql('icd9_code', spec.cohort_codes)} GROUP BY {_KEYS}"),
        _step("admitted", f"SELECT DISTINCT {_KEYS}, cast(admittime AS timestamp_ntz) AS admittime FROM {at['admissions']}"),
        _step("people", f"SELECT DISTINCT subject_id, dob FROM {at['patients']}"),
        _step(
            "cohort",
            f"SELECT {_KEYS}, admittime, dob, {age} AS age_at_admission, {flags}\n"
            f"FROM admitted JOIN coded USING ({_KEYS}) JOIN people USING (subject_id) WHERE {age} >= {spec.min_age}",
        ),
    ]


def _anchored(spec: MeasureSpec, at: Mapping[str, str]) -> list[str]:
    scans = scan_texts(spec.families)
    rows = "\nUNION ALL ".join(f"SELECT {_KEYS}, {s.family} AS family, {s.time} AS ts, {s.value} AS value FROM {at[s.table]} WHERE {s.where}" for s in scans)
    firsts = ", ".join(f"min(ts) FILTER (WHERE family = {sql_literal(f)}) AS {quoted('first_' + f)}" for f in spec.onset)
    times = ", ".join(quoted("first_" + f) for f in spec.onset)
    zero = f"least({times})" if len(spec.onset) > 1 else times
    if spec.missing == "sentinel":
        zero = f"coalesce({zero}, TIMESTAMP_NTZ '{SENTINEL}')"
    return [
        _step("happened", rows),
        _step("firsts", f"SELECT {_KEYS}, {firsts} FROM happened WHERE {in_sql('family', spec.onset)} GROUP BY {_KEYS}"),
        _step("anchored", f"SELECT cohort.*, {times}, {zero} AS {quoted(spec.anchor)} FROM cohort LEFT JOIN firsts USING ({_KEYS})"),
    ]


def _flagged(spec: MeasureSpec) -> list[str]:
    anchor = quoted(spec.anchor)
    found = ", ".join(f"{component_sql(c, lambda micros: after_sql(anchor, micros))} AS {quoted(c.name)}" for c in spec.components)
    columns = ", ".join(
        f"coalesce(found.{quoted(c.name)}, 0) AS {quoted(c.name)}" if isinstance(c, WindowFlag) else f"found.{quoted(c.name)}" for c in spec.components
    )
    zero = f"(SELECT {_KEYS}, max({anchor}) AS {anchor} FROM anchored GROUP BY {_KEYS})"
    steps = [
        _step("found", f"SELECT {_KEYS}, {found} FROM happened JOIN {zero} USING ({_KEYS}) GROUP BY {_KEYS}"),
        _step("flagged", f"SELECT anchored.*, {columns} FROM anchored LEFT JOIN found USING ({_KEYS})"),
    ]
    if spec.derived:
        new = ", ".join(f"if({d.condition}, 1, 0) AS {quoted(d.name)}" for d in spec.derived)
        steps.append(_step("derived", f"SELECT *, {new} FROM flagged"))
    return steps


def _masked(spec: MeasureSpec, source: str) -> str:
    masks = {step: f"CASE WHEN {quoted(path)} = 1 THEN {quoted(step)} END" for step, path in spec.masks.items()}
    return _with(masks, source) if masks else f"SELECT * FROM {source}"


def _composites(composites: tuple[Composite, ...], source: str) -> tuple[list[str], str]:
    steps = []
    for number, c in enumerate(composites):
        steps.append(_step(f"composite_{number}", f"SELECT *, {c.sql()} AS {quoted(c.name)} FROM {source}"))
        source = f"composite_{number}"
    return steps, source


def _output(spec: MeasureSpec, source: str, at: Mapping[str, str]) -> str:
    columns = ", ".join(map(quoted, spec.columns()))
    if spec.grain == "admission":
        return f"SELECT {columns} FROM {source}"
    # One row per distinct stay; an admission without one keeps its row.
    stays = f"(SELECT DISTINCT {_KEYS}, icustay_id FROM {at['icustays']})"
    return f"SELECT {columns} FROM {source} LEFT JOIN {stays} USING ({_KEYS})"


def baseline_sql(spec: MeasureSpec, at: Mapping[str, str]) -> str:
    """The statement of ``baseline_flags``; ``at`` gives each input table's name in the catalog."""
    steps = [*_cohort(spec, at), *_anchored(spec, at), *_flagged(spec)]
    steps.append(_step("masked", _masked(spec, "derived" if spec.derived else "flagged")))
    more, last = _composites(spec.composites, "masked")
    return "WITH " + ",\n".join([*steps, *more]) + "\n" + _output(spec, last, at)


def final_sql(spec: MeasureSpec, at: Mapping[str, str], time_column: str = "startdate") -> str:
    """The statement of ``final.measure``: corrected antibiotic timing and severity, gated composites."""
    starts = replace(antibiotic_starts(time_column), name="antibiotic_start")
    step = WindowFlag("_antibiotic_started", starts.name, Span(3, lo=0, mode="half_open"))
    wider = spec.with_(families=(*spec.families, starts), components=(*spec.components, step))
    steps = [*_cohort(spec, at), *_anchored(wider, at), *_flagged(wider)]
    source = "derived" if spec.derived else "flagged"
    severe, shock = reconciled_sql("severe_sepsis", "septic_shock", "sepsis_icd", "shock_icd")
    fixed = _with({"severe_sepsis": severe, "septic_shock": shock, "antibiotics_3h": "_antibiotic_started"}, f"{source} LEFT JOIN status USING (hadm_id)")
    steps += [
        _step("status", f"SELECT hadm_id, {_code_flags(spec.code_rules)} FROM {at['diagnoses_icd']} GROUP BY hadm_id"),
        _step("fixed", f"{fixed} WHERE subject_id IS NOT NULL AND hadm_id IS NOT NULL"),
        _step("masked", _masked(spec, "fixed")),
    ]
    more, last = _composites(spec.final_composites, "masked")
    return "WITH " + ",\n".join([*steps, *more]) + "\n" + _output(spec, last, at)


def create_view(
    spark: SparkSession, name: str, schema: str, spec: MeasureSpec = SEPSIS, final: bool = True, time_column: str = "startdate"
) -> DataFrame:
    """Store the measure over the tables of ``schema`` as view ``name`` in the catalog."""
    at = {table: f"{quoted(schema)}.{quoted(table)}" for table in spec.tables()}
    text = final_sql(spec, at, time_column) if final else baseline_sql(spec, at)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS\n{text}")
    return spark.table(name)
