"""Keeping a stored measure up to date: new rows recompute only their own admissions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from ..operators.cohort import KEYS
from ..operators.rows import absent, present
from ..operators.scale import materialise
from ..sources.tables import append
from ..sources.versions import VersionedTable, create
from .baseline import baseline_flags
from .spec import SEPSIS, MeasureSpec


@dataclass(frozen=True)
class LiveMeasure:
    """Input tables stored by admission, patients, and the measure's rows computed from them."""

    tables: Mapping[str, VersionedTable]
    patients: DataFrame
    flags: VersionedTable
    spec: MeasureSpec = SEPSIS


def start(tables: Mapping[str, DataFrame], path: str, spec: MeasureSpec = SEPSIS, parts: int = 64) -> LiveMeasure:
    """Store the inputs and compute the measure once in full."""
    names = [n for n in spec.tables() if n != "patients"]
    stored = {n: create(tables[n], f"{path}/{n}", KEYS, parts) for n in names}
    inputs = {n: t.read() for n, t in stored.items()} | {"patients": tables["patients"]}
    flags = create(baseline_flags(inputs, spec), f"{path}/flags", KEYS, parts)
    return LiveMeasure(stored, tables["patients"], flags, spec)


def refresh(live: LiveMeasure, batch: Mapping[str, DataFrame], name: str) -> LiveMeasure:
    """The measure with the rows of ``batch`` (by table) added.

    Time zero, windows and composites of an admission depend on its own rows only, so the
    admissions named in the batch are computed anew from all they have, late events that move time zero
    included, and replace their old rows. Parts without such an admission are not read. ``name`` tells
    batches apart: one that was stopped half way is finished by running it again, one that was applied is left out.
    """
    batch = {n: materialise(rows, f"batch-{n}") for n, rows in batch.items()}
    tables = dict(live.tables)
    for n, rows in batch.items():
        tables[n] = tables[n].change(rows, lambda base, rows=rows: append(base, rows), name)
    keys = reduce(DataFrame.unionByName, [rows.select(*KEYS) for rows in batch.values()])
    keys = materialise(keys.dropna().distinct(), "touched")
    inputs = {n: present(t.near(keys), keys, KEYS) for n, t in tables.items()}
    fresh = baseline_flags(inputs | {"patients": live.patients}, live.spec)
    flags = live.flags.change(keys, lambda base: absent(base, keys, KEYS).unionByName(fresh), name)
    return LiveMeasure(tables, live.patients, flags, live.spec)
