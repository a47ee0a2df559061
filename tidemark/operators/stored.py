"""Changes written back to stored tables: update, append if absent, raise first values, stable ids.

Each returns the next version of the table and writes only the parts that hold the keys concerned.
Applied twice, each gives the same table as applied once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import append
from ..sources.versions import VersionedTable
from .changes import absent_candidates, raise_first_value, update_from
from .rows import absent
from .scale import materialise
from .strata import surrogate_ids


def _same_part(table: VersionedTable, on: Sequence[str]) -> None:
    """Rows that match on ``on`` lie in one part only if the table's keys are among them."""
    missing = set(table.keys) - set(on)
    if missing:
        raise ValueError(f"the table is stored by {table.keys}; {sorted(missing)} must be among the columns matched on")


def update_stored(
    table: VersionedTable,
    updates: DataFrame,
    on: Sequence[str],
    values: Mapping[str, Column] | Sequence[str],
    where: Column | None = None,
    name: str | None = None,
) -> VersionedTable:
    """``update_from`` on a stored table. With ``where``, or values that add up, give the change a ``name``."""
    _same_part(table, on)
    updates = materialise(updates, "updates")
    return table.change(updates, lambda base: update_from(base, updates, on, values, where), name)


def append_absent_stored(
    table: VersionedTable,
    candidates: DataFrame,
    on: Sequence[str],
    existing: Column | None = None,
    time_range: tuple[str, str, int, int] | None = None,
    name: str | None = None,
) -> VersionedTable:
    """``append_absent`` on a stored table; without fresh rows there is no new version."""
    _same_part(table, on)
    fresh = absent_candidates(table.near(candidates), candidates, on, existing, time_range)
    fresh = materialise(fresh.select(*[c for c in fresh.columns if c in table.schema.names]), "fresh")
    if fresh.isEmpty():
        return table
    return table.change(fresh, lambda base: append(base, fresh), name)


def raise_first_stored(
    table: VersionedTable,
    selected: DataFrame,
    key: str,
    ts: str,
    value: str,
    first_where: Column,
    floor: float,
    new_value: float,
    recheck: bool = False,
) -> VersionedTable:
    """``raise_first_value`` on a table stored by ``key``."""
    _same_part(table, [key])
    selected = materialise(selected.select(key).distinct(), "selected")
    return table.change(selected, lambda base: raise_first_value(base, selected, key, ts, value, first_where, floor, new_value, recheck))


def register(table: VersionedTable, rows: DataFrame, id_column: str = "id", start: int = 0) -> VersionedTable:
    """Give every key of ``rows`` that has none the next id; known keys keep theirs.

    The registry ``table`` has its key columns and ``id_column``. New ids follow the largest one, in the order
    of the keys, without gaps, and start above ``start``. Rows with a NULL in their key get no id.
    """
    keys = list(table.keys)
    asked = rows.select(*keys).dropna().distinct()
    unseen = materialise(absent(asked, table.near(asked), keys), "unseen")
    if unseen.isEmpty():
        return table
    largest = table.read().agg(F.max(id_column)).first()[0]
    new = surrogate_ids(unseen, keys, max(start, largest if largest is not None else start), id_column)
    return table.change(unseen, lambda base: append(base, new.select(*keys, F.col(id_column).cast(table.schema[id_column].dataType))))
