"""Splitting a cohort into reproducible groups with a given share per stratum."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import materialise
from ..operators.strata import select_fraction, select_nested


@dataclass(frozen=True)
class Group:
    """Share ``rate`` of each stratum, picked with ``salt``; ``within`` names the group to pick from.

    Groups with the same salt are nested: the smaller is part of the larger.
    """

    rate: str
    salt: int
    jitter_salt: int | None = None
    within: str | None = None


def choose_groups(
    cohort: DataFrame,
    stratum: str,
    id_column: str,
    rates: DataFrame,
    groups: Mapping[str, Group],
    method: str = "md5",
) -> dict[str, DataFrame]:
    """Rows of each group. A group named in ``within`` has to come first; it is written once."""
    chosen: dict[str, DataFrame] = {}
    used = {g.within for g in groups.values()}
    for name, g in groups.items():
        args = (stratum, id_column, rates, g.rate, g.salt, g.jitter_salt, method)
        if g.within is None:
            rows = select_fraction(cohort, *args)
        else:
            rows = select_nested(cohort, chosen[g.within], *args)
        if name in used:
            rows = materialise(rows, name)
        chosen[name] = rows
    return chosen


def mark_groups(cohort: DataFrame, id_column: str, chosen: Mapping[str, DataFrame]) -> DataFrame:
    """Cohort with one 0/1 column per group, by a single join on the id."""
    members = reduce(
        DataFrame.unionByName,
        [rows.select(id_column, F.lit(name).alias("_group")) for name, rows in chosen.items()],
    )
    flags = members.groupBy(id_column).agg(
        *[F.expr(f"max(if(_group = '{name}', 1, 0)) AS {name}") for name in chosen]
    )
    marked = cohort.join(flags, id_column, "left")
    return marked.withColumns({name: F.expr(f"coalesce({name}, 0)") for name in chosen})
