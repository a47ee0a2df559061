"""Status columns, applicability masks and composites by clinical path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import mask
from .scale import skew_join


def all_done(*steps: str) -> str:
    """SQL condition: every step has its flag set; a missing flag counts as not done."""
    return " AND ".join(f"coalesce({s}, 0) = 1" for s in steps)


def by_path_sql(rules: Sequence[tuple[str | None, str]]) -> str:
    """1 if the rule of the first path that applies holds; 0 if it fails or no path applies; as SQL text.

    Rules are pairs of a path column and a SQL condition.
    """
    applies = lambda path: "true" if path is None else f"{path} = 1"
    branches = " ".join(f"WHEN {applies(path)} THEN if({rule}, 1, 0)" for path, rule in rules)
    return f"CASE {branches} ELSE 0 END"


def by_path(rules: Sequence[tuple[str | None, str]]) -> Column:
    return F.expr(by_path_sql(rules))


@dataclass(frozen=True)
class Composite:
    """A flag by path: ``rules`` pair a path column with a SQL condition; None as path means every row.

    ``gate`` names a flag that has to be set as well.
    """

    name: str
    rules: tuple[tuple[str | None, str], ...]
    gate: str | None = None

    def sql(self) -> str:
        complete = by_path_sql(self.rules)
        return complete if self.gate is None else f"if({all_done(self.gate)}, {complete}, 0)"

    def column(self) -> Column:
        return F.expr(self.sql())


def add_composites(df: DataFrame, composites: Sequence[Composite]) -> DataFrame:
    """Add the composites in order; later ones may use earlier ones. No self-joins."""
    for c in composites:
        df = df.withColumn(c.name, c.column())
    return df


def mask_components(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """NULL every component whose path column is not 1."""
    return df.withColumns({step: mask(step, path) for step, path in rules.items()})


def reconciled_sql(severe: str, shock: str, code_any: str, code_shock: str) -> tuple[str, str]:
    """What flags and codes say together about severe sepsis and about shock, as SQL text."""
    says = {k: f"coalesce({c}, 0) = 1" for k, c in
            {"severe": severe, "shock": shock, "any": code_any, "code_shock": code_shock}.items()}
    by_base = "{severe} AND NOT {shock}"
    by_code = "NOT {severe} AND {any} AND NOT {code_shock}"
    return f"if({by_base} OR {by_code}, 1, 0)".format(**says), "if({shock} OR {code_shock}, 1, 0)".format(**says)


def reconcile_status(
    base: DataFrame,
    status: DataFrame,
    on: Sequence[str],
    severe: str = "severe_sepsis",
    shock: str = "septic_shock",
    code_any: str = "sepsis_icd",
    code_shock: str = "shock_icd",
) -> DataFrame:
    """Replace the two severity flags by what flags and codes say together.

    Shock is set if either source says so. Severe without shock is set by the
    base flags, or, where the base has no severe flag, by codes without shock.
    """
    new_severe, new_shock = map(F.expr, reconciled_sql(severe, shock, code_any, code_shock))
    joined = skew_join(base, status.select(*on, code_any, code_shock), on, "left")
    return joined.withColumns({severe: new_severe, shock: new_shock}).drop(code_any, code_shock)


def cohort_summary(df: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    """One row: number of rows and number of rows per condition."""
    return df.agg(
        F.count("*").alias("cohort"),
        *[F.count(F.when(cond, 1)).alias(name) for name, cond in counts.items()],
    )


def scalar_summary(df: DataFrame, column: str, default: int = 0) -> DataFrame:
    """One row: largest value (``default`` if there is none) and number of rows."""
    return df.agg(
        F.coalesce(F.max(column), F.lit(default)).alias("max_value"), F.count("*").alias("n")
    )
