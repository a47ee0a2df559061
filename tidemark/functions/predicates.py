"""Row predicates and small column builders.

Every helper returns a plain ``Column`` built from Spark's own expressions, so
filters reach the Parquet scan and stay inside whole-stage code generation.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_literal(value) -> str:
    """A Python value as SQL text of its own type."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, Decimal):
        return f"{value:f}BD"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    return repr(value)


def quoted(name: str) -> str:
    """A column name as SQL text, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def in_sql(column: str, codes: Sequence) -> str:
    """Code list membership as SQL text."""
    return f"{quoted(column)} IN ({', '.join(map(sql_literal, codes))})" if codes else "false"


def like_any_sql(columns: Sequence[str], patterns: Sequence[str]) -> str:
    """Any pattern in any of the text columns, ignoring case, as SQL text."""
    tests = [f"lower({quoted(c)}) LIKE {sql_literal(f'%{q.lower()}%')}" for q in patterns for c in columns]
    return f"({' OR '.join(tests)})" if tests else "false"


def any_of(conditions: Sequence[Column]) -> Column:
    """OR over conditions; an empty list matches nothing."""
    return reduce(or_, conditions) if conditions else F.lit(False)


def label_like(column: ColumnLike, pattern: str) -> Column:
    """Case-insensitive "label contains pattern"; ``%`` inside the pattern is a wildcard."""
    return F.lower(as_column(column)).like(f"%{pattern.lower()}%")


def contains_any(column: ColumnLike, patterns: Sequence[str]) -> Column:
    """Case-insensitive match of any pattern. A NULL label never matches in a filter."""
    return any_of([label_like(column, p) for p in patterns])


def contains_any_of(columns: Sequence[ColumnLike], patterns: Sequence[str]) -> Column:
    """Same patterns over several text columns; a NULL column simply does not match."""
    return any_of([F.coalesce(contains_any(c, patterns), F.lit(False)) for c in columns])


def include_exclude(column: ColumnLike, include: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    """Labels that match an include pattern and no exclude pattern."""
    keep = contains_any(column, include)
    return keep & ~contains_any(column, exclude) if exclude else keep


def code_in(column: ColumnLike, codes: Sequence) -> Column:
    """Code list membership; reaches Parquet as an ``In`` filter."""
    column = F.col(quoted(column)) if isinstance(column, str) else column
    return column.isin([F.lit(c) for c in codes]) if codes else F.lit(False)


def between(column: ColumnLike, low, high) -> Column:
    """Inclusive value range."""
    return as_column(column).between(low, high)


def in_period(column: ColumnLike, start, end) -> Column:
    """Half-open period ``[start, end)``."""
    c = as_column(column)
    return (c >= start) & (c < end)


def is_not_null(column: ColumnLike) -> Column:
    return as_column(column).isNotNull()


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0; NULL conditions give 0."""
    return F.when(condition, 1).otherwise(0)


def or_zero(column: ColumnLike) -> Column:
    """Missing flag counts as 0."""
    if isinstance(column, str):
        return F.expr(f"coalesce({column}, 0)")
    return F.coalesce(column, F.lit(0))


def mask(value: ColumnLike, applies: ColumnLike) -> Column:
    """Keep the value only where the step applies, NULL elsewhere."""
    if isinstance(value, str) and isinstance(applies, str):
        return F.expr(f"if({applies} = 1, {value}, NULL)")
    return F.when(as_column(applies) == 1, as_column(value))


def clamp(value: ColumnLike, low, high) -> Column:
    """Limit a value to ``[low, high]``; NULL stays NULL."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    v = as_column(value)
    return F.when(v.isNotNull(), F.greatest(low, F.least(v, high)))


def choose(selector: ColumnLike, values: Sequence) -> Column:
    """Pick ``values[selector mod n]`` for a non-negative selector."""
    index = F.pmod(as_column(selector), F.lit(len(values)))
    picked = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        picked = picked.when(index == i, F.lit(v))
    return picked


def normalise_units(code: ColumnLike, value: ColumnLike, factors: Mapping) -> Column:
    """Scale a value by the factor of its source code; unknown codes give NULL."""
    c, v = as_column(code), as_column(value)
    out = F.lit(None).cast("double")
    for k, factor in reversed(list(factors.items())):
        out = F.when(c == k, v if factor == 1 else v * F.lit(float(factor))).otherwise(out)
    return out


def source_priority(code: ColumnLike, order: Sequence) -> Column:
    """1 for the first code of the order, 2 for the second and so on; the last rank for others."""
    c = as_column(code)
    out = F.lit(len(order))
    for rank, k in reversed(list(enumerate(order[:-1], start=1))):
        out = F.when(c == k, rank).otherwise(out)
    return out
