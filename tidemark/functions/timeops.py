"""Time arithmetic.

Three difference rules occur in practice and give different numbers at the
edges, so each has its own name:

* ``whole_hours``      elapsed hours, cut towards zero (3 h 59 m -> 3, -30 m -> 0)
* ``boundary_diff``    number of unit boundaries crossed (10:00:59 -> 10:01:00 is 1 minute)
* ``years_by_calendar`` difference of the calendar years
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .predicates import ColumnLike, as_column

#: Stand-in time for "no qualifying event".
SENTINEL = "9999-12-31 00:00:00"
_ORIGIN = "0001-01-01 00:00:00"
HOUR_US = 3_600_000_000


def ntz(value: ColumnLike | str) -> Column:
    """Cast a column to a timestamp without time zone."""
    return as_column(value).cast("timestamp_ntz")


def ntz_literal(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def sentinel() -> Column:
    return ntz_literal(SENTINEL)


def whole_hours(start: ColumnLike, end: ColumnLike) -> Column:
    """Elapsed hours from start to end, cut towards zero."""
    return F.timestamp_diff("HOUR", as_column(start), as_column(end))


def boundary_diff(unit: str, start: ColumnLike, end: ColumnLike) -> Column:
    """Number of ``unit`` boundaries between start and end.

    Counted from a common origin before any data, where cutting towards zero
    equals rounding down.
    """
    origin = ntz_literal(_ORIGIN)
    tick = lambda c: F.timestamp_diff(unit, origin, ntz(c))
    return tick(end) - tick(start)


def years_by_calendar(earlier: ColumnLike, later: ColumnLike) -> Column:
    """Age rule: difference of the calendar years, whatever the month and day."""
    if isinstance(earlier, str) and isinstance(later, str):
        return F.expr(years_by_calendar_sql(earlier, later))
    return F.year(as_column(later)) - F.year(as_column(earlier))


def years_by_calendar_sql(earlier: str, later: str) -> str:
    return f"(year({later}) - year({earlier}))"


def shift(column: ColumnLike, amount: Column | int, unit: str) -> Column:
    """Move a timestamp by ``amount`` units; the amount may be a column."""
    amount = amount if isinstance(amount, Column) else F.lit(amount)
    return F.timestamp_add(unit, amount, as_column(column))


def after_sql(column: str, micros: int) -> str:
    """``column`` moved by a constant number of microseconds, as SQL text."""
    sign = "-" if micros < 0 else ""
    seconds, rest = divmod(abs(micros), 1_000_000)
    return f"{column} + make_dt_interval(0, 0, 0, {sign}{seconds}.{rest:06d})"


def shift_us(column: ColumnLike, micros: int) -> Column:
    """Move a timestamp by a constant number of microseconds."""
    if isinstance(column, str):
        return F.expr(after_sql(column, micros))
    return column + F.expr(after_sql("", micros).removeprefix(" + "))


def slot_start(column: ColumnLike, width_us: int) -> Column:
    """Start of the fixed time slot a timestamp falls in, in microseconds from the origin."""
    micros = F.timestamp_diff("MICROSECOND", ntz_literal(_ORIGIN), as_column(column))
    return micros - F.pmod(micros, F.lit(width_us))


def impute_time(date_column: ColumnLike, hours: int = 12) -> Column:
    """Give a date-only event a time of day (noon by default)."""
    t = ntz(date_column)
    return shift_us(t, hours * HOUR_US) if hours else t


def month_key(column: ColumnLike) -> Column:
    """First day of the month, as a date."""
    c = as_column(column)
    return F.make_date(F.year(c), F.month(c), F.lit(1))


def earliest(*columns: ColumnLike) -> Column:
    """Smallest non-NULL time; NULL only if all are NULL."""
    cols = [as_column(c) for c in columns]
    return F.least(*cols) if len(cols) > 1 else cols[0]
