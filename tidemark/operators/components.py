"""Care steps inside a time window around an anchor time.

A component is data: which event family, which window, which value test. All
components of a measure are computed together, in one pass over the events.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import in_sql, like_any_sql, or_zero, quoted, sql_literal
from ..functions.timeops import HOUR_US, after_sql, sentinel
from ..sources.layout import Stored
from .cohort import KEYS
from .scale import materialise, skew_join


@dataclass(frozen=True)
class EventFamily:
    """Where the events of one kind come from.

    Rows are chosen by ``codes`` in ``code_column`` or by ``patterns`` in any of
    ``text_columns``. A date-only time gets ``noon_hours`` added.
    """

    name: str
    table: str
    time_column: str
    code_column: str | None = None
    codes: tuple = ()
    text_columns: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    value_column: str | None = None
    noon_hours: int | None = None
    #: Date that counts where the time is missing.
    fallback_column: str | None = None

    def where(self) -> str:
        """Condition that picks the family's rows, as SQL text."""
        if self.code_column:
            return in_sql(self.code_column, self.codes)
        return like_any_sql(self.text_columns, self.patterns)

    def time(self) -> str:
        """Time of an event; text that is no time counts as missing, so that one dirty row does not end a job."""
        moment = f"try_cast({quoted(self.time_column)} AS timestamp_ntz)"
        if self.fallback_column:
            moment = f"coalesce({moment}, try_cast({quoted(self.fallback_column)} AS timestamp_ntz))"
        if self.noon_hours:
            moment += f" + make_dt_interval(0, {self.noon_hours})"
        return moment

    def value(self) -> str:
        return f"try_cast({quoted(self.value_column) if self.value_column else 'NULL'} AS double)"

    def source(self) -> tuple:
        """Families with the same source can be read in one scan."""
        return (self.table, self.time_column, self.fallback_column, self.noon_hours, self.value_column, self.code_column)


@dataclass(frozen=True)
class Span:
    """Hours after the anchor; ``lo=None`` means no lower limit.

    ``whole_hours``: the elapsed hours, cut towards zero, lie in ``lo .. hi``
    (both in). Up to 3 thus means before 4:00:00, and 3 to 6 means 3:00:00 up to
    before 7:00:00. ``half_open``: ``lo <= elapsed < hi``.
    """

    hi: int
    lo: int | None = None
    mode: str = "whole_hours"

    def bounds_us(self) -> tuple[int | None, int]:
        """The span as half-open microseconds ``[from, to)`` relative to the anchor."""
        if self.mode == "half_open":
            return (None if self.lo is None else self.lo * HOUR_US), self.hi * HOUR_US
        if self.mode != "whole_hours":
            raise ValueError(f"unknown mode {self.mode!r}")
        to = (self.hi + 1) * HOUR_US if self.hi >= 0 else self.hi * HOUR_US + 1
        if self.lo is None:
            return None, to
        start = self.lo * HOUR_US if self.lo > 0 else (self.lo - 1) * HOUR_US + 1
        return start, to


@dataclass(frozen=True)
class WindowFlag:
    """1 if any event of the family lies in the span (and its value passes the test).

    ``test`` is a comparison and a limit, as ``(">=", 4)``; ``value_below`` is short for ``("<", limit)``.
    """

    name: str
    family: str
    span: Span
    value_below: float | None = None
    test: tuple[str, float] | None = None

    def value_test(self, value: str = "value") -> str | None:
        """The test as SQL over ``value``; None without a test."""
        sign, limit = self.test or ("<", self.value_below)
        if sign not in ("<", "<=", ">", ">=", "="):
            raise ValueError(f"unknown comparison {sign!r}")
        return None if limit is None else f"{value} {sign} {sql_literal(limit)}"


@dataclass(frozen=True)
class WindowValue:
    """A value in the span: its maximum (``max``), sum (``sum``) or that of the first event (``first``)."""

    name: str
    family: str
    span: Span
    agg: str = "max"


Component = WindowFlag | WindowValue


@dataclass(frozen=True)
class Derived:
    """A 0/1 flag that follows from other columns of the row: SQL over components and first times."""

    name: str
    condition: str


def happened_before(name: str, first: str, then: str) -> Derived:
    """Onset family ``first`` occurred, and ``then`` did not occur earlier."""
    a, b = quoted(f"first_{first}"), quoted(f"first_{then}")
    return Derived(name, f"{a} IS NOT NULL AND coalesce({a} <= {b}, true)")


def dose_reached(name: str, dose: str, weight: str, threshold: float) -> Derived:
    """Component ``dose`` is at least ``threshold`` per unit of component ``weight``."""
    return Derived(name, f"{quoted(weight)} > 0 AND {quoted(dose)} / {quoted(weight)} >= {sql_literal(threshold)}")


def add_derived(df: DataFrame, derived: Sequence[Derived]) -> DataFrame:
    return df.withColumns({d.name: F.expr(f"if({d.condition}, 1, 0)") for d in derived}) if derived else df


def event_parts(
    tables: Mapping[str, DataFrame | Stored],
    families: Sequence[EventFamily],
    keys: Sequence[str] = KEYS,
    value_tests: Mapping[str, Sequence[WindowFlag]] | None = None,
) -> list[DataFrame]:
    """Events of the families as rows (keys, family, ts, value), one DataFrame per scan."""
    return [rows for rows, _ in event_scans(tables, families, keys, value_tests)]


def event_scans(
    tables: Mapping[str, DataFrame | Stored],
    families: Sequence[EventFamily],
    keys: Sequence[str] = KEYS,
    value_tests: Mapping[str, Sequence[WindowFlag]] | None = None,
) -> list[tuple[DataFrame, bool]]:
    """Events of the families, one DataFrame per scan, and whether it is stored by ``keys``.

    Families that share a table and use separate codes are read in one scan;
    their filters, value limits included, go down to the scan.
    """
    scans = []
    for scan in scan_texts(families, value_tests):
        table = tables[scan.table]
        sources = [(table, False)]
        if isinstance(table, Stored):
            sources = [(table.even, table.keys == tuple(keys)), (table.uneven, False)]
        for source, dealt in sources:
            rows = source.where(scan.where).selectExpr(*keys, f"{scan.family} AS family", f"{scan.time} AS ts", f"{scan.value} AS value")
            scans.append((rows, dealt))
    return scans


@dataclass(frozen=True)
class ScanText:
    """One scan of an event table as SQL text: which rows, and their family, time and value."""

    table: str
    where: str
    family: str
    time: str
    value: str


def scan_texts(families: Sequence[EventFamily], value_tests: Mapping[str, Sequence[WindowFlag]] | None = None) -> list[ScanText]:
    """The scans that give the events of the families; families of one table with separate codes share one."""
    value_tests = value_tests or {}

    def chosen(f: EventFamily) -> str:
        tests = " OR ".join(c.value_test(f.value()) for c in value_tests.get(f.name, ()))
        return f"({f.where()} AND ({tests}))" if tests else f.where()

    parts: list[list[EventFamily]] = []
    for f in families:
        for part in parts:
            codes = {c for g in part for c in g.codes}
            if f.code_column and part[0].source() == f.source() and codes.isdisjoint(f.codes):
                part.append(f)
                break
        else:
            parts.append([f])

    texts = []
    for part in parts:
        head, *others = part
        name = sql_literal(head.name)
        for f in others:
            name = f"if({f.where()}, {sql_literal(f.name)}, {name})"
        texts.append(ScanText(head.table, " OR ".join(chosen(f) for f in part), name, head.time(), head.value()))
    return texts


def event_relation(
    tables: Mapping[str, DataFrame | Stored],
    families: Sequence[EventFamily],
    keys: Sequence[str] = KEYS,
    value_tests: Mapping[str, Sequence[WindowFlag]] | None = None,
) -> DataFrame:
    """All events of the families in one DataFrame."""
    return reduce(DataFrame.unionByName, event_parts(tables, families, keys, value_tests))


def family_value_tests(components: Sequence[Component]) -> dict[str, list[WindowFlag]]:
    """Families all of whose components test the value, with these, for filtering before the join."""
    by_family: dict[str, list[Component]] = {}
    for c in components:
        by_family.setdefault(c.family, []).append(c)
    tested = lambda c: isinstance(c, WindowFlag) and c.value_test() is not None
    return {f: listed for f, listed in by_family.items() if all(map(tested, listed))}


def _bound_name(micros: int) -> str:
    return f"_at_{micros}".replace("-", "m")


def from_first_times(components: Sequence[WindowFlag], anchor: str) -> dict[str, Column]:
    """Flags without a lower limit need only the family's first time, no join."""
    out = {}
    for c in components:
        start, to = c.span.bounds_us()
        if start is not None or not isinstance(c, WindowFlag) or c.value_test() is not None:
            raise ValueError(f"{c.name} needs more than the first time")
        out[c.name] = F.expr(f"if(first_{c.family} < {after_sql(anchor, to)}, 1, 0)")
    return out


def component_sql(c: Component, limit: Callable[[int], str]) -> str:
    """Aggregate over (family, ts, value) that gives the component, as SQL text; ``limit`` names a time by its microseconds."""
    start, to = c.span.bounds_us()
    inside = f"family = '{c.family}' AND ts < {limit(to)}"
    if start is not None:
        inside += f" AND ts >= {limit(start)}"
    if isinstance(c, WindowFlag):
        if c.value_test() is not None:
            inside += f" AND {c.value_test()}"
        return f"max(if({inside}, 1, 0))"
    if c.agg in ("max", "sum"):
        return f"{c.agg}(value) FILTER (WHERE {inside})"
    if c.agg == "first":
        return f"min_by(value, struct(ts, value)) FILTER (WHERE {inside} AND value IS NOT NULL)"
    raise ValueError(f"unknown aggregate {c.agg!r}")


def window_components(
    events: DataFrame | Sequence[DataFrame],
    anchors: DataFrame,
    components: Sequence[Component],
    anchor: str,
    keys: Sequence[str] = KEYS,
    dealt: Sequence[DataFrame] = (),
) -> DataFrame:
    """All components per key, for keys that have at least one event.

    ``events`` may be one table or the parts of it. ``anchors`` may repeat a key,
    always with the same anchor time. The window limits are computed once per
    anchor, so an event row costs plain time comparisons. Hot keys are split by
    the join; the aggregate that follows merges inside each task before anything is
    shuffled again. Parts in ``dealt`` are stored by the keys: they meet the limits where they lie.
    """
    parts = [events] if isinstance(events, DataFrame) else list(events)
    bounds = [c.span.bounds_us() for c in components]
    marks = sorted({m for pair in bounds for m in pair if m is not None})
    zero = anchors.groupBy(*keys).agg(F.max(anchor).alias(anchor))
    limits = zero.selectExpr(*keys, anchor, *[f"{after_sql(anchor, m)} AS {_bound_name(m)}" for m in marks])
    # A written table behind a comparison: from such a side Spark makes a Bloom filter of the keys, which drops
    # the events of all other keys in their scans. Keys without an anchor time have no window and go here.
    limits = materialise(limits, "limits").where(F.col(anchor) <= sentinel()).drop(anchor)
    met = [part.join(limits, list(keys)) for part in dealt]
    met += [skew_join(reduce(DataFrame.unionByName, parts), limits, keys).select(*met[0].columns)] if met and parts else []
    joined = reduce(DataFrame.unionByName, met) if met else skew_join(reduce(DataFrame.unionByName, parts), limits, keys)

    aggregates = [F.expr(component_sql(c, _bound_name)).alias(c.name) for c in components]
    return joined.groupBy(*keys).agg(*aggregates)


def attach_components(
    cohort: DataFrame, found: DataFrame, components: Sequence[Component], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Cohort rows with the component columns; no event at all means flag 0 and value NULL."""
    out = cohort.join(found, list(keys), "left")
    return out.withColumns({c.name: or_zero(c.name) for c in components if isinstance(c, WindowFlag)})
