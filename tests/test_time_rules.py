import datetime as dt

import pytest
from hypothesis import given, settings as hsettings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import timeops as t
from tidemark.operators.components import Span

H = 3_600_000_000


def cut_hours(us):
    """Elapsed whole hours, cut towards zero."""
    return int(us / H) if abs(us) < 2**52 else (abs(us) // H) * (1 if us >= 0 else -1)


@given(
    us=st.one_of(
        st.integers(-10 * H, 10 * H),
        st.builds(lambda h, d: h * H + d, st.integers(-9, 9), st.integers(-1, 1)),
    ),
    lo=st.one_of(st.none(), st.integers(-5, 5)),
    hi=st.integers(-5, 8),
)
@hsettings(max_examples=500, deadline=None)
def test_whole_hour_span_equals_cut_hours(us, lo, hi):
    start, to = Span(hi, lo).bounds_us()
    inside = us < to and (start is None or us >= start)
    hours = (abs(us) // H) * (1 if us >= 0 else -1)
    assert inside == (hours <= hi and (lo is None or hours >= lo))


def test_half_open_span():
    assert Span(3, lo=0, mode="half_open").bounds_us() == (0, 3 * H)
    assert Span(3, mode="half_open").bounds_us() == (None, 3 * H)
    with pytest.raises(ValueError):
        Span(3, mode="rounded").bounds_us()


CASES = [
    # earlier, later, whole hours, minute marks, calendar years
    ("2024-01-01 10:00:00", "2024-01-01 13:59:59", 3, 239, 0),
    ("2024-01-01 10:00:00", "2024-01-01 09:30:00", 0, -30, 0),
    ("2024-01-01 10:00:59", "2024-01-01 10:01:00", 0, 1, 0),
    ("2000-12-31 23:59:59", "2001-01-01 00:00:00", 0, 1, 1),
    ("2006-12-31 00:00:00", "2024-01-01 00:00:00", 149040, 8942400, 18),
    ("2024-01-01 10:00:00", "2024-01-01 05:00:00", -5, -300, 0),
]


def test_three_difference_rules(spark):
    df = spark.createDataFrame([c[:2] for c in CASES], "a string, b string")
    df = df.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in df.columns])
    got = df.select(
        t.whole_hours("a", "b"), t.boundary_diff("MINUTE", "a", "b"), t.years_by_calendar("a", "b")
    ).collect()
    assert [tuple(r) for r in got] == [c[2:] for c in CASES]


def test_shifts_keep_microseconds_and_type(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-02-28 23:59:59.999999' AS x")
    out = df.select(
        t.shift_us("x", 1).alias("a"),
        t.shift_us(F.col("x"), -H - 1).alias("b"),
        t.shift("x", 1, "MONTH").alias("c"),
        t.impute_time(F.lit("2024-05-06").cast("date")).alias("d"),
        t.month_key("x").alias("e"),
    )
    assert [d for _, d in out.dtypes] == ["timestamp_ntz"] * 4 + ["date"]
    r = out.first()
    assert r.a == dt.datetime(2024, 2, 29)
    assert r.b == dt.datetime(2024, 2, 28, 22, 59, 59, 999998)
    assert r.c == dt.datetime(2024, 3, 28, 23, 59, 59, 999999)
    assert r.d == dt.datetime(2024, 5, 6, 12)
    assert r.e == dt.date(2024, 2, 1)


def test_earliest_skips_null_and_keeps_all_null(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'2024-01-02', timestamp_ntz'2024-01-01'),"
        " (NULL, timestamp_ntz'2024-01-03'), (NULL, NULL) AS v(a, b)"
    )
    got = [r[0] for r in df.select(t.earliest("a", "b")).collect()]
    assert got == [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3), None]


def test_slots_cover_the_time_line(spark):
    width = 7 * H
    df = spark.range(2000).select(
        t.shift(t.ntz_literal("1969-12-30 00:00:00"), F.col("id") * 37, "MINUTE").alias("x")
    )
    slots = df.select("x", t.slot_start("x", width).alias("s")).orderBy("x").collect()
    origin = dt.datetime(1, 1, 1)
    for r in slots:
        us = (r.x - origin) // dt.timedelta(microseconds=1)
        assert r.s % width == 0 and r.s <= us < r.s + width
