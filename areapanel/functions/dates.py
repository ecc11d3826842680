"""Month arithmetic (G4, G5, G7, H7, B15). Months are ``DATE`` values on the first day."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_diff(d1: Column | str, d2: Column | str) -> Column:
    """``(year1 - year2) * 12 + (month1 - month2)``, ignoring the day."""
    d1, d2 = _c(d1), _c(d2)
    return (F.year(d1) - F.year(d2)) * 12 + (F.month(d1) - F.month(d2))


def months_elapsed(end: Column | str, start: Column | str) -> Column:
    """Whole months from ``start`` to ``end`` counting the day of month, as
    calendar-month deltas do: a month is complete when the day-of-month is
    reached, or when ``end`` is the last day of a shorter month."""
    end, start = _c(end), _c(start)
    base = month_diff(end, start)
    short_fwd = (F.dayofmonth(end) < F.dayofmonth(start)) & (end != F.last_day(end))
    short_back = (F.dayofmonth(end) > F.dayofmonth(start)) & (start != F.last_day(start))
    return F.when((end >= start) & short_fwd, base - 1) \
        .when((end < start) & short_back, base + 1) \
        .otherwise(base)


def month_start(c: Column | str) -> Column:
    """First day of the month of a date or timestamp, as DATE."""
    return F.trunc(_c(c).cast("date"), "MM")


def year_month_date(year: Column | str, month: Column | str) -> Column:
    """First-of-month date from year and month numbers; month 13 raises (ANSI)."""
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), F.lit(1))


def to_month_date(c: Column | str, fmt: str | None = None) -> Column:
    """H7: parse text to a DATE; a bare 4-digit year becomes 1 January of it."""
    c = _c(c)
    s = c.cast("string")
    parsed = F.to_date(s, fmt) if fmt else F.to_date(s)
    return F.when(s.rlike(r"^\d{4}$"), F.make_date(s.cast("int"), F.lit(1), F.lit(1))).otherwise(parsed)


def date_literal(value: str | _dt.date) -> Column:
    """A constant DATE column."""
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.to_date(F.lit(value))
