"""Month and day keys. ``as_of`` replaces the wall clock in every job."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_date(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def ym(value: Column) -> Column:
    """``yyyyMM`` text of a date. Integer arithmetic stays inside generated code."""
    return (F.year(value) * 100 + F.month(value)).cast("string")


def date_key(value: Column) -> Column:
    """``yyyyMMdd`` text of a date."""
    return (F.year(value) * 10000 + F.month(value) * 100 + F.day(value)).cast("string")


def month_start(as_of: date | None, back: int) -> Column:
    """First day of the month ``back`` months before ``as_of``."""
    return F.trunc(F.add_months(as_of_date(as_of), -back), "MM")


def ym_back(as_of: date | None, back: int) -> Column:
    """``yyyyMM`` of the month ``back`` months before ``as_of``; folds to a constant."""
    return ym(month_start(as_of, back))


def month_window(key: Column, as_of: date | None, back: int | None) -> Column:
    """True for month keys of the trailing window; ``back=None`` keeps all history.

    The bound folds to a literal, so on a table partitioned by the key it prunes.
    """
    return F.lit(True) if back is None else key >= ym_back(as_of, back)


def day_window(stamp: Column, as_of: date | None, back: int) -> Column:
    """True for load stamps of the last ``back`` days."""
    return stamp >= F.date_sub(as_of_date(as_of), back)


def next_month(key: Column) -> Column:
    """``yyyyMM`` shifted one month forward (202412 -> 202501)."""
    return ym(F.add_months(F.to_date(F.concat(key, F.lit("01")), "yyyyMMdd"), 1))
