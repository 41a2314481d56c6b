"""Small column helpers."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(columns: Iterable[str]) -> Column:
    """True when at least one of the columns is NULL."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def money(col: Column) -> Column:
    """Two decimals, half up."""
    return F.round(col, 2)


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL for a zero divisor (plain division raises under ANSI)."""
    return F.try_divide(a, b)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.try_divide(F.lit(100) * part, whole), digits)


def month_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")
