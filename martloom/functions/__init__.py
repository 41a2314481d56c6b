"""Column expressions shared by the operators."""

from martloom.functions.casts import to_double, to_int, to_timestamp
from martloom.functions.columns import any_null, money, month_of, percent, ratio

__all__ = [
    "any_null",
    "money",
    "month_of",
    "percent",
    "ratio",
    "to_double",
    "to_int",
    "to_timestamp",
]
