"""First rows in an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def clamp(n: int, low: int, high: int) -> int:
    return max(low, min(n, high))


def top_n(
    df: DataFrame, order: Sequence[Column | str], n: int, *, low: int = 1, high: int | None = None
) -> DataFrame:
    """The first n rows, n clamped to low..high. Each task keeps only its own n candidates."""
    return df.orderBy(*order).limit(clamp(n, low, high if high is not None else max(n, low)))
