"""Reading rejected rows: reason counts, samples, the latest state of appended rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import any_null
from martloom.operators.label import REASON, REASONS, SEPARATOR
from martloom.operators.topn import top_n


def reason_counts(rejected: DataFrame) -> DataFrame:
    """Rows per single reason; a row with two reasons counts for both."""
    # Combinations are few, so count them first and explode only the counts.
    combined = rejected.groupBy(_reasons(rejected).alias("reasons")).agg(F.count("*").alias("rows"))
    single = combined.select(F.explode("reasons").alias("reason"), "rows")
    return single.groupBy("reason").agg(F.sum("rows").alias("rows"))


def _reasons(rejected: DataFrame) -> Column:
    """The array of reasons; rows that were written without one have it in their text."""
    if REASONS in rejected.columns:
        return F.col(REASONS)
    return F.array_remove(F.split(REASON, SEPARATOR), "")


def reason_combinations(rejected: DataFrame) -> DataFrame:
    """Rows per full reason text."""
    return rejected.groupBy(REASON).agg(F.count("*").alias("rows"))


def rejected_sample(rejected: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """The first n rejects in a given order, times as ISO text."""
    if not 1 <= n <= 200:
        raise ValueError(f"n must lie in 1..200, not {n}")
    times = {
        f.name: F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss.SSS")
        for f in rejected.schema
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    sample = top_n(rejected, [F.col(c).asc_nulls_first() for c in order], n)
    return sample.withColumns(times) if times else sample


def latest_rejects(
    rejects: DataFrame, key: Sequence[str], batch: str = "_batch_id"
) -> DataFrame:
    """Of rejects appended batch by batch, the rows of each key's newest batch.

    NULL keys match nothing, as in an upsert: all their rows stay, and take no part in the
    shuffles. The newest batch per key is combined map-side; a key with many rejected
    copies is split by the adaptive skew join, as the other side has one row per key.
    """
    has_key = ~any_null(key)
    newest = rejects.where(has_key).groupBy(*key).agg(F.max(batch).alias(batch))
    current = rejects.where(has_key).join(newest, [*key, batch], "left_semi")
    return current.unionByName(rejects.where(~has_key))
