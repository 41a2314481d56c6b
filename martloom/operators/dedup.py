"""De-duplication on a business key that keeps the losers, marked as such."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DUPLICATE = "_is_duplicate"
_SPLIT, _LANE = "_dedup_split", "_dedup_lane"


def survivor_order(
    columns: Sequence[str], recency: str = "_ingested_at", keep: str = "latest"
) -> list[Column]:
    """Which copy survives: the latest (or earliest) load, ties broken by all other columns.

    Rows of one load share their load time, so without the tie-break the survivor would
    change from run to run.
    """
    if keep not in ("latest", "earliest"):
        raise ValueError(f"keep must be 'latest' or 'earliest', not {keep!r}")
    first = []
    if recency in columns:
        by = F.col(recency)
        first = [by.desc_nulls_last() if keep == "latest" else by.asc_nulls_first()]
    return first + [F.col(c).asc_nulls_first() for c in columns if c != recency]


def mark_duplicates(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Add ``_is_duplicate``: false for one row per key, true for its other copies.

    NULL keys equal each other here. Rows are ranked in two steps whatever the data: first the
    copies of a key within their input split, then only the winners of the splits meet in one
    group, while the losers stay spread by their split. A key's last group so has no more rows
    than the input has splits, and one plan with one scan serves unique keys and hot ones. The
    split number is a property of the input, so a repeated task gives the same ranks; of exact
    copies, it does not matter which one stays.
    """

    def rank_over(*parts: str) -> Column:
        return F.row_number().over(Window.partitionBy(*parts).orderBy(*order))

    return (
        df.withColumn(_SPLIT, F.spark_partition_id())
        .withColumn(_LANE, F.when(rank_over(*key, _SPLIT) == 1, -1).otherwise(F.col(_SPLIT)))
        .withColumn(DUPLICATE, (F.col(_LANE) != -1) | (rank_over(*key, _LANE) > 1))
        .drop(_SPLIT, _LANE)
    )
