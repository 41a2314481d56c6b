"""Type-1 upsert: matched rows are replaced, new rows inserted, nothing is deleted."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import any_null


class AmbiguousSource(ValueError):
    """Several source rows would replace the same target row."""


def check_unique(source: DataFrame, keys: Sequence[str], *, null_safe: bool = False) -> None:
    """Raise when a key occurs more than once in the source."""
    rows = source if null_safe else source.where(~any_null(keys))
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    example = repeated.first()
    if example is not None:
        raise AmbiguousSource(f"key {[example[k] for k in keys]} occurs {example['n']} times")


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = False,
    source_is_unique: bool = False,
) -> DataFrame:
    """The target after the source was applied.

    Without a target the source becomes the table. NULL keys never match, so their rows
    are inserted, unless ``null_safe`` makes them equal (needed where a load may be
    replayed and keys can be NULL).
    """
    if not source_is_unique:
        check_unique(source, keys, null_safe=null_safe)
    if target is None:
        return source
    changed = source.select(*[F.col(k).alias(f"_new_{k}") for k in keys])

    def same(k: str) -> Column:
        old, new = F.col(k), F.col(f"_new_{k}")
        return old.eqNullSafe(new) if null_safe else old == new

    match = reduce(lambda a, b: a & b, [same(k) for k in keys])
    if null_safe:
        return target.join(changed, match, "left_anti").unionByName(source)
    # Rows without a key match nothing: they stay out of the join, where they would meet in the
    # one task that NULL hashes to.
    kept = target.where(~any_null(keys)).join(changed, match, "left_anti")
    return kept.unionByName(target.where(any_null(keys))).unionByName(source)
