"""Labelling: every row gets its status and the reasons it was rejected for, in one pass."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martloom.functions import any_null
from martloom.functions.casts import apply_casts
from martloom.operators.dedup import DUPLICATE, mark_duplicates, survivor_order
from martloom.session import PARQUET_OPTIONS
from martloom.sources import paths
from martloom.sources.registry import TableSpec

STATUS = "_dq_status"
# The reasons as an array, and as a text for readers without arrays.
REASONS, REASON = "_reject_reasons", "_reject_reason"
HAS_NULL = "_has_null"

# Status names, the separator inside a reason text, the duplicate reason.
VALID, REJECTED = "valid", "rejected"
SEPARATOR = "; "
DUPLICATE_REASON = "duplicate_key"
# A job that sets this to false leaves no _SUCCESS.
_MARKS_SUCCESS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"

METRICS = (
    "input_records",
    "valid_records",
    "rejected_records",
    "duplicate_records",
    "null_records",
)


def reason_text(reasons: Column) -> Column:
    return F.array_join(reasons, SEPARATOR)


def label(
    df: DataFrame,
    spec: TableSpec,
    *,
    keep: str = "latest",
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Cast, mark duplicates, apply the rules; no row is lost.

    Duplicates are ranked over all rows before any rule, so a key whose survivor is
    invalid is rejected altogether.
    """
    order = order or survivor_order(df.columns, keep=keep)
    marked = mark_duplicates(df, spec.key, order)
    typed = apply_casts(marked, spec.casts)
    # A row's copies count before its rules; an unknown verdict of a rule breaks nothing.
    verdicts = [(DUPLICATE_REASON, F.col(DUPLICATE)), *((n, F.expr(rule)) for n, rule in spec.rules)]
    named = F.array_compact(F.array(*[F.when(fails, F.lit(n)) for n, fails in verdicts]))
    # The status looks at the rules themselves, not at the names: a reader of valid rows then needs
    # no array, and the optimizer sees the filter on the rank.
    passes = reduce(Column.__and__, [~F.coalesce(fails, F.lit(False)) for _, fails in verdicts])
    labelled = typed.select(
        "*",
        F.when(passes, F.lit(VALID)).otherwise(F.lit(REJECTED)).alias(STATUS),
        named.alias(REASONS),
        reason_text(named).alias(REASON),
        any_null(spec.null_columns or spec.key).alias(HAS_NULL),
    )
    # Valid rows need no original text.
    originals = [f"{c}_raw" for c in spec.casts if f"{c}_raw" in typed.columns]
    kept = {c: F.when(F.col(STATUS) == REJECTED, F.col(c)) for c in originals}
    return labelled.withColumns(kept) if kept else labelled


def key_slices(df: DataFrame, key: Sequence[str], n: int) -> list[DataFrame]:
    """The rows in n frames, all copies of a key in one of them; they can be labelled one by one."""
    slot = F.pmod(F.xxhash64(*key), F.lit(n))
    return [df.where(slot == i) for i in range(n)] if n > 1 else [df]


def _helpers(labelled: DataFrame) -> list[str]:
    casts = [c for c in labelled.columns if f"{c}_raw" in labelled.columns]
    return [DUPLICATE, HAS_NULL, STATUS, REASONS, REASON, *(f"{c}_raw" for c in casts)]


def valid_rows(labelled: DataFrame) -> DataFrame:
    """The cleaned table: rule-passing rows, unique on the key, source columns only."""
    return labelled.where(F.col(STATUS) == VALID).drop(*_helpers(labelled))


def rejected_rows(labelled: DataFrame) -> DataFrame:
    """Rejected rows with their reasons and the text of every cast column."""
    return labelled.where(F.col(STATUS) == REJECTED).drop(DUPLICATE, HAS_NULL, STATUS)


def metric_columns() -> list[Column]:
    """The five quality counts, as aggregates over labelled rows; zero on an empty input."""
    flags = (
        F.lit(True),
        F.col(STATUS) == VALID,
        F.col(STATUS) == REJECTED,
        F.col(DUPLICATE),
        F.col(HAS_NULL),
    )
    return [F.count_if(flag).alias(name) for name, flag in zip(METRICS, flags, strict=True)]


def quality_metrics(labelled: dict[str, DataFrame]) -> DataFrame:
    """One row of counts per labelled table."""
    rows = [
        df.agg(*metric_columns()).select(F.lit(name).alias("table_name"), *METRICS)
        for name, df in labelled.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def write_labelled(
    labelled: DataFrame | Sequence[DataFrame], path: str, *, keep_schema: bool = True
) -> dict[str, int]:
    """Write valid and rejected rows side by side in one job; returns the metrics.

    Slices are written by one job each, one after the other, and ``_SUCCESS`` by the last one.
    The counts are taken in the job's last stage, which Spark counts once per task
    however often executors are lost; put no shuffle between them and the write.
    """
    slices = [labelled] if isinstance(labelled, DataFrame) else list(labelled)
    counts: Counter[str] = Counter()
    for i, part in enumerate(slices):
        seen = Observation()
        observed = part.observe(seen, *metric_columns())
        last = "true" if i == len(slices) - 1 else "false"
        writer = observed.write.mode("append" if i else "overwrite").option(_MARKS_SUCCESS, last)
        writer.options(**PARQUET_OPTIONS).partitionBy(STATUS).parquet(path)
        if missing := [name for name in METRICS if name not in seen.get]:
            raise RuntimeError(f"the write of {path} reported no {', '.join(missing)}")
        counts.update({name: seen.get[name] for name in METRICS})
    if keep_schema and not paths.glob(slices[0].sparkSession, paths.join(path, f"{STATUS}=*")):
        # A partitioned write of no rows leaves no file to read the schema from.
        slices[0].limit(0).write.mode("append").parquet(path)
    return {name: counts[name] for name in METRICS}
