"""The cleaned layer: every source labelled, written once, with its quality counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from martloom.operators.label import key_slices, label, rejected_rows, valid_rows, write_labelled
from martloom.sources import paths
from martloom.sources.raw import parallel
from martloom.sources.registry import CLEANED, TableSpec

# A table is labelled in slices of its keys, so that its shuffles never hold all of its rows: of so
# many bytes of its raw files, but in no more than MOST_SLICES, as each scans the raw files again.
SLICE_BYTES, MOST_SLICES = 1 << 25, 12


def labelled_slices(spark: SparkSession, raw: str, spec: TableSpec, *, keep: str = "latest") -> list[DataFrame]:
    """A landed table, labelled, in slices to be written one after the other."""
    n = min(MOST_SLICES, 1 + paths.size(spark, raw) // SLICE_BYTES)
    return [label(rows, spec, keep=keep) for rows in key_slices(spark.read.parquet(raw), spec.key, n)]


def clean_tables(
    spark: SparkSession,
    raw_tables: str,
    out_dir: str,
    *,
    keep: str = "latest",
    tables: Iterable[str] = tuple(CLEANED),
    specs: Mapping[str, TableSpec] = CLEANED,
) -> dict[str, dict[str, int]]:
    """Label and write cleaned tables; returns the metrics per table."""

    def clean(spec: TableSpec):
        def job():
            slices = labelled_slices(spark, paths.join(raw_tables, spec.name), spec, keep=keep)
            return write_labelled(slices, paths.join(out_dir, spec.name))

        return job

    return parallel(spark, {name: clean(specs[name]) for name in tables})


def read_valid(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    return valid_rows(spark.read.parquet(paths.join(out_dir, table)))


def read_rejected(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    return rejected_rows(spark.read.parquet(paths.join(out_dir, table)))
