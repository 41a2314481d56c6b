"""Append-only tables of control rows: run log, quality history, watermarks, commits."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martloom.sources import paths

# Appended files that are folded into one.
FOLD_FILES = 40
# Microseconds, so that a time read back equals the time written.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def control_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A handful of rows as one partition, handed over as an Arrow table."""
    schema = T.StructType.fromDDL(ddl)
    table = pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows])
    return spark.createDataFrame(table, schema=schema).coalesce(1)


def _folds(spark: SparkSession, path: str) -> list[int]:
    marks = paths.glob(spark, paths.join(f"{path}.folded", "*", "_SUCCESS"))
    return sorted(int(m.rsplit("/", 2)[1]) for m in marks)


def current_folder(spark: SparkSession, path: str) -> str:
    """Where the rows are: the newest complete fold, or the table's folder before the first one."""
    folds = _folds(spark, path)
    return paths.join(f"{path}.folded", f"{folds[-1]:08d}") if folds else path


def append_frame(rows: DataFrame, path: str) -> None:
    """Append a frame's rows as JSON lines; see ``append_rows``."""
    spark = rows.sparkSession
    folder = current_folder(spark, path)
    rows.write.mode("append").options(**JSON_TIMES).json(folder)
    if len(paths.glob(spark, paths.join(folder, "part-*"))) > FOLD_FILES:
        fold(spark, path)


def append_rows(spark: SparkSession, path: str, rows: Sequence[tuple], ddl: str) -> None:
    """Append rows as one JSON-lines file, so that an append is all or nothing.

    After ``FOLD_FILES`` appends the files are folded into one. One writer at a time.
    """
    append_frame(control_rows(spark, rows, ddl), path)


def fold(spark: SparkSession, path: str) -> None:
    """Write all rows anew as one file. It counts once it is complete (``_SUCCESS``); the files
    before it stay for those who are reading them, and may be deleted."""
    folder, folds = current_folder(spark, path), _folds(spark, path)
    following = paths.join(f"{path}.folded", f"{(folds[-1] if folds else 0) + 1:08d}")
    # Lines are copied as they are, whatever their columns.
    spark.read.text(folder).where("value <> ''").coalesce(1).write.mode("overwrite").text(following)


def read_rows(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The appended rows; blank lines are skipped, a table never written to is empty."""
    folder = current_folder(spark, path)
    if not paths.exists(spark, folder):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).options(**JSON_TIMES).json(folder)
