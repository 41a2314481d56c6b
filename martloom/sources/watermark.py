"""High-water marks for incremental batch loads.

The mark of a table is the largest load time processed so far. It is only ever
appended to, in one write after the data is written, so a crash between the two
repeats a load (which an upsert absorbs) and never skips one. Rows arriving late with
an older load time are not seen by the strict comparison; the streaming load in
``martloom.streaming`` tracks files instead and has no such gap.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.sources.appended import append_rows, read_rows

DDL = "table_name string, last_ingested_at timestamp_ntz"


def watermarks(spark: SparkSession, path: str) -> DataFrame:
    """The current mark per table."""
    marks = read_rows(spark, path, DDL)
    return marks.groupBy("table_name").agg(F.max("last_ingested_at").alias("last_ingested_at"))


def watermark_of(spark: SparkSession, path: str, table: str) -> datetime | None:
    row = watermarks(spark, path).where(F.col("table_name") == table).first()
    return row["last_ingested_at"] if row else None


def newer_than(df: DataFrame, mark: datetime | None, column: str = "_ingested_at") -> DataFrame:
    """Rows strictly newer than the mark; all rows on a first run."""
    return df if mark is None else df.where(F.col(column) > F.lit(mark))


def advance(
    spark: SparkSession, path: str, table: str, df: DataFrame, column: str = "_ingested_at"
) -> datetime | None:
    """Record the newest load time of the processed rows; an empty batch moves nothing."""
    newest = df.agg(F.max(F.col(column)).cast("timestamp_ntz").alias("m")).first()["m"]
    if newest is not None:
        append_rows(spark, path, [(table, newest)], DDL)
    return newest
