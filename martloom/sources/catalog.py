"""Catalog tables, for users who keep their layers in a metastore."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def save_table(
    df: DataFrame, name: str, *, partition_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Create or replace a Parquet table with the frame's schema.

    With a path the table is external and its files lie there. The frame must not read
    the table it replaces.
    """
    if partition_by:
        df = df.repartition(*partition_by)
    writer = df.write.mode("overwrite").partitionBy(*partition_by).format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def replace_view(spark: SparkSession, name: str, query: str, comment: str = "") -> None:
    """Create or replace a stored view by one statement; a table of that name gives way first."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{comment}' AS {query}")


def append_table(df: DataFrame, name: str) -> None:
    """Append, creating the table on first use."""
    df.write.mode("append").format("parquet").saveAsTable(name)
