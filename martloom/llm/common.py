"""What the operators share: reading a table, tables in the shared folder, joins by checked size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.sources import paths

# A side of a join is broadcast up to this many narrow rows; beyond it, both sides are shuffled.
BROADCAST_ROWS = 100_000
# Keys with more than this part of the rows, at least HOT_ROWS, are joined by broadcast: there are
# no more than HOT_PARTS of them, whatever the data.
HOT_PARTS, HOT_ROWS = 5_000, 64
# Rows that a Python worker turns into objects at once.
SLICE = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, **options: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = paths.join(paths.shared_folder(spark), "table")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The stored rows, with a broadcast hint if there are few enough; else Spark shuffles."""
    return F.broadcast(df) if df.count() <= most else df


def many_to_one(
    rows: DataFrame, side: DataFrame, keys: list[str], n_rows: int, rows_of_key: str = "n"
) -> DataFrame:
    """Inner join of the rows with the one row of their key; no key's rows meet in one task.

    ``side`` counts each key's rows in ``rows_of_key``. Keys that hold many rows are sent to all
    executors, at most ``HOT_PARTS`` of them; the rest are shuffled.
    """
    most = max(HOT_ROWS, n_rows // HOT_PARTS)
    hot = F.broadcast(side.where(F.col(rows_of_key) > most))
    met = rows.join(hot, keys)
    rest = rows.join(hot.select(*keys), keys, "left_anti")
    return met.unionByName(rest.join(side.where(F.col(rows_of_key) <= most), keys))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in short slices (at least one for each): a worker holds the objects of one only."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _framed_name(docs: DataFrame, column: str) -> str:
    # Arrow functions cannot address names with dots.
    number = f"{docs.columns.index(column)}_" if "." in column else ""
    return f"in_{number}{column.replace('.', '_')}"


def framed(docs: DataFrame) -> DataFrame:
    """The rows with ``in_`` before each column's name, so that added names never clash."""
    return docs.select(*[F.col(f"`{c}`").alias(_framed_name(docs, c)) for c in docs.columns])


def unframed(rows: DataFrame, docs: DataFrame, **made: Column) -> DataFrame:
    """The columns of ``docs`` again, under their names and types; ``made`` replaces some."""
    return rows.select(
        *[
            made.get(c, F.col(_framed_name(docs, c))).cast(docs.schema[c].dataType).alias(c)
            for c in docs.columns
        ]
    )
