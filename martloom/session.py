"""Session settings the jobs rely on; cluster size and memory stay with spark-submit."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Two open files per task spare the sort that a partitioned write needs otherwise.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# How the layers are written: smaller than Spark's default, at little more work.
PARQUET_OPTIONS = {"compression": "zstd"}
# Off by default: shuffle files then stay until the driver happens to collect its garbage.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app: str = "martloom", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files are deleted when the query ends; a session keeps its own setting."""
    before = spark.conf.get(FREES_SHUFFLES, None)
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREES_SHUFFLES)
        else:
            spark.conf.set(FREES_SHUFFLES, before)
