"""The published run's layers as catalog views, for users who query a metastore."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martloom.operators.label import DUPLICATE, HAS_NULL, REJECTED, STATUS, VALID
from martloom.plans.aggregated import MARTS
from martloom.plans.reports import Reports
from martloom.sources import catalog
from martloom.sources.batched_table import BATCH
from martloom.sources.registry import CLEANED


def publish(spark: SparkSession, storage: str, schema: str) -> list[str]:
    """Point the views ``silver_*``, ``rejected_*`` and ``gold_*`` of a schema at the published run.

    Returns their names. Each is replaced by one catalog statement and no data is written, but for
    upserted tables: their batches are folded into a base first if there are later ones, and the
    views point at the base's parts.
    """
    reports = Reports(spark, storage)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    run, queries = reports.published_run(), {}
    for name in MARTS:
        queries[f"gold_{name}"] = _select(reports.table(name), reports.mart_folder(name))
    for name in CLEANED:
        valid, rejected = reports.cleaned(name), reports.rejected(name)
        if reports.is_upserted(name):
            keyed, unkeyed, folded = reports.folded(name)
            queries[f"silver_{name}"] = f"{_select(valid, keyed)} UNION ALL {_select(valid, unkeyed)}"
            queries[f"rejected_{name}"] = _select(rejected, folded)
        else:
            folder = reports.cleaned_folder(name)
            queries[f"silver_{name}"] = _select(valid, folder, f"{STATUS} = '{VALID}'")
            queries[f"rejected_{name}"] = _select(rejected, folder, f"{STATUS} = '{REJECTED}'")
    for name, query in queries.items():
        catalog.replace_view(spark, f"{schema}.{name}", query, comment=f"run {run}")
    return [f"{schema}.{name}" for name in queries]


def _select(rows: DataFrame, folder: str, where: str = "true") -> str:
    """SQL of the frame's columns over the Parquet files of a folder."""
    helpers = {DUPLICATE, HAS_NULL, STATUS, BATCH}
    columns = ", ".join(f"`{c}`" for c in rows.columns if c not in helpers)
    return f"SELECT {columns} FROM parquet.`{folder}` WHERE {where}"
