"""Pipeline runs as data: a flat run table and one row per stage metric."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.topn import top_n
from martloom.sources import paths
from martloom.sources.appended import append_frame, append_rows, read_rows

RUNS_DDL = (
    "execution_id string, start_time timestamp, end_time timestamp, mode string,"
    " status string, error string, trace string, input_records long, output_records long"
)
STAGES_DDL = (
    "execution_id string, seq int, stage string, status string, duration_s double,"
    " table_name string, metric string, value long"
)
QUALITY_DDL = (
    "execution_id string, run_ts timestamp, table_name string, input_records long, valid_records long,"
    " rejected_records long, duplicate_records long, null_records long"
)

FILES_DDL = "execution_id string, table_name string, file string"

# Kept lengths of error texts and traces, bounds of the run listing.
ERROR_CHARS, TRACE_CHARS = 300, 1500
DEFAULT_RUNS, MAX_RUNS = 50, 500


class RunLog:
    def __init__(self, spark: SparkSession, storage: str):
        self.spark = spark
        self._runs = paths.join(storage, "log", "runs")
        self._stages = paths.join(storage, "log", "run_stages")
        self._quality = paths.join(storage, "log", "quality_history")
        self._files = paths.join(storage, "log", "landed_files")

    def add_run(self, **run) -> None:
        _append(self.spark, self._runs, [run], RUNS_DDL)

    def take_over(self, runs: DataFrame) -> None:
        """Append the runs of another log, texts cut to the lengths kept here."""
        cut = {
            c: F.left(c, F.lit(n))
            for c, n in (("error", ERROR_CHARS), ("trace", TRACE_CHARS))
            if c in runs.columns
        }
        append_frame(runs.withColumns(cut), self._runs)

    def add_stages(self, stages: list[dict]) -> None:
        if stages:
            _append(self.spark, self._stages, stages, STAGES_DDL)

    def add_quality(self, execution_id: str, run_ts, metrics: dict[str, dict[str, int]]) -> None:
        mark = {"execution_id": execution_id, "run_ts": run_ts}
        rows = [{**mark, "table_name": t, **m} for t, m in metrics.items()]
        _append(self.spark, self._quality, rows, QUALITY_DDL)

    def add_files(self, execution_id: str, stamps: dict[str, list[str]]) -> None:
        rows = [
            {"execution_id": execution_id, "table_name": table, "file": stamp}
            for table, found in stamps.items()
            for stamp in found
        ]
        if rows:
            _append(self.spark, self._files, rows, FILES_DDL)

    def runs(self) -> DataFrame:
        return read_rows(self.spark, self._runs, RUNS_DDL)

    def stages(self) -> DataFrame:
        return read_rows(self.spark, self._stages, STAGES_DDL)

    def published(self) -> DataFrame:
        """The successful runs; what others wrote down is not to be seen by readers."""
        return self.runs().where("status = 'SUCCESS'")

    def quality(self) -> DataFrame:
        """Quality counts of the successful runs."""
        rows = read_rows(self.spark, self._quality, QUALITY_DDL)
        return rows.join(self.published().select("execution_id"), "execution_id", "left_semi")

    def landed(self, table: str) -> DataFrame:
        """stamp of the files that successful runs have applied to a table."""
        rows = read_rows(self.spark, self._files, FILES_DDL).where(F.col("table_name") == table)
        done = rows.join(self.published().select("execution_id"), "execution_id", "left_semi")
        return done.select(F.col("file").alias("stamp"))


def _append(spark: SparkSession, path: str, rows: list[dict], ddl: str) -> None:
    names = [column.split()[0] for column in ddl.split(",")]
    append_rows(spark, path, [tuple(r.get(n) for n in names) for r in rows], ddl)


def run_history(runs: DataFrame, n: int = DEFAULT_RUNS) -> DataFrame:
    """Newest runs first, without traces."""
    order = [F.desc_nulls_last("start_time"), F.desc("execution_id")]
    return top_n(runs.drop("trace"), order, n, high=MAX_RUNS)


def _counted(stages: DataFrame) -> DataFrame:
    """Per stage the metric that counts its output: valid rows where rows are judged."""
    return stages.where(F.col("metric").isin("rows", "valid_records"))


def stage_records(stages: DataFrame) -> DataFrame:
    """Records per run and stage."""
    return (
        _counted(stages)
        .groupBy("execution_id", "seq", "stage")
        .agg(F.sum("value").alias("records"))
    )


def run_totals(stages: DataFrame) -> DataFrame:
    """Per run: rows taken in by ingestion, valid rows given out by cleaning."""
    of_stage = lambda name: F.sum(F.when(F.col("stage") == name, F.col("value")))
    return (
        _counted(stages)
        .groupBy("execution_id")
        .agg(
            F.coalesce(of_stage("bronze"), F.lit(0)).alias("input_records"),
            F.coalesce(of_stage("silver"), F.lit(0)).alias("output_records"),
        )
    )
