"""What readers ask of a storage folder: the newest successful run's tables, rejects, runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from martloom.operators.label import METRICS, label, rejected_rows, valid_rows
from martloom.operators.rejects import latest_rejects, reason_counts, rejected_sample
from martloom.operators.topn import top_n
from martloom.plans import analysis
from martloom.plans.aggregated import MARTS
from martloom.plans.cleaned import read_rejected, read_valid
from martloom.plans.pipeline import (
    CLEAN_STAGE,
    INCREMENTAL_MODE,
    MART_STAGE,
    RAW_STAGE,
    UPSERTED,
    layer_dir,
    published_batches,
    upserted_table,
)
from martloom.plans.runlog import RunLog, run_history
from martloom.sources import paths
from martloom.sources.batched_table import BATCH
from martloom.sources.registry import CLEANED, SOURCES, TableSpec, cleaned_spec


class NothingPublished(LookupError):
    """No run has succeeded yet."""


# Sizes of the listings.
PRODUCTS_SHOWN, MAX_PRODUCTS, CATEGORIES_SHOWN, REJECTS_SHOWN = 10, 100, 15, 20


class Reports:
    def __init__(self, spark: SparkSession, storage: str):
        self.spark = spark
        self.storage = storage
        self.log = RunLog(spark, storage)

    def published_run(self) -> str:
        return self._published()["execution_id"]

    def _published(self) -> Row:
        run = F.struct("execution_id", "mode", "start_time", F.unix_micros("start_time").alias("number"))
        newest = self.log.published().agg(F.max_by(run, "start_time").alias("run")).first()["run"]
        if newest is None:
            raise NothingPublished(f"no successful run in {self.storage}")
        return newest

    def table(self, name: str) -> DataFrame:
        """An aggregated table of the published run."""
        folder = self._folder(self._published(), MART_STAGE)
        return self.spark.read.parquet(paths.join(folder, name))

    def summary(self) -> DataFrame:
        return self.table("kpis")

    def revenue_trend(self) -> DataFrame:
        return self.table("monthly_revenue").orderBy("month")

    def month_growth(self) -> DataFrame:
        return analysis.month_growth(self.table("monthly_revenue")).orderBy("month")

    def partial_months(self) -> DataFrame:
        return analysis.partial_months(self.table("monthly_revenue")).orderBy("month")

    def top_products(self, n: int = PRODUCTS_SHOWN) -> DataFrame:
        return top_n(self.table("top_products"), analysis.by_units(), n, high=MAX_PRODUCTS)

    def top_categories(self) -> DataFrame:
        table = self.table("category_revenue")
        return top_n(table, analysis.by_revenue("category"), CATEGORIES_SHOWN)

    def category_share(self) -> DataFrame:
        return analysis.category_share(self.table("category_revenue"))

    def quality(self) -> DataFrame:
        """The published run's metrics, one row per table."""
        run = self.published_run()
        stages = self.log.stages().where(
            (F.col("execution_id") == run) & (F.col("stage") == CLEAN_STAGE)
        )
        return stages.groupBy("table_name").pivot("metric", list(METRICS)).agg(F.max("value"))

    def quality_score(self) -> DataFrame:
        return analysis.quality_score(self.quality())

    def quality_trend(self) -> DataFrame:
        return analysis.quality_trend(self.log.quality())

    def cleaned(self, table: str) -> DataFrame:
        """Valid rows of a cleaned table."""
        spec = cleaned_spec(table)
        run = self._published()
        if self._is_upserted(spec.name, run):
            current = self._upserted(spec.name).read(self._batches(run))
            return valid_rows(self._labelled_landing(run, spec)).limit(0) if current is None else current
        return read_valid(self.spark, self._folder(run, CLEAN_STAGE), spec.name)

    def rejected(self, table: str) -> DataFrame:
        """Rejected rows of a cleaned table; for an upserted one each key's newest."""
        spec = cleaned_spec(table)
        run = self._published()
        if self._is_upserted(spec.name, run):
            appended = self._upserted(spec.name).rejects(self._batches(run))
            if appended is None:
                return rejected_rows(self._labelled_landing(run, spec)).limit(0)
            return latest_rejects(appended, spec.key).drop(BATCH)
        return read_rejected(self.spark, self._folder(run, CLEAN_STAGE), spec.name)

    def compact(self) -> None:
        """Fold the batches of the successful runs; do this while no run is going on."""
        batches = published_batches(self.log)
        for name in UPSERTED:
            self._upserted(name).compact(only=batches)

    def prune(self) -> list[str]:
        """Delete the folders of runs that began before the published one; returns their numbers.

        Readers use the published run alone; logs, landed files and batches of upserted tables stay.
        Do this while no run is going on, and after catalog views were moved to the published run.
        """
        run = self._published()
        before = self.log.runs().where(F.unix_micros("start_time") < run["number"])
        older = {r["execution_id"] for r in before.select("execution_id").distinct().collect()}
        pruned = []
        for folder in paths.glob(self.spark, paths.join(self.storage, "runs", "*")):
            name = folder.rsplit("/", 1)[1]
            if name in older and name != run["execution_id"]:
                paths.delete(self.spark, folder)
                pruned.append(name)
        return sorted(pruned)

    def is_upserted(self, table: str) -> bool:
        """Whether the published run keeps a cleaned table by upsert."""
        return self._is_upserted(table, self._published())

    def mart_folder(self, name: str) -> str:
        return paths.join(self._folder(self._published(), MART_STAGE), name)

    def cleaned_folder(self, table: str) -> str:
        return paths.join(self._folder(self._published(), CLEAN_STAGE), table)

    def folded(self, table: str) -> tuple[str, str, str]:
        """Folders of an upserted table's rows with a key, without one, and of its rejects; its
        batches up to the published run are folded if they are not."""
        return self._upserted(table).folded(self._batches(self._published()))

    def reject_total(self, table: str) -> DataFrame:
        """How many rows of a table are rejected now."""
        return self.rejected(table).agg(F.count("*").alias("rejected"))

    def _upserted(self, name: str):
        return upserted_table(self.spark, self.storage, name)

    def _batches(self, run: Row) -> list[int]:
        return [b for b in published_batches(self.log) if b <= run["number"]]

    def register_views(self) -> list[str]:
        """Temporary views over all tables of the published run, for SQL users."""
        run = self._published()
        tables = {f"gold_{n}": lambda n=n: self.table(n) for n in MARTS}
        for name in CLEANED:
            tables[f"silver_{name}"] = lambda n=name: self.cleaned(n)
            tables[f"rejected_{name}"] = lambda n=name: self.rejected(n)
        raw = self._folder(run, RAW_STAGE)
        for name in SOURCES:
            tables[f"bronze_{name}"] = lambda n=name: self.spark.read.parquet(paths.join(raw, n))
        for view, rows in tables.items():
            rows().createOrReplaceTempView(view)
        self.log.quality().createOrReplaceTempView("quality_metrics")
        return [*tables, "quality_metrics"]

    def _labelled_landing(self, run: Row, spec: TableSpec) -> DataFrame:
        landed = self.spark.read.parquet(paths.join(self._folder(run, RAW_STAGE), spec.name))
        return label(landed, spec)

    def _folder(self, run: Row, layer: str) -> str:
        return layer_dir(self.storage, run["execution_id"], layer)

    @staticmethod
    def _is_upserted(name: str, run: Row) -> bool:
        return run["mode"] == INCREMENTAL_MODE and name in UPSERTED

    def rejected_sample(self, table: str, n: int = REJECTS_SHOWN) -> DataFrame:
        rows = self.rejected(table)
        key = cleaned_spec(table).key
        return rejected_sample(rows, [*key, *(c for c in rows.columns if c not in key)], n)

    def reject_reasons(self, table: str) -> DataFrame:
        return reason_counts(self.rejected(table)).orderBy(F.desc("rows"), "reason")

    def runs(self, n: int = 50) -> DataFrame:
        return run_history(self.log.runs(), n)

    def last_run(self) -> DataFrame:
        return run_history(self.log.runs(), 1)
