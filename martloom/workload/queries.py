"""The registered queries: each operator run over the views, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import to_double, to_int, to_timestamp
from martloom.operators import dedup, rejects
from martloom.operators.label import (
    DUPLICATE,
    METRICS,
    REASON,
    REASONS,
    STATUS,
    label,
    rejected_rows,
    valid_rows,
)
from martloom.operators.label import quality_metrics as count_quality
from martloom.operators.topn import top_n
from martloom.operators.upsert import upsert
from martloom.plans import analysis, marts, runlog
from martloom.plans.aggregated import write_daily_sales
from martloom.plans.pipeline import run_job
from martloom.plans.reports import Reports
from martloom.session import freed_shuffles
from martloom.sources import paths, watermark
from martloom.sources.batched_table import BATCH
from martloom.sources.catalog import save_table
from martloom.sources.raw import CSV_OPTIONS, INGESTED_AT, SOURCE_FILE, read_raw
from martloom.sources.registry import CLEANED, SOURCES, TableSpec
from martloom.streaming.incremental import IncrementalTable
from martloom.workload import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINEITEM = TableSpec(
    name="lineitem",
    files="lineitem.parquet",
    key=("l_orderkey", "l_linenumber"),
    rules=(("small_quantity", "l_quantity < 5"), ("returned", "l_returnflag = 'R'")),
    null_columns=("l_orderkey",),
)
# Time of the first and of the second load in queries that show a clock.
FIRST_RUN = datetime(2024, 1, 1, tzinfo=timezone.utc)
SECOND_RUN = datetime(2024, 1, 2, tzinfo=timezone.utc)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def labelled(spark, sf_dir, name, *, keep="latest") -> DataFrame:
    return label(
        views.VIEWS[name](spark, sf_dir),
        CLEANED[name],
        order=views.survivor_orders(keep)[name],
    )


def cleaned(spark, sf_dir, name, **how) -> DataFrame:
    return valid_rows(labelled(spark, sf_dir, name, **how))


def rejected(spark, sf_dir, name, **how) -> DataFrame:
    """Rejects with their reasons as an array and as a text."""
    return rejected_rows(labelled(spark, sf_dir, name, **how))


def by_day(spark, sf_dir) -> DataFrame:
    return marts.sales_by_day(
        cleaned(spark, sf_dir, "orders"), cleaned(spark, sf_dir, "payments")
    )


def by_product(spark, sf_dir) -> DataFrame:
    return marts.product_totals(
        cleaned(spark, sf_dir, "order_items"),
        cleaned(spark, sf_dir, "products"),
        views.category_translation(spark, sf_dir),
    )


def all_labelled(spark, sf_dir) -> dict[str, DataFrame]:
    return {name: labelled(spark, sf_dir, name) for name in CLEANED}


_jobs: dict[tuple[str, str], str] = {}


def finished_job(spark, sf_dir) -> str:
    """Storage of a whole job run over the views as raw text; one run per session and data."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _jobs:
        folder = paths.shared_folder(spark)
        views.export_raw(spark, sf_dir, f"{folder}/raw")
        run_job(spark, f"{folder}/raw", f"{folder}/storage", execution_id="run1")
        _jobs[key] = f"{folder}/storage"
    return _jobs[key]


# --- raw layer -------------------------------------------------------------------------


@query
def bronze_orders(spark, sf_dir):
    folder = paths.shared_folder(spark)
    text = views.raw_tables(spark, sf_dir)["orders"]
    text.write.option("header", "true").csv(f"{folder}/orders_dataset.csv")
    raw = read_raw(spark, folder, SOURCES["orders"])
    return raw.select(
        *text.columns,
        F.col(INGESTED_AT).isNotNull().alias("has_ingested_at"),
        F.col(SOURCE_FILE).endswith(".csv").alias("has_source_file"),
    )


@query
def bronze_two_files(spark, sf_dir):
    """A source in two files whose columns come in a different order."""
    folder = paths.shared_folder(spark)
    orders = views.VIEWS["orders"](spark, sf_dir)
    for name, rest in (("a", 0), ("b", 1)):
        part = views.as_text(orders.where(F.col("src_key") % 2 == rest).drop(*views.HELPERS["orders"]))
        columns = part.columns if name == "a" else part.columns[::-1]
        part.select(*columns).write.options(**CSV_OPTIONS).csv(f"{folder}/{name}_orders_dataset.csv")
    spec = SOURCES["orders"]
    parts = [
        read_raw(spark, folder, spec, files=paths.data_files(spark, f"{folder}/{name}_*")).withColumn(
            "file", F.lit(name)
        )
        for name in "ab"
    ]
    together = read_raw(spark, folder, spec)
    both = parts[0].unionByName(parts[1])
    # Read as one source, no row may differ from the two read apart.
    wrong = together.select(*spec.columns).exceptAll(both.select(*spec.columns))
    return both.select(*spec.columns, "file").join(wrong.limit(1).select(F.lit(1)), how="left_anti")


@query
def bronze_counts(spark, sf_dir):
    stages = Reports(spark, finished_job(spark, sf_dir)).log.stages()
    return stages.where("stage = 'bronze'").select("table_name", F.col("value").alias("rows"))


# --- casts -----------------------------------------------------------------------------


@query
def cast_timestamp_safe(spark, sf_dir):
    text = F.expr(
        """CASE WHEN o_orderkey % 5 = 0 THEN 'bad'
                WHEN o_orderkey % 7 = 0 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss.SSS')
                WHEN o_orderkey % 11 = 0 THEN '2017-02-30 00:00:00'
                WHEN o_orderkey % 13 = 0 THEN date_format(o_orderdate, 'yyyy-M-d H:m:s')
                ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END"""
    )
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    parsed = to_timestamp(F.col("text")).cast("timestamp_ntz")
    return orders.select("o_orderkey", "text", parsed.alias("parsed"))


@query
def cast_double_safe(spark, sf_dir):
    text = F.expr(
        """CASE event_type WHEN 'error' THEN 'NaN' WHEN 'click' THEN concat(' ', value, ' ')
                WHEN 'purchase' THEN concat(value, ' BRL') WHEN 'view' THEN 'Infinity'
                ELSE cast(value AS string) END"""
    )
    events = views.table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return events.select("event_id", to_double(F.col("text")).alias("parsed"))


@query
def cast_int_safe(spark, sf_dir):
    text = F.expr(
        """CASE event_type WHEN 'error' THEN 'n/a' WHEN 'click' THEN cast(value AS string)
                ELSE cast(cast(floor(value) AS int) AS string) END"""
    )
    events = views.table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return events.select("event_id", to_int(F.col("text")).alias("parsed"))


# --- cleaned layer ---------------------------------------------------------------------


def _register_cleaned(name: str) -> None:
    QUERIES[f"silver_{name}"] = lambda spark, sf_dir: cleaned(spark, sf_dir, name)
    QUERIES[f"rejected_{name}"] = lambda spark, sf_dir: rejected(spark, sf_dir, name).drop(REASONS)


for _name in CLEANED:
    _register_cleaned(_name)


def _lineitem_split(spark, sf_dir, keep):
    lines = views.table(spark, sf_dir, "lineitem")
    rest = [c for c in lines.columns if c not in LINEITEM.key]
    order = dedup.survivor_order(rest, recency="l_shipdate", keep=keep)
    return label(lines, LINEITEM, order=order).select(*lines.columns, STATUS, REASON)


@query
def silver_lineitem_split(spark, sf_dir):
    return _lineitem_split(spark, sf_dir, "earliest")


@query
def silver_lineitem_split_latest(spark, sf_dir):
    return _lineitem_split(spark, sf_dir, "latest")


@query
def dedup_orders(spark, sf_dir):
    orders = views.orders(spark, sf_dir)
    marked = dedup.mark_duplicates(orders, ["order_id"], views.survivor_orders()["orders"])
    return marked.where(~F.col(DUPLICATE)).drop(DUPLICATE)


@query
def quality_metrics(spark, sf_dir):
    return count_quality(all_labelled(spark, sf_dir))


@query
def quality_score(spark, sf_dir):
    return analysis.quality_score(count_quality(all_labelled(spark, sf_dir)))


@query
def tables_with_rejects(spark, sf_dir):
    metrics = count_quality(all_labelled(spark, sf_dir))
    return analysis.tables_with_rejects(metrics).select("table_name", "rejected_records")


@query
def reject_reason_counts(spark, sf_dir):
    return rejects.reason_counts(rejected(spark, sf_dir, "payments"))


@query
def reject_reason_combos(spark, sf_dir):
    return rejects.reason_combinations(rejected(spark, sf_dir, "orders"))


@query
def rejected_sample(spark, sf_dir):
    rows = rejected(spark, sf_dir, "orders").drop(REASONS)
    return rejects.rejected_sample(rows, ["order_id", "src_key", "load_no"], 20)


@query
def quality_history(spark, sf_dir):
    log = runlog.RunLog(spark, paths.shared_folder(spark))
    second_load = label(
        views.order_updates(spark, sf_dir),
        CLEANED["orders"],
        order=views.survivor_orders()["orders"],
    )
    for run_ts, tables in (
        (FIRST_RUN, all_labelled(spark, sf_dir)),
        (SECOND_RUN, {"orders": second_load}),
    ):
        counted = count_quality(tables).collect()
        run = run_ts.isoformat()
        log.add_quality(
            run, run_ts, {r["table_name"]: {m: r[m] for m in METRICS} for r in counted}
        )
        log.add_run(execution_id=run, start_time=run_ts, mode="batch", status="SUCCESS")
    local = F.col("run_ts").cast("timestamp_ntz")
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
    return analysis.quality_trend(log.quality()).withColumn("run_ts", utc)


# --- aggregated layer ------------------------------------------------------------------


@query
def monthly_revenue(spark, sf_dir):
    return marts.monthly_revenue(by_day(spark, sf_dir)).orderBy("month")


@query
def daily_sales(spark, sf_dir):
    return marts.daily_sales(by_day(spark, sf_dir)).drop("year").orderBy("day")


@query
def daily_sales_partitioned(spark, sf_dir):
    folder = paths.shared_folder(spark)
    write_daily_sales(marts.daily_sales(by_day(spark, sf_dir)), folder)
    return spark.read.parquet(folder)


def catalog_table(spark, name, rows, **how) -> DataFrame:
    save_table(rows, name, path=paths.shared_folder(spark), **how)
    return spark.table(name)


@query
def catalog_daily_sales(spark, sf_dir):
    """The same table kept in the catalog, partitioned, and scanned by name."""
    daily = marts.daily_sales(by_day(spark, sf_dir))
    return catalog_table(spark, "martloom_daily_sales", daily, partition_by=["year"])


@query
def catalog_orders(spark, sf_dir):
    return catalog_table(spark, "martloom_orders", cleaned(spark, sf_dir, "orders"))


@query
def product_sales(spark, sf_dir):
    return marts.product_sales(by_product(spark, sf_dir))


@query
def top_products(spark, sf_dir):
    return analysis.top_products(marts.product_sales(by_product(spark, sf_dir)))


@query
def top_products_n(spark, sf_dir):
    return top_n(
        marts.product_sales(by_product(spark, sf_dir)), analysis.by_units(), 10, high=100
    )


@query
def category_revenue(spark, sf_dir):
    table = marts.category_revenue(by_product(spark, sf_dir))
    return table.orderBy(*analysis.by_revenue("category"))


@query
def seller_revenue(spark, sf_dir):
    table = marts.seller_revenue(
        cleaned(spark, sf_dir, "order_items"), cleaned(spark, sf_dir, "sellers")
    )
    return table.orderBy(*analysis.by_revenue("seller_id"))


@query
def customers_by_state(spark, sf_dir):
    return marts.customers_by_state(cleaned(spark, sf_dir, "customers"))


@query
def order_status(spark, sf_dir):
    return marts.order_status(cleaned(spark, sf_dir, "orders"))


@query
def payment_methods(spark, sf_dir):
    return marts.payment_methods(cleaned(spark, sf_dir, "payments"))


@query
def review_scores(spark, sf_dir):
    return marts.review_scores(cleaned(spark, sf_dir, "reviews"))


@query
def kpis(spark, sf_dir):
    return marts.kpis(
        by_day(spark, sf_dir),
        cleaned(spark, sf_dir, "customers"),
        cleaned(spark, sf_dir, "products"),
    )


@query
def mom_growth(spark, sf_dir):
    return analysis.month_growth(marts.monthly_revenue(by_day(spark, sf_dir))).orderBy("month")


@query
def partial_months(spark, sf_dir):
    """Orders moved by up to 599 months, so that there are months with few of them."""
    moved = F.col("order_purchase_timestamp") + F.make_interval(
        months=(F.col("order_id") % 600).cast("int")
    )
    orders = cleaned(spark, sf_dir, "orders").withColumn("order_purchase_timestamp", moved)
    by_day = marts.sales_by_day(orders, cleaned(spark, sf_dir, "payments"))
    return analysis.partial_months(marts.monthly_revenue(by_day))


@query
def category_share(spark, sf_dir):
    return analysis.category_share(marts.category_revenue(by_product(spark, sf_dir)))


@query
def gold_counts(spark, sf_dir):
    stages = Reports(spark, finished_job(spark, sf_dir)).log.stages()
    return stages.where("stage = 'gold'").select("table_name", F.col("value").alias("rows"))


# --- incremental loads -----------------------------------------------------------------


@query
def watermark_value(spark, sf_dir):
    path = paths.shared_folder(spark)
    for name, column in (("orders", "o_orderdate"), ("events", "ts")):
        watermark.advance(spark, path, name, views.table(spark, sf_dir, name), column)
    return watermark.watermarks(spark, path)


@query
def incremental_filter(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    return watermark.newer_than(orders, datetime(1998, 1, 1), "o_orderdate")


@query
def upsert_first_load(spark, sf_dir):
    return upsert(None, views.order_updates(spark, sf_dir), ["order_id"])


@query
def scd1_upsert(spark, sf_dir):
    return upsert(
        cleaned(spark, sf_dir, "orders"),
        views.order_updates(spark, sf_dir),
        ["order_id"],
        source_is_unique=True,
    )


@query
def stream_upsert_orders(spark, sf_dir):
    folder = paths.shared_folder(spark)
    table = IncrementalTable(
        spark,
        CLEANED["orders"],
        f"{folder}/orders",
        order=views.survivor_orders()["orders"],
    )
    for load in (views.orders(spark, sf_dir), views.order_updates(spark, sf_dir)):
        load.withColumn("customer_id", F.col("customer_id").cast("long")).write.mode(
            "append"
        ).parquet(f"{folder}/raw")
        table.load(f"{folder}/raw", spark.read.parquet(f"{folder}/raw").schema)
    return table.read()


@query
def rejects_latest(spark, sf_dir):
    folder = paths.shared_folder(spark)
    for n, keep in enumerate(("earliest", "latest")):
        batch = rejected(spark, sf_dir, "order_items", keep=keep).drop(REASONS)
        batch.write.parquet(f"{folder}/{BATCH}={n}")
    return rejects.latest_rejects(spark.read.parquet(folder), CLEANED["order_items"].key)


@query
def scd1_upsert_null_keys(spark, sf_dir):
    """Onto raw orders, some of which have no key: these match nothing and stay."""
    return upsert(
        views.VIEWS["orders"](spark, sf_dir),
        views.order_updates(spark, sf_dir),
        ["order_id"],
        source_is_unique=True,
    )


@query
def incremental_job_quality(spark, sf_dir):
    """Counts of orders in three incremental runs: a first load, a later one, and no new file.

    Runs that a later one has replaced are pruned, so that no more than two lie side by side.
    """
    folder = paths.shared_folder(spark)
    raw, storage = f"{folder}/raw", f"{folder}/storage"
    views.export_raw(spark, sf_dir, raw)
    late = views.order_updates(spark, sf_dir).drop(*views.HELPERS["orders"])
    for load in range(3):
        if load == 1:
            with freed_shuffles(spark):
                views.write_raw(views.as_text(late), f"{raw}/late_orders_dataset.csv")
        run_job(spark, raw, storage, mode="incremental", execution_id=str(load))
        Reports(spark, storage).prune()
    counted = Reports(spark, storage).log.quality().where("table_name = 'orders'")
    return counted.withColumn("load", F.col("execution_id").cast("long")).drop(
        "execution_id", "run_ts"
    )


# --- runs ------------------------------------------------------------------------------


@query
def run_history(spark, sf_dir):
    """The event log taken over as a run log, errors as failed runs, and listed."""
    log = runlog.RunLog(spark, paths.shared_folder(spark))
    failed = F.col("event_type") == "error"
    log.take_over(
        views.table(spark, sf_dir, "events").select(
            F.col("event_id").cast("string").alias("execution_id"),
            F.col("ts").cast("timestamp").alias("start_time"),
            F.lit("batch").alias("mode"),
            F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
            F.when(failed, F.col("props")).alias("error"),
            F.when(failed, F.repeat("props", F.lit(100))).alias("trace"),
            F.col("user_id").alias("input_records"),
        )
    )
    listed = runlog.run_history(log.runs()).drop("end_time", "output_records")
    return listed.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query
def run_stages(spark, sf_dir):
    stages = Reports(spark, finished_job(spark, sf_dir)).log.stages()
    return stages.drop("duration_s")


@query
def run_totals(spark, sf_dir):
    return runlog.run_totals(Reports(spark, finished_job(spark, sf_dir)).log.stages())


@query
def run_stage_records(spark, sf_dir):
    return runlog.stage_records(Reports(spark, finished_job(spark, sf_dir)).log.stages())


@query
def report_summary(spark, sf_dir):
    return Reports(spark, finished_job(spark, sf_dir)).summary()


@query
def report_revenue_trend(spark, sf_dir):
    return Reports(spark, finished_job(spark, sf_dir)).revenue_trend()


@query
def report_top_products(spark, sf_dir):
    return Reports(spark, finished_job(spark, sf_dir)).top_products()


@query
def report_top_categories(spark, sf_dir):
    return Reports(spark, finished_job(spark, sf_dir)).top_categories()


@query
def report_quality(spark, sf_dir):
    return Reports(spark, finished_job(spark, sf_dir)).quality()


@query
def report_reject_reasons(spark, sf_dir):
    return Reports(spark, finished_job(spark, sf_dir)).reject_reasons("orders")
