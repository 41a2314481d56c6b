import time

import pytest

from martloom.plans import cleaned, pipeline
from martloom.plans.catalog_layers import publish
from martloom.plans.pipeline import layer_dir, run_job
from martloom.plans.reports import NothingPublished, Reports
from martloom.plans.runlog import RunLog, run_history
from martloom.session import FREES_SHUFFLES
from martloom.sources import appended
from martloom.sources.registry import SOURCES

FILES = {
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_delivered_customer_date
a1,k1,delivered,2021-03-02 08:15:00,2021-03-05 09:00:00
a2,k2,shipped,2021-03-09 12:00:00,
a2,k2,shipped,2021-03-09 12:00:00,
a3,k1,canceled,2021-04-01 07:30:00,
a4,k3,delivered,2021-04-11 19:45:00,2021-04-10 10:00:00
a5,k2,invoiced,2021-04-20 23:59:59,
,k3,shipped,2021-04-21 10:00:00,
""",
    "customers": "customer_id,customer_state\nk1,North\nk2,South\nk3,South\n,East\n",
    "payments": """order_id,payment_sequential,payment_value,payment_type
a1,1,12.50,card
a1,2,7.50,cash
a2,1,40.00,card
a3,1,99.00,card
a4,1,80.00,card
a5,1,5.25,cash
a5,2,-1.00,cash
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,price,freight_value
a1,1,x1,m1,11.00,1.50
a1,2,x2,m2,6.00,1.50
a2,1,x1,m1,38.00,2.00
a3,1,x3,m2,cheap,1.00
a5,1,x2,m1,4.00,1.25
""",
    "products": "product_id,product_category_name\nx1,livros\nx2,jogos\nx3,\n",
    "sellers": "seller_id,seller_state\nm1,North\nm2,West\n",
    "reviews": 'review_id,order_id,review_score,text\nv1,a1,4,"good,\nthough late"\nv2,a2,0,\nv3,a5,5,ok\n',
    "category_translation": "product_category_name,product_category_name_english\nlivros,books\nmoveis,furniture\n",
}


def write_files(folder, files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"shop_{SOURCES[name].files.lstrip('*')}").write_text(text)
    return str(folder)


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    storage = str(base / "storage")
    run = run_job(spark, write_files(base / "raw", FILES), storage)
    return run, Reports(spark, storage)


def test_record(finished):
    run, reports = finished
    assert run["status"] == "SUCCESS"
    assert (run["input_records"], run["output_records"]) == (33, 23)
    assert reports.published_run() == run["execution_id"]


def test_summary_and_trend(finished, rows):
    _, reports = finished
    assert tuple(reports.summary().first()) == (65.25, 3, 21.75, 3, 2)
    assert rows(reports.revenue_trend()) == [("2021-03", 60.0, 2), ("2021-04", 5.25, 1)]
    assert reports.month_growth().isEmpty()
    assert reports.partial_months().count() == 2


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = [f.rsplit("/", 1)[-1].strip(" )") for f in disk.getAllFiles().toString().split(",")]
    return {n for n in names if n.startswith("shuffle_")}


@pytest.mark.parametrize("slice_bytes", [cleaned.SLICE_BYTES, 1])
def test_a_job_leaves_no_shuffle_files(finished, spark, tmp_path, monkeypatch, rows, slice_bytes):
    monkeypatch.setattr(cleaned, "SLICE_BYTES", slice_bytes)
    storage, raw = str(tmp_path / "storage"), write_files(tmp_path / "raw", FILES)
    before = shuffle_files(spark)
    run_job(spark, raw, storage)
    for _ in range(20):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.5)
    assert not left
    assert spark.conf.get(FREES_SHUFFLES) == "false"
    reports, whole = Reports(spark, storage), finished[1]
    assert rows(reports.quality()) == rows(whole.quality())
    assert rows(reports.summary()) == rows(whole.summary())
    plain = [c for c in whole.rejected("orders").columns if c not in ("_ingested_at", "_source_file")]
    assert rows(reports.rejected("orders"), *plain) == rows(whole.rejected("orders"), *plain)


def test_listings(finished, rows):
    _, reports = finished
    assert rows(reports.top_products(1)) == [("x1", "books", 2, 49.0)]
    assert rows(reports.top_categories()) == [("books", 49.0, 2), ("jogos", 10.0, 2)]
    assert rows(reports.category_share()) == [("books", 49.0, 83.1), ("jogos", 10.0, 16.9)]
    assert rows(reports.table("seller_revenue")) == [("m1", "North", 53.0, 3), ("m2", "West", 6.0, 1)]
    assert rows(reports.table("review_scores")) == [(4, 1), (5, 1)]


def test_daily_sales_are_partitioned_by_year(finished):
    _, reports = finished
    plan = reports.table("daily_sales").where("year = 2021")
    assert "PartitionFilters: [isnotnull(year" in plan._jdf.queryExecution().toString()
    assert plan.count() == 3


def counts_of(reports, table):
    (row,) = reports.quality().where(f"table_name = '{table}'").collect()
    return tuple(row[f"{m}_records"] for m in ("input", "valid", "rejected", "duplicate", "null"))


def test_quality_and_rejects(finished, rows):
    _, reports = finished
    assert counts_of(reports, "orders") == (7, 4, 3, 1, 1)
    assert reports.quality().count() == 7
    assert reports.quality_score().first()["quality_score"] == 74.19
    assert rows(reports.reject_reasons("orders")) == [
        ("delivered_before_purchase", 1),
        ("duplicate_key", 1),
        ("null_order_id", 1),
    ]
    item = reports.rejected_sample("order_items").first()
    assert item["price_raw"] == "cheap" and item["_reject_reason"] == "invalid_price"
    assert reports.rejected("payments").count() == 1
    assert reports.reject_total("orders").first()["rejected"] == 3
    with pytest.raises(ValueError, match="unknown table"):
        reports.rejected("nope")
    assert reports.quality_trend().count() == 7


def test_nothing_before_the_first_run(spark, tmp_path):
    with pytest.raises(NothingPublished):
        Reports(spark, str(tmp_path)).summary()
    assert Reports(spark, str(tmp_path)).runs().isEmpty()


def test_a_failed_run_is_recorded_and_not_published(spark, tmp_path):
    storage = str(tmp_path / "storage")
    with pytest.raises(FileNotFoundError):
        run_job(spark, str(tmp_path / "nowhere"), storage)
    reports = Reports(spark, storage)
    with pytest.raises(NothingPublished):
        reports.summary()

    good = run_job(spark, write_files(tmp_path / "raw", FILES), storage)
    broken = {**FILES, "orders": "id\n1\n"}
    with pytest.raises(Exception, match="order_id"):
        run_job(spark, write_files(tmp_path / "broken", broken), storage)
    assert reports.published_run() == good["execution_id"]
    assert reports.summary().first()["total_orders"] == 3

    history = reports.runs().collect()
    assert [r["status"] for r in history] == ["FAILED", "SUCCESS", "FAILED"]
    assert "trace" not in reports.runs().columns
    assert history[2]["error"].startswith("FileNotFoundError")
    assert all(len(r["error"]) <= 400 for r in history if r["error"])
    traces = [r["trace"] for r in reports.log.runs().where("status = 'FAILED'").collect()]
    assert all(0 < len(t) <= 1500 for t in traces)
    assert run_history(reports.log.runs(), 1).count() == 1
    assert reports.last_run().first()["status"] == "FAILED"


@pytest.mark.parametrize("mode", ["batch", "incremental"])
def test_sources_without_rows(spark, tmp_path, mode):
    empty = {name: text.splitlines()[0] + "\n" for name, text in FILES.items()}
    storage = str(tmp_path / "storage")
    run = run_job(spark, write_files(tmp_path / "raw", empty), storage, mode=mode)
    assert (run["input_records"], run["output_records"]) == (0, 0)
    reports = Reports(spark, storage)
    assert tuple(reports.summary().first()) == (0.0, 0, 0.0, 0, 0)
    for table in ("orders", "payments"):
        assert reports.rejected(table).isEmpty() and reports.cleaned(table).isEmpty()
    assert "_reject_reason" in reports.rejected("orders").columns


def test_incremental_runs_take_each_file_once(spark, tmp_path, rows):
    storage, raw = str(tmp_path / "storage"), write_files(tmp_path / "raw", FILES)
    first = run_job(spark, raw, storage, mode="incremental")
    reports = Reports(spark, storage)
    assert first["output_records"] == 23 and counts_of(reports, "orders") == (7, 4, 3, 1, 1)
    summary = tuple(reports.summary().first())
    assert summary == (65.25, 3, 21.75, 3, 2)
    before = rows(reports.cleaned("orders"), "order_id", "order_status")

    # The same files again: no new order is read, and nothing changes.
    assert run_job(spark, raw, storage, mode="incremental")["output_records"] == 19
    assert counts_of(reports, "orders") == (0, 0, 0, 0, 0)
    assert rows(reports.cleaned("orders"), "order_id", "order_status") == before
    assert tuple(reports.summary().first()) == summary

    late = FILES["orders"].splitlines()[0] + "\na2,k2,canceled,2021-03-09 12:00:00,\n"
    late += "a6,k1,shipped,soon,\n,k1,shipped,2021-05-01 00:00:00,\n"
    (tmp_path / "raw" / "late_orders_dataset.csv").write_text(late)
    run_job(spark, raw, storage, mode="incremental")
    # The date that is none counts as a missing one.
    assert counts_of(reports, "orders") == (3, 1, 2, 0, 2)
    assert rows(reports.cleaned("orders"), "order_id", "order_status") == [
        ("a1", "delivered"),
        ("a2", "canceled"),
        ("a3", "canceled"),
        ("a5", "invoiced"),
    ]
    assert rows(reports.summary(), "total_revenue", "total_orders") == [(25.25, 2)]
    reasons = {r["reason"]: r["rows"] for r in reports.reject_reasons("orders").collect()}
    # Rows without a key stay from both loads; keys show their newest rejects.
    assert reasons == {
        "null_order_id": 2,
        "duplicate_key": 1,
        "invalid_purchase_timestamp": 1,
        "delivered_before_purchase": 1,
    }
    reports.compact()
    assert reports.cleaned("orders").count() == 4 and reports.rejected("orders").count() == 5
    with pytest.raises(ValueError, match="mode"):
        run_job(spark, raw, storage, mode="sometimes")


@pytest.mark.parametrize("earlier", ["failed", "batch"])
def test_other_runs_do_not_feed_the_upsert(spark, tmp_path, monkeypatch, earlier):
    storage, raw = str(tmp_path / "storage"), write_files(tmp_path / "raw", FILES)
    if earlier == "batch":
        run_job(spark, raw, storage)
    else:
        with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="out of luck"):
            patch.setattr(pipeline, "build_marts", lambda *_: (_ for _ in ()).throw(RuntimeError("out of luck")))
            run_job(spark, raw, storage, mode="incremental")
    run_job(spark, raw, storage, mode="incremental")
    reports = Reports(spark, storage)
    assert counts_of(reports, "orders") == (7, 4, 3, 1, 1)
    assert reports.rejected("orders").count() == 3 and reports.cleaned("orders").count() == 4
    assert reports.quality_trend().where("table_name = 'orders'").count() == 1 + (earlier == "batch")


def test_pruning_keeps_what_readers_and_later_runs_use(spark, tmp_path, monkeypatch, rows):
    storage, raw = str(tmp_path / "storage"), write_files(tmp_path / "raw", FILES)
    reports = Reports(spark, storage)
    fail = lambda *_: (_ for _ in ()).throw(RuntimeError("out of luck"))
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="out of luck"):
        patch.setattr(pipeline, "build_marts", fail)
        run_job(spark, raw, storage, mode="incremental", execution_id="failed early")
    with pytest.raises(NothingPublished):
        reports.prune()
    for n in "ab":
        run_job(spark, raw, storage, mode="incremental", execution_id=n)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="out of luck"):
        patch.setattr(pipeline, "build_marts", fail)
        run_job(spark, raw, storage, execution_id="failed late")
    (tmp_path / "storage" / "runs" / "unknown").mkdir()

    def seen():
        tables = [reports.summary(), reports.quality(), reports.reject_reasons("orders"), reports.cleaned("orders")]
        return [rows(t) for t in (*tables, reports.cleaned("payments"), reports.log.quality(), reports.runs())]

    before = seen()
    assert reports.prune() == ["a", "failed early"]
    assert {p.name for p in (tmp_path / "storage" / "runs").iterdir()} == {"b", "failed late", "unknown"}
    assert seen() == before and reports.prune() == []
    # Files that the pruned run has landed are still known.
    assert run_job(spark, raw, storage, mode="incremental")["output_records"] == 19
    assert reports.cleaned("orders").count() == 4


def test_the_first_error_is_never_masked(spark, tmp_path, monkeypatch):
    def broken(*_, **__):
        raise OSError("log is gone")

    monkeypatch.setattr(pipeline.RunLog, "add_run", broken)
    with pytest.raises(FileNotFoundError) as e:
        run_job(spark, str(tmp_path / "nowhere"), str(tmp_path / "storage"))
    assert "log is gone" in e.value.__notes__[0]


def test_malformed_rows_are_rejected_on_demand(spark, tmp_path):
    files = {**FILES, "sellers": "seller_id,seller_state\nm1,North\nm2,West\nm3\n"}
    storage, raw = str(tmp_path / "storage"), write_files(tmp_path / "raw", files)
    run_job(spark, raw, storage, reject_malformed=True)
    reports = Reports(spark, storage)
    assert [r["reason"] for r in reports.reject_reasons("sellers").collect()] == ["malformed_row"]
    assert counts_of(reports, "orders") == (7, 4, 3, 1, 1)


def test_layers_as_catalog_tables(finished, spark, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS martloom_layers CASCADE")
    spark.sql(f"CREATE DATABASE martloom_layers LOCATION '{tmp_path}'")
    _, reports = finished
    names = publish(spark, reports.storage, "martloom_layers")
    assert "martloom_layers.rejected_orders" in names and len(names) == 24
    assert spark.table("martloom_layers.silver_orders").count() == 4
    assert spark.table("martloom_layers.gold_daily_sales").where("year = 2021").count() == 3
    spark.sql("DROP DATABASE martloom_layers CASCADE")


def test_sql_users_get_views(finished, spark):
    _, reports = finished
    views = reports.register_views()
    assert {"silver_orders", "rejected_orders", "gold_kpis", "bronze_reviews"} <= set(views)
    best = spark.sql("select max_by(category, revenue) c, sum(units_sold) u from gold_category_revenue")
    assert tuple(best.first()) == ("books", 4)
    tables = spark.sql("select distinct table_name from quality_metrics where rejected_records > 0")
    assert {r[0] for r in tables.collect()} == {
        "orders", "customers", "payments", "order_items", "products", "reviews"
    }
    assert spark.sql("select count_if(order_id is null) n from rejected_orders").first()["n"] == 1


def test_layers_lie_in_the_run_folder(finished):
    run, reports = finished
    assert layer_dir("s", "id", "gold") == "s/runs/id/gold"


def test_publishing_moves_pointers_and_writes_no_data(spark, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS martloom_pointers CASCADE")
    spark.sql(f"CREATE DATABASE martloom_pointers LOCATION '{tmp_path / 'db'}'")
    storage, raw = str(tmp_path / "storage"), write_files(tmp_path / "raw", FILES)
    spark.range(1).write.saveAsTable("martloom_pointers.gold_kpis")
    changed = {**FILES, "orders": FILES["orders"].replace("2021-04-20 23:59:59", "bad")}
    for n in (4, 3):
        if n == 3:
            raw = write_files(tmp_path / "changed", changed)
        run_job(spark, raw, storage)
        files = sorted(p for p in (tmp_path / "storage").rglob("*") if p.is_file())
        publish(spark, storage, "martloom_pointers")
        assert files == sorted(p for p in (tmp_path / "storage").rglob("*") if p.is_file())
        assert not list((tmp_path / "db").rglob("*.parquet"))
        assert spark.table("martloom_pointers.silver_orders").count() == n
        assert spark.table("martloom_pointers.silver_orders").columns == Reports(spark, storage).cleaned("orders").columns
    assert spark.table("martloom_pointers.rejected_orders").count() == 4
    spark.sql("DROP DATABASE martloom_pointers CASCADE")


def test_publishing_an_upserted_table_points_at_its_base(spark, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS martloom_base CASCADE")
    storage, raw = str(tmp_path / "storage"), write_files(tmp_path / "raw", FILES)
    for _ in range(2):
        run_job(spark, raw, storage, mode="incremental")
        publish(spark, storage, "martloom_base")
        reports = Reports(spark, storage)
        for view, frame in (("silver_orders", reports.cleaned("orders")), ("rejected_orders", reports.rejected("orders"))):
            published = spark.table(f"martloom_base.{view}")
            assert published.columns == frame.columns
            assert sorted(map(repr, published.collect())) == sorted(map(repr, frame.collect()))
    spark.sql("DROP DATABASE martloom_base CASCADE")


def test_logs_of_many_runs_stay_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(appended, "FOLD_FILES", 6)
    log = RunLog(spark, str(tmp_path))
    for n in range(30):
        log.add_run(execution_id=f"r{n}", status="SUCCESS" if n % 2 else "FAILED", input_records=n)
    assert log.runs().count() == 30 and log.published().count() == 15
    assert len(log.runs().inputFiles()) <= appended.FOLD_FILES + 1
    assert log.runs().agg({"input_records": "sum"}).first()[0] == sum(range(30))
