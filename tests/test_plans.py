"""Physical plans are the ones meant: pruned scans, no Python, no cross joins, few shuffles."""

import pytest

from martloom.sources.registry import CLEANED
from martloom.workload import queries, views

DATA = "/root/testdata/sf0.001"
LAZY = sorted(
    {
        n
        for n in queries.QUERIES
        if not n.startswith(("report_", "run_", "bronze_", "gold_", "incremental_job"))
    }
    - {"stream_upsert_orders", "quality_history", "watermark_value"}
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan_of(df).count("Exchange hashpartitioning")


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_joins(spark, name):
    plan = plan_of(queries.QUERIES[name](spark, DATA))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert operator not in plan


def test_valid_rows_read_only_needed_columns(spark):
    plan = plan_of(queries.QUERIES["monthly_revenue"](spark, DATA))
    assert "l_discount" not in plan and "l_tax" not in plan and "o_totalprice" not in plan


def test_labelling_scans_once_and_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("labelling", "")
    for name in CLEANED:
        labelled = queries.labelled(spark, DATA, name)
        before = len(tracker.getJobIdsForGroup("labelling"))
        plan = plan_of(labelled)
        # Ranked within the splits, then among their winners.
        assert exchanges(labelled) == 2
        assert plan.count("FileScan") == (2 if name in ("customers", "sellers") else 1)
        assert len(tracker.getJobIdsForGroup("labelling")) == before


def test_status_filter_is_a_partition_filter(spark, tmp_path):
    from martloom.operators.label import valid_rows, write_labelled

    write_labelled(queries.labelled(spark, DATA, "orders"), str(tmp_path / "orders"))
    cleaned = valid_rows(spark.read.parquet(str(tmp_path / "orders")))
    plan = plan_of(cleaned.where("order_status <> 'canceled'").select("order_id"))
    assert "_dq_status = valid" in plan.replace("#", " ") or "PartitionFilters: [isnotnull" in plan
    assert "Not(EqualTo(order_status,canceled))" in plan
    assert "ReadSchema: struct<order_id:bigint,order_status:string>" in plan


def test_top_n_keeps_candidates_per_task(spark):
    assert "TakeOrderedAndProject" in plan_of(queries.QUERIES["top_products"](spark, DATA))


def test_views_cover_whole_tables(spark):
    lines = views.table(spark, DATA, "lineitem").count()
    assert views.payments(spark, DATA).count() == lines
    assert views.order_items(spark, DATA).count() == lines
