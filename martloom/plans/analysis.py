"""Analyses on top of the aggregated and quality tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import percent
from martloom.operators.topn import top_n

# Fixed value: months with fewer orders count as partial.
MIN_ORDERS = 10


def by_units() -> list[Column]:
    return [F.desc_nulls_last("units_sold"), F.desc_nulls_last("revenue"), F.col("product_id")]


def by_revenue(tie_break: str) -> list[Column]:
    return [F.desc_nulls_last("revenue"), F.col(tie_break)]


def full_months(monthly: DataFrame, min_orders: int = MIN_ORDERS) -> DataFrame:
    return monthly.where(F.col("orders") >= min_orders)


def partial_months(monthly: DataFrame, min_orders: int = MIN_ORDERS) -> DataFrame:
    return monthly.where(F.col("orders") < min_orders)


def month_growth(monthly: DataFrame, min_orders: int = MIN_ORDERS) -> DataFrame:
    """Percent change against the previous full month (not the previous calendar month).

    The window has no partition, which is safe for one row per month.
    """
    before = F.lag("revenue").over(Window.orderBy("month"))
    return (
        full_months(monthly, min_orders)
        .withColumn("_before", before)
        .select(
            "month",
            "revenue",
            "orders",
            percent(F.col("revenue") - F.col("_before"), F.col("_before")).alias(
                "mom_growth_pct"
            ),
        )
    )


def category_share(by_category: DataFrame, n: int = 10) -> DataFrame:
    """The n largest categories with their share of the revenue of all categories."""
    whole = by_category.agg(F.sum("revenue")).scalar()
    top = top_n(by_category, by_revenue("category"), n)
    return top.select(
        "category", "revenue", percent(F.col("revenue"), whole).alias("share_pct")
    )


def top_products(products: DataFrame, n: int = 100) -> DataFrame:
    return top_n(products, by_units(), n)


def quality_score(metrics: DataFrame) -> DataFrame:
    """Valid rows in percent of all rows, over all tables."""
    return metrics.agg(
        F.sum("input_records").alias("input_records"),
        F.sum("valid_records").alias("valid_records"),
        F.sum("rejected_records").alias("rejected_records"),
    ).withColumn("quality_score", percent(F.col("valid_records"), F.col("input_records"), 2))


def tables_with_rejects(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("rejected_records") > 0)


def quality_trend(history: DataFrame) -> DataFrame:
    """Counts per run and table, newest run first."""
    return history.select(
        "run_ts", "table_name", "input_records", "valid_records", "rejected_records"
    ).orderBy(F.desc("run_ts"), "table_name")
