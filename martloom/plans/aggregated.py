"""Writing the aggregated layer from the cleaned one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martloom.plans import marts
from martloom.sources import paths
from martloom.sources.raw import parallel, write_counted

# Unrounded bases that several tables roll up from; written once, then read back.
BASE_BY_DAY = "base_sales_by_day"
BASE_BY_PRODUCT = "base_sales_by_product"

MARTS = (
    "monthly_revenue",
    "daily_sales",
    "top_products",
    "category_revenue",
    "seller_revenue",
    "customers_by_state",
    "order_status",
    "payment_methods",
    "review_scores",
    "kpis",
)


def mart_builders(
    cleaned: dict[str, DataFrame], by_day: DataFrame, by_product: DataFrame
) -> dict[str, DataFrame]:
    """All aggregated tables, from the cleaned tables and the two bases."""
    return {
        "monthly_revenue": marts.monthly_revenue(by_day),
        "daily_sales": marts.daily_sales(by_day),
        "top_products": marts.product_sales(by_product),
        "category_revenue": marts.category_revenue(by_product),
        "seller_revenue": marts.seller_revenue(cleaned["order_items"], cleaned["sellers"]),
        "customers_by_state": marts.customers_by_state(cleaned["customers"]),
        "order_status": marts.order_status(cleaned["orders"]),
        "payment_methods": marts.payment_methods(cleaned["payments"]),
        "review_scores": marts.review_scores(cleaned["reviews"]),
        "kpis": marts.kpis(by_day, cleaned["customers"], cleaned["products"]),
    }


def write_daily_sales(daily: DataFrame, path: str) -> int:
    """One directory per year; a year's days are few, so one file each."""
    return write_counted(daily.repartition("year"), path, partition_by=("year",))


def build_marts(
    spark: SparkSession, cleaned: dict[str, DataFrame], translation: DataFrame, out_dir: str
) -> dict[str, int]:
    """Write every aggregated table; returns rows per table."""
    bases = {
        BASE_BY_DAY: marts.sales_by_day(cleaned["orders"], cleaned["payments"]),
        BASE_BY_PRODUCT: marts.product_totals(
            cleaned["order_items"], cleaned["products"], translation
        ),
    }
    # One at a time: their shuffles are the largest of this layer.
    parallel(spark, {n: _writer(df, paths.join(out_dir, n)) for n, df in bases.items()}, workers=1)
    by_day, by_product = (spark.read.parquet(paths.join(out_dir, n)) for n in bases)

    def writer(name: str, df: DataFrame):
        path = paths.join(out_dir, name)
        if name == "daily_sales":
            return lambda: write_daily_sales(df, path)
        return _writer(df, path)

    tables = mart_builders(cleaned, by_day, by_product)
    return parallel(spark, {name: writer(name, df) for name, df in tables.items()})


def _writer(df: DataFrame, path: str):
    return lambda: write_counted(df, path)
