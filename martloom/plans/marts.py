"""The aggregated layer: one builder per business question.

Builders take cleaned tables, which are unique on their business key, and return
unordered rows. Two kinds of revenue exist side by side: paid revenue (valid payments on
valid orders that are not cancelled: by day, by month, KPIs) and item revenue (item
prices, cancelled orders included: by product, category, seller).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import money, month_of, ratio

# The status kept out of paid revenue, the label of items without a category.
CANCELLED = "canceled"
UNKNOWN_CATEGORY = "unknown"


def sales_by_day(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """day, paid (not rounded), orders: the common base of all paid-revenue tables.

    Payments are summed per order before the join, so the join is one to one and each
    joined row is one order: counting rows replaces counting distinct orders. Orders
    without a valid payment and orders without a status drop out.
    """
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    live = orders.where(F.col("order_status") != CANCELLED).select(
        "order_id", F.to_date("order_purchase_timestamp").alias("day")
    )
    return (
        live.join(paid, "order_id")
        .groupBy("day")
        .agg(F.sum("paid").alias("paid"), F.count("*").alias("orders"))
    )


def monthly_revenue(by_day: DataFrame) -> DataFrame:
    return by_day.groupBy(month_of(F.col("day")).alias("month")).agg(
        money(F.sum("paid")).alias("revenue"), F.sum("orders").alias("orders")
    )


def daily_sales(by_day: DataFrame) -> DataFrame:
    return by_day.select(
        "day", F.year("day").alias("year"), money(F.col("paid")).alias("revenue"), "orders"
    )


def kpis(by_day: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """One row; zeros, not NULLs, when nothing was sold."""
    totals = by_day.agg(F.sum("paid").alias("paid"), F.sum("orders").alias("orders"))
    rows_of = {
        "total_customers": customers.agg(F.count("*")).scalar(),
        "total_products": products.agg(F.count("*")).scalar(),
    }
    return totals.select(
        F.coalesce(money(F.col("paid")), F.lit(0.0)).alias("total_revenue"),
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        F.coalesce(money(ratio(F.col("paid"), F.col("orders"))), F.lit(0.0)).alias(
            "avg_order_value"
        ),
        *[n.alias(name) for name, n in rows_of.items()],
    )


def product_totals(
    order_items: DataFrame, products: DataFrame, translation: DataFrame
) -> DataFrame:
    """product_id, category, units_sold, sold (not rounded): base of the item-revenue tables.

    Items are summed per product first, so the lookups join one row per product however
    often it was sold. A translation that lists a name twice must not double the sums.
    """
    english = translation.groupBy("product_category_name").agg(
        F.min("product_category_name_english").alias("english")
    )
    category = F.coalesce("english", "product_category_name", F.lit(UNKNOWN_CATEGORY))
    sold = order_items.groupBy("product_id").agg(
        F.count("*").alias("units_sold"), F.sum("price").alias("sold")
    )
    return (
        sold.join(products.select("product_id", "product_category_name"), "product_id", "left")
        .join(english, "product_category_name", "left")
        .select("product_id", category.alias("category"), "units_sold", "sold")
    )


def product_sales(totals: DataFrame) -> DataFrame:
    return totals.select(
        "product_id", "category", "units_sold", money(F.col("sold")).alias("revenue")
    )


def category_revenue(totals: DataFrame) -> DataFrame:
    return totals.groupBy("category").agg(
        money(F.sum("sold")).alias("revenue"), F.sum("units_sold").alias("units_sold")
    )


def seller_revenue(order_items: DataFrame, sellers: DataFrame) -> DataFrame:
    sold = order_items.groupBy("seller_id").agg(
        money(F.sum("price")).alias("revenue"), F.count("*").alias("items_sold")
    )
    return sellers.select("seller_id", "seller_state").join(sold, "seller_id")


def customers_by_state(customers: DataFrame) -> DataFrame:
    """Cleaned customers are unique, so a count per state needs no distinct."""
    return customers.groupBy(F.col("customer_state").alias("state")).agg(
        F.count("customer_id").alias("customers")
    )


def order_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("order_status").alias("status")).agg(
        F.count("*").alias("orders")
    )


def payment_methods(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_type").agg(
        F.count("*").alias("payments"), money(F.sum("payment_value")).alias("value")
    )


def review_scores(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("review_score").agg(F.count("*").alias("reviews"))
