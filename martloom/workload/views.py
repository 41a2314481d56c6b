"""Retail tables derived from the driver's tables, made dirty by fixed arithmetic.

Every view covers its whole table. ``load_no`` stands in for the load time of an order:
some orders are delivered twice and the later load wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = "explode(if(o_orderkey % 50 = 0, array(1, 2), array(1))) AS load_no"
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", loads)
        .selectExpr(
            "if(o_orderkey % 101 = 0, NULL, o_orderkey) AS order_id",
            "if(o_custkey % 97 = 0, NULL, o_custkey) AS customer_id",
            "decode(o_orderstatus, 'F', 'delivered', 'O', 'shipped', 'canceled') AS order_status",
            "if(o_orderkey % 103 = 0, NULL, o_orderdate) AS order_purchase_timestamp",
            """CASE WHEN o_orderstatus <> 'F' OR o_orderkey % 19 = 0 THEN NULL
                    WHEN o_orderkey % 23 = 0 THEN o_orderdate - INTERVAL '1' DAY
                    ELSE o_orderdate + INTERVAL '3' DAY
               END AS order_delivered_customer_date""",
            "load_no",
            "o_orderkey AS src_key",
        )
    )


def order_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load of orders, one row per order that has line items."""
    lines = table(spark, sf_dir, "lineitem")
    return (
        lines.groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(
            F.min("l_suppkey").alias("customer_id"),
            F.bool_and(F.col("l_linestatus") == "F").alias("done"),
            F.min("l_shipdate").alias("order_purchase_timestamp"),
            F.max("l_shipdate").alias("arrived"),
        )
        .selectExpr(
            "order_id",
            "customer_id",
            "if(done, 'delivered', 'shipped') AS order_status",
            "order_purchase_timestamp",
            "if(done, arrived, NULL) AS order_delivered_customer_date",
            "3 AS load_no",
            "order_id AS src_key",
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "if(c_custkey % 53 = 0, NULL, c_custkey) AS customer_id",
            "if(c_custkey % 37 = 0, NULL, n_name) AS customer_state",
            "c_custkey AS src_key",
        )
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS payment_sequential",
        """CASE WHEN l_suppkey % 7 = 0 THEN -l_extendedprice WHEN l_suppkey % 17 = 0 THEN NULL
                WHEN l_suppkey % 23 = 0 THEN 0.0D ELSE l_extendedprice END AS payment_value""",
        """CASE WHEN l_suppkey % 29 = 0 THEN 'not_defined'
                WHEN l_returnflag = 'A' THEN 'credit_card'
                WHEN l_returnflag = 'R' THEN 'boleto' ELSE 'voucher' END AS payment_type""",
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "if(l_suppkey % 11 = 0, NULL, l_orderkey) AS order_id",
        "l_linenumber AS order_item_id",
        "if(l_partkey % 13 = 0, NULL, l_partkey) AS product_id",
        "l_suppkey AS seller_id",
        """CASE WHEN l_suppkey % 7 = 0 THEN -l_extendedprice WHEN l_suppkey % 17 = 0 THEN NULL
                ELSE l_extendedprice END AS price""",
        "l_quantity AS freight_value",
        "l_shipdate",
        "l_partkey",
        "l_orderkey",
        "l_quantity",
        "l_discount",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "if(p_partkey % 20 = 0, NULL, p_type) AS product_category_name",
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "if(s_suppkey % 41 = 0, NULL, s_suppkey) AS seller_id",
            "n_name AS seller_state",
            "s_suppkey AS src_key",
        )
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS review_id",
        "user_id AS order_id",
        "if(event_type = 'error', NULL, cast(floor(value) AS int) % 8) AS review_score",
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category has no translation, so its items keep the native name."""
    return (
        table(spark, sf_dir, "part")
        .where("p_type <> 'ECONOMY'")
        .select(
            F.col("p_type").alias("product_category_name"),
            F.lower("p_type").alias("product_category_name_english"),
        )
        .distinct()
    )


VIEWS = {
    "orders": orders,
    "customers": customers,
    "payments": payments,
    "order_items": order_items,
    "products": products,
    "sellers": sellers,
    "reviews": reviews,
}

# Columns the views carry only to fix the survivor of each key.
HELPERS = {
    "orders": ["load_no", "src_key"],
    "customers": ["src_key"],
    "payments": ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"],
    "order_items": ["l_shipdate", "l_partkey", "l_orderkey", "l_quantity", "l_discount"],
    "products": [],
    "sellers": ["src_key"],
    "reviews": [],
}


def survivor_orders(keep: str = "latest") -> dict[str, list[Column]]:
    """Which copy of a key survives, per view; the first column plays the load time."""

    def first(name: str) -> Column:
        by = F.col(name)
        return by.desc_nulls_last() if keep == "latest" else by.asc_nulls_first()

    def rest(*names: str) -> list[Column]:
        return [F.col(n).asc_nulls_first() for n in names]

    return {
        "orders": [first("load_no"), *rest("src_key")],
        "customers": rest("src_key"),
        "payments": [first("l_shipdate"), *rest("l_partkey", "l_suppkey", "l_quantity")],
        "order_items": [
            first("l_shipdate"),
            *rest("l_orderkey", "l_partkey", "seller_id", "l_quantity", "l_discount"),
        ],
        "products": rest("product_category_name"),
        "sellers": rest("src_key"),
        "reviews": rest("review_score"),
    }


def as_text(df: DataFrame) -> DataFrame:
    """All columns as the text a raw file would hold."""
    stamps = (T.TimestampType, T.TimestampNTZType)
    return df.select(
        [
            F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
            if isinstance(f.dataType, stamps)
            else F.col(f.name).cast("string").alias(f.name)
            for f in df.schema
        ]
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight sources as text rows, without the helper columns."""
    rows = {name: view(spark, sf_dir).drop(*HELPERS[name]) for name, view in VIEWS.items()}
    rows["category_translation"] = category_translation(spark, sf_dir)
    return {name: as_text(df) for name, df in rows.items()}


def write_raw(text: DataFrame, path: str, *, packed: bool = True) -> None:
    """Write text rows as a CSV folder; a packed file is read by one task, so it has a million rows at most."""
    from martloom.sources.raw import CSV_OPTIONS

    packing = {"compression": "gzip", "maxRecordsPerFile": "1000000"} if packed else {}
    text.write.options(**CSV_OPTIONS, **packing).csv(path)


def export_raw(spark: SparkSession, sf_dir: str, raw_dir: str) -> None:
    """Write the sources as CSV folders whose names the source registry's patterns match.

    The one with line breaks in fields is not packed: its large files are to be cut by the reader.
    """
    from martloom.sources.raw import parallel
    from martloom.sources.registry import SOURCES

    def writer(name: str, df: DataFrame):
        path = f"{raw_dir}/{SOURCES[name].files.lstrip('*')}"
        return lambda: write_raw(df, path, packed=not SOURCES[name].multi_line)

    parallel(spark, {n: writer(n, df) for n, df in raw_tables(spark, sf_dir).items()})
