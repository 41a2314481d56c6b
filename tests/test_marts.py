from datetime import date

import pytest
from pyspark.sql import functions as F

from martloom.plans import analysis, marts


@pytest.fixture
def shop(spark):
    def table(data, ddl):
        return spark.createDataFrame(data, ddl)

    orders = table(
        [
            ("q7", "invoiced", "2020-11-30 23:30:00"),
            ("q8", "shipped", "2020-12-01 00:10:00"),
            ("q9", "canceled", "2020-12-02 14:00:00"),
            ("not_paid", "shipped", "2020-12-03 09:00:00"),
            ("no_status", None, "2020-12-04 09:00:00"),
        ],
        "order_id string, order_status string, at string",
    ).select(
        "order_id",
        "order_status",
        F.to_timestamp("at").alias("order_purchase_timestamp"),
    )
    return {
        "orders": orders,
        "payments": table(
            [
                ("q7", 9.99, "gift"),
                ("q7", 0.01, "points"),
                ("q8", 31.5, "gift"),
                ("q9", 400.0, "points"),
                ("no_status", 70.0, "gift"),
                ("unknown_order", 5.0, "gift"),
            ],
            "order_id string, payment_value double, payment_type string",
        ),
        "order_items": table(
            [
                ("q7", "lamp", "n1", 4.25), ("q7", "lamp", "n2", 4.75),
                ("q8", "rug", "n1", 30.0), ("q9", "vase", "closed", 350.0),
            ],
            "order_id string, product_id string, seller_id string, price double",
        ),
        "products": table(
            [("lamp", "luz"), ("vase", "ceramica")],
            "product_id string, product_category_name string",
        ),
        "sellers": table([("n1", "X"), ("n2", "Y"), ("idle", "Y")], "seller_id string, seller_state string"),
        "customers": table([("u1", "X"), ("u2", "Y"), ("u3", "Y")], "customer_id string, customer_state string"),
        "translation": table(
            [("luz", "light"), ("luz", "lighting"), ("unused", None)],
            "product_category_name string, product_category_name_english string",
        ),
    }


def test_paid_revenue(shop, rows):
    by_day = marts.sales_by_day(shop["orders"], shop["payments"])
    assert rows(by_day) == [(date(2020, 11, 30), 10.0, 1), (date(2020, 12, 1), 31.5, 1)]
    assert rows(marts.monthly_revenue(by_day)) == [("2020-11", 10.0, 1), ("2020-12", 31.5, 1)]
    assert rows(marts.daily_sales(by_day))[1] == (date(2020, 12, 1), 2020, 31.5, 1)


def test_kpis(shop):
    by_day = marts.sales_by_day(shop["orders"], shop["payments"])
    row = marts.kpis(by_day, shop["customers"], shop["products"]).first()
    assert tuple(row) == (41.5, 2, 20.75, 3, 2)


def test_kpis_are_zero_when_nothing_was_sold(shop):
    by_day = marts.sales_by_day(shop["orders"].limit(0), shop["payments"])
    none = shop["customers"].limit(0), shop["products"].limit(0)
    assert tuple(marts.kpis(by_day, *none).first()) == (0.0, 0, 0.0, 0, 0)


def test_item_revenue_keeps_unknown_categories_and_cancelled_orders(shop, rows):
    totals = marts.product_totals(shop["order_items"], shop["products"], shop["translation"])
    # Of two translations of a name one is taken, as two would count each item twice.
    assert rows(marts.category_revenue(totals)) == [
        ("ceramica", 350.0, 1),
        ("light", 9.0, 2),
        ("unknown", 30.0, 1),
    ]
    assert rows(marts.product_sales(totals), "product_id", "units_sold", "revenue") == [
        ("lamp", 2, 9.0),
        ("rug", 1, 30.0),
        ("vase", 1, 350.0),
    ]


def test_sellers(shop, rows):
    got = rows(marts.seller_revenue(shop["order_items"], shop["sellers"]))
    assert got == [("n1", "X", 34.25, 2), ("n2", "Y", 4.75, 1)]


def test_group_counts(shop, rows):
    assert rows(marts.customers_by_state(shop["customers"])) == [("X", 1), ("Y", 2)]
    statuses = {r["status"]: r["orders"] for r in marts.order_status(shop["orders"]).collect()}
    assert statuses == {"invoiced": 1, "canceled": 1, "shipped": 2, None: 1}
    assert rows(marts.payment_methods(shop["payments"])) == [
        ("gift", 4, 116.49),
        ("points", 2, 400.01),
    ]


def monthly(spark, *data):
    return spark.createDataFrame(data, "month string, revenue double, orders long")


def test_growth_compares_with_the_previous_full_month(spark):
    months = monthly(
        spark,
        ("2018-01", 100.0, 50),
        ("2018-02", 1.0, 9),
        ("2018-03", 150.0, 10),
        ("2018-04", 0.0, 12),
        ("2018-05", 10.0, 12),
    )
    growth = {r["month"]: r["mom_growth_pct"] for r in analysis.month_growth(months).collect()}
    assert growth == {"2018-01": None, "2018-03": 50.0, "2018-04": -100.0, "2018-05": None}
    assert [r["month"] for r in analysis.partial_months(months).collect()] == ["2018-02"]


def test_share_is_of_all_categories(spark, rows):
    table = spark.createDataFrame(
        [("a", 50.0, 1), ("b", 30.0, 1), ("c", 20.0, 1)],
        "category string, revenue double, units_sold long",
    )
    assert rows(analysis.category_share(table, 2)) == [("a", 50.0, 50.0), ("b", 30.0, 30.0)]


def test_top_products_break_ties(spark):
    table = spark.createDataFrame(
        [("p2", 3, 5.0), ("p1", 3, 5.0), ("p3", 3, 6.0), ("p4", 9, 1.0)],
        "product_id string, units_sold long, revenue double",
    )
    top = [r["product_id"] for r in analysis.top_products(table, 3).collect()]
    assert top == ["p4", "p3", "p1"]


def test_quality_score(spark):
    metrics = spark.createDataFrame(
        [("a", 1000, 999, 1), ("b", 500, 500, 0)],
        "table_name string, input_records long, valid_records long, rejected_records long",
    )
    assert analysis.quality_score(metrics).first()["quality_score"] == 99.93
    assert [r["table_name"] for r in analysis.tables_with_rejects(metrics).collect()] == ["a"]
