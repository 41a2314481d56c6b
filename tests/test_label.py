import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.operators.dedup import DUPLICATE, mark_duplicates, survivor_order
from martloom.operators.label import (
    METRICS,
    REASON,
    STATUS,
    key_slices,
    label,
    metric_columns,
    rejected_rows,
    valid_rows,
    write_labelled,
)
from martloom.sources.registry import CLEANED, TableSpec, cleaned_spec

SPEC = TableSpec(
    name="t",
    files="",
    key=("order_id",),
    rules=(("neg", "amount < 0"), ("null_id", "order_id IS NULL")),
    null_columns=("order_id",),
)
DDL = "order_id string, amount double, load_no int"


def metrics_of(labelled):
    return labelled.agg(*metric_columns()).first().asDict()


def test_every_row_is_either_valid_or_rejected_with_its_reasons(spark):
    rows = [
        ("tea", 4.5, 1), ("tea", 4.0, 3), ("tea", 9.0, 2), ("rum", -0.5, 1), ("rum", 8.0, 0),
        (None, 2.0, 1), ("oil", 0.0, 1), ("ink", None, 1),
    ]
    df = spark.createDataFrame(rows, "order_id string, amount double, _ingested_at int")
    labelled = label(df, SPEC)
    assert metrics_of(labelled) == dict(zip(METRICS, (8, 3, 5, 3, 1), strict=True))
    kept = {r["order_id"]: r["amount"] for r in valid_rows(labelled).collect()}
    # Of rum the latest copy is invalid, so that its earlier one is lost with it.
    assert kept == {"tea": 4.0, "oil": 0.0, "ink": None}
    reasons = {}
    for r in rejected_rows(labelled).collect():
        reasons.setdefault(r[REASON], set()).add((r["order_id"], r["amount"]))
    assert reasons == {
        "duplicate_key": {("tea", 4.5), ("tea", 9.0), ("rum", 8.0)},
        "neg": {("rum", -0.5)},
        "null_id": {(None, 2.0)},
    }
    assert valid_rows(labelled).columns == df.columns


def test_null_keys_equal_each_other_and_reasons_keep_rule_order(spark):
    data = [(None, -1.0, 1), (None, -2.0, 2), (None, 3.0, 3)]
    labelled = label(spark.createDataFrame(data, DDL), SPEC)
    reasons = sorted(r[REASON] for r in rejected_rows(labelled).collect())
    assert reasons == ["duplicate_key; neg; null_id", "duplicate_key; null_id", "neg; null_id"]


def test_a_rule_that_is_null_does_not_reject(spark):
    labelled = label(spark.createDataFrame([("a", None, 1)], DDL), SPEC)
    assert valid_rows(labelled).count() == 1


@pytest.mark.parametrize(("keep", "amount"), [("latest", 2.0), ("earliest", 1.0)])
def test_survivor(spark, keep, amount):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 2)], DDL)
    order = survivor_order(df.columns, recency="load_no", keep=keep)
    got = valid_rows(label(df, SPEC, order=order)).collect()
    assert [r["amount"] for r in got] == [amount]


def test_keep_is_checked():
    with pytest.raises(ValueError, match="keep"):
        survivor_order(["a"], keep="any")


def test_key_is_lost_when_its_survivor_is_invalid(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", -2.0, 2)], DDL)
    order = survivor_order(df.columns, recency="load_no")
    labelled = label(df, SPEC, order=order)
    assert valid_rows(labelled).count() == 0
    assert sorted(r[REASON] for r in rejected_rows(labelled).collect()) == ["duplicate_key", "neg"]


def test_ties_do_not_depend_on_row_order(spark):
    data = [("a", float(i), 1) for i in range(20)]
    kept = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, DDL).repartition(seed + 1)
        order = survivor_order(df.columns, recency="load_no")
        kept.add(valid_rows(label(df, SPEC, order=order)).first()["amount"])
    assert kept == {0.0}


@pytest.mark.parametrize("key", ["'hot'", "cast(null as string)"])
def test_a_key_with_most_rows_is_ranked_by_many_tasks(spark, key):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(0, 40_000, 1, 32).selectExpr(
            f"if(id % 10 < 9, {key}, cast(id as string)) as order_id", "id % 7 as load_no", "id"
        )
        order = survivor_order(df.columns, recency="load_no")
        marked = mark_duplicates(df, ["order_id"], order)
        counts = marked.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in counts) < 40_000 / 4
        alone = marked.where(f"order_id <=> {key} and not {DUPLICATE}").collect()
        assert [(r["load_no"], r["id"]) for r in alone] == [(6, 6)]
        assert marked.where(f"not {DUPLICATE}").count() == 4001
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.sampled_from([None, -1.0, 1.0, 2.0]),
            st.integers(1, 3),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_label_against_python(spark, data):
    df = spark.createDataFrame(data, DDL).repartition(3)
    order = survivor_order(df.columns, recency="load_no")

    def rank(row):
        key, amount, load = row
        return (-load, key is not None, key or "", amount is not None, amount or 0.0)

    expected, seen = [], set()
    for row in sorted(data, key=rank):
        reasons = ["duplicate_key"] if row[0] in seen else []
        seen.add(row[0])
        if row[1] is not None and row[1] < 0:
            reasons.append("neg")
        if row[0] is None:
            reasons.append("null_id")
        expected.append((*row, "; ".join(reasons)))
    got = label(df, SPEC, order=order).select(*df.columns, REASON).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(expected, key=repr)


def test_write_gives_metrics_and_both_parts(spark, tmp_path):
    data = [("a", 1.0, 1), ("a", 2.0, 2), ("b", -1.0, 1)]
    labelled = label(spark.createDataFrame(data, DDL), SPEC)
    metrics = write_labelled(labelled, str(tmp_path / "t"))
    assert metrics == metrics_of(labelled)
    written = spark.read.parquet(str(tmp_path / "t"))
    assert valid_rows(written).count() == 1 and rejected_rows(written).count() == 2
    assert {p.name for p in (tmp_path / "t").glob("_dq*")} == {
        "_dq_status=valid",
        "_dq_status=rejected",
    }


def test_slices_are_written_as_one_table(spark, tmp_path, rows):
    data = [(f"k{i % 40}", 1.0, i) for i in range(200)] + [("hot", 1.0, i) for i in range(300)]
    data += [(None, -1.0, i) for i in range(50)]
    df = spark.createDataFrame(data, "order_id string, amount double, _ingested_at int").repartition(5)
    whole, sliced = str(tmp_path / "whole"), str(tmp_path / "sliced")
    metrics = write_labelled(label(df, SPEC), whole)
    assert metrics == dict(zip(METRICS, (550, 41, 509, 508, 50), strict=True))
    assert write_labelled([label(part, SPEC) for part in key_slices(df, SPEC.key, 4)], sliced) == metrics
    columns = sorted(spark.read.parquet(whole).columns)
    assert rows(spark.read.parquet(sliced), *columns) == rows(spark.read.parquet(whole), *columns)


def test_all_copies_of_a_key_are_in_one_slice(spark):
    data = [(f"k{i % 40}" if i % 7 else None, 1.0, i) for i in range(400)]
    df = spark.createDataFrame(data, DDL)
    slices = [{r["order_id"] for r in part.collect()} for part in key_slices(df, ["order_id"], 3)]
    assert all(slices) and sum(map(len, slices)) == len(set.union(*slices)) == 41
    assert sum(part.count() for part in key_slices(df, ["order_id"], 3)) == 400


def test_only_the_last_slice_marks_success(spark, tmp_path):
    good = label(spark.createDataFrame([("a", 1.0, 1)], DDL), SPEC)
    broken = good.withColumn("amount", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        write_labelled([good, broken], str(tmp_path / "t"))
    assert list((tmp_path / "t").glob(f"{STATUS}=*")) and not (tmp_path / "t" / "_SUCCESS").exists()
    write_labelled([good, good], str(tmp_path / "t"))
    assert (tmp_path / "t" / "_SUCCESS").exists()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_empty_input_has_zero_metrics_and_a_readable_table(spark, tmp_path):
    spark.createDataFrame([], DDL).write.parquet(str(tmp_path / "in"))
    labelled = label(spark.read.parquet(str(tmp_path / "in")), SPEC)
    assert write_labelled(labelled, str(tmp_path / "t")) == dict.fromkeys(METRICS, 0)
    written = spark.read.parquet(str(tmp_path / "t"))
    assert valid_rows(written).columns == ["order_id", "amount", "load_no"]
    assert valid_rows(written).count() == 0


def text(spark, columns, *data):
    return spark.createDataFrame(list(data), ", ".join(f"{c} string" for c in columns))


def reasons_of(df, name, column):
    return {r[column]: r[REASON] for r in label(df, CLEANED[name]).collect()}


def test_orders_rules(spark):
    columns = [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
    ]
    at, later = "2018-01-05 10:00:00", "2018-01-06 10:00:00"
    df = text(
        spark,
        columns,
        ("ok", "c", "delivered", at, later),
        ("not_out", "c", "shipped", at, None),
        ("no_customer", None, "shipped", at, None),
        ("bad_time", "c", "delivered", "2018-1-5", later),
        ("backwards", "c", "delivered", later, at),
        ("undelivered", "c", "delivered", at, "soon"),
        ("no_status", "c", None, at, None),
        (None, "c", "shipped", at, None),
    )
    assert reasons_of(df, "orders", "order_id") == {
        "ok": "",
        "not_out": "",
        "no_customer": "null_customer_id",
        "bad_time": "invalid_purchase_timestamp",
        "backwards": "delivered_before_purchase",
        "undelivered": "delivered_status_missing_date",
        "no_status": "",
        None: "null_order_id",
    }
    rejected = {r["order_id"]: r for r in rejected_rows(label(df, CLEANED["orders"])).collect()}
    assert rejected["bad_time"]["order_purchase_timestamp_raw"] == "2018-1-5"
    assert rejected["undelivered"]["order_delivered_customer_date_raw"] == "soon"


def test_payments_rules(spark):
    df = text(
        spark,
        ["order_id", "payment_sequential", "payment_value", "payment_type"],
        ("ok", "1", "10.5", "boleto"),
        ("neg", "1", "-1", "boleto"),
        ("nan", "1", "NaN", "boleto"),
        ("inf", "1", "Infinity", "boleto"),
        ("text", "1", "ten", "boleto"),
        ("zero", "1", "0", "not_defined"),
    )
    assert reasons_of(df, "payments", "order_id") == {
        "ok": "",
        "neg": "invalid_payment_value",
        "nan": "invalid_payment_value",
        "inf": "invalid_payment_value",
        "text": "invalid_payment_value",
        "zero": "zero_payment_value; undefined_payment_type",
    }
    assert metrics_of(label(df, CLEANED["payments"]))["null_records"] == 3


def test_order_items_rules(spark):
    df = text(
        spark,
        ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
        ("ok", "1", "p", "s", "0", None),
        ("no_product", "1", None, "s", "1", "1"),
        ("no_price", "1", "p", "s", "", "1"),
        ("both", "1", None, "s", "-1", "1"),
    )
    assert reasons_of(df, "order_items", "order_id") == {
        "ok": "",
        "no_product": "null_ids",
        "no_price": "invalid_price",
        "both": "null_ids; invalid_price",
    }


def test_small_tables_rules(spark):
    products = text(
        spark, ["product_id", "product_category_name"], ("p1", "x"), ("p2", None), (None, "x")
    )
    assert reasons_of(products, "products", "product_id") == {
        "p1": "",
        "p2": "missing_category",
        None: "null_product_id",
    }
    sellers = text(spark, ["seller_id", "seller_state"], ("s1", None), (None, "SP"))
    assert reasons_of(sellers, "sellers", "seller_id") == {"s1": "", None: "null_seller_id"}
    customers = text(spark, ["customer_id", "customer_state"], ("c1", "SP"), ("c2", None))
    assert reasons_of(customers, "customers", "customer_id") == {"c1": "", "c2": "null_state"}
    reviews = text(
        spark,
        ["review_id", "order_id", "review_score"],
        *[(f"r{s}", "o", s) for s in ("0", "1", "5", "6", "4.7", "x")],
    )
    assert {k for k, r in reasons_of(reviews, "reviews", "review_id").items() if not r} == {
        "r1",
        "r5",
    }


def test_unknown_tables_are_refused():
    with pytest.raises(ValueError, match="unknown table"):
        cleaned_spec("nope")
    with pytest.raises(ValueError, match="unknown table"):
        cleaned_spec("category_translation")


def test_reasons_as_an_array_and_as_a_text(spark):
    spec = TableSpec(name="t", files="", key=("k",), rules=(("neg", "v < 0"), ("odd", "v % 2 <> 0")))
    df = spark.createDataFrame([("a", -3), ("a", -3), ("b", 2), ("c", None), ("d", 5)], "k string, v int")
    out = label(df, spec).collect()
    held = sorted((r["k"], r["_reject_reasons"], r[REASON]) for r in out)
    assert held == [
        ("a", ["duplicate_key", "neg", "odd"], "duplicate_key; neg; odd"),
        ("a", ["neg", "odd"], "neg; odd"),
        ("b", [], ""),
        ("c", [], ""),
        ("d", ["odd"], "odd"),
    ]
    assert "_reject_reasons" in rejected_rows(label(df, spec)).columns
    assert "_reject_reasons" not in valid_rows(label(df, spec)).columns
