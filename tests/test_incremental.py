from datetime import datetime

from pyspark.sql import functions as F

from martloom.operators.dedup import survivor_order
from martloom.operators.label import valid_rows
from martloom.sources import watermark
from martloom.sources.registry import CLEANED
from martloom.streaming.incremental import IncrementalTable

DDL = (
    "order_id string, customer_id string, order_status string,"
    " order_purchase_timestamp string, order_delivered_customer_date string, load_no int"
)
AT = "2018-01-05 10:00:00"


def order(order_id, status, load_no, customer="c", at=AT):
    return (order_id, customer, status, at, None, load_no)


def land(spark, path, *data):
    df = spark.createDataFrame(list(data), DDL).coalesce(1)
    df.write.mode("append").parquet(path)


def table(spark, tmp_path):
    columns = [c.split()[0] for c in DDL.split(", ")]
    return IncrementalTable(
        spark,
        CLEANED["orders"],
        str(tmp_path / "table"),
        order=survivor_order(columns, recency="load_no"),
    )


def current(t):
    return {r["order_id"]: r["order_status"] for r in t.read().collect()}


def test_loads_are_applied_once_and_reruns_do_nothing(spark, tmp_path):
    raw, t = str(tmp_path / "raw"), table(spark, tmp_path)
    schema = spark.createDataFrame([], DDL).schema
    land(spark, raw, order("a", "created", 1), order("b", "created", 1), order(None, "x", 1))
    assert t.load(raw, schema)["input_records"] == 3
    assert current(t) == {"a": "created", "b": "created"}

    land(
        spark,
        raw,
        order("b", "shipped", 2),
        order("b", "packed", 1),
        order("c", "created", 2),
        order("a", "lost", 2, at="bad"),
    )
    assert t.load(raw, schema)["valid_records"] == 2
    # The invalid update of a is rejected; its earlier valid row stays.
    assert current(t) == {"a": "created", "b": "shipped", "c": "created"}

    before = t.batch_ids()
    assert set(t.load(raw, schema).values()) == {0}
    assert t.batch_ids() == before
    assert current(t) == {"a": "created", "b": "shipped", "c": "created"}

    rejects = {(r["_batch_id"], r["order_id"], r["_reject_reason"]) for r in t.rejects().collect()}
    assert rejects == {
        (0, None, "null_order_id"),
        (1, "b", "duplicate_key"),
        (1, "a", "invalid_purchase_timestamp"),
    }
    quality = t.quality().orderBy("_batch_id").collect()
    assert [(r["input_records"], r["valid_records"]) for r in quality] == [(3, 2), (4, 2)]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    raw, t = str(tmp_path / "raw"), table(spark, tmp_path)
    schema = spark.createDataFrame([], DDL).schema
    land(spark, raw, order("a", "created", 1))
    t.load(raw, schema)
    land(spark, raw, order("a", "shipped", 2), order(None, "x", 2))
    t.load(raw, schema)
    state = current(t), t.rejects().count(), t.quality().count()
    replay = spark.createDataFrame([order("a", "shipped", 2), order(None, "x", 2)], DDL)
    t.apply(replay, 1)
    assert (current(t), t.rejects().count(), t.quality().count()) == state


def test_splitting_a_load_gives_the_same_table(spark, tmp_path):
    data = [order(k, s, n) for n, (k, s) in enumerate(zip("abcab", "12345", strict=True))]
    results = []
    for parts in ([data], [data[:2], data[2:]], [[d] for d in data]):
        folder = tmp_path / str(len(parts))
        t = table(spark, folder)
        for part in parts:
            land(spark, str(folder / "raw"), *part)
            t.load(str(folder / "raw"), spark.createDataFrame([], DDL).schema)
        results.append(current(t))
    assert results == [{"a": "4", "b": "5", "c": "3"}] * 3


def test_watermark(spark, tmp_path):
    path = str(tmp_path / "marks")
    first = datetime(2024, 1, 1, 0, 0, 0, 123456)
    second = datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, first), (2, second)], "id int, _ingested_at timestamp_ntz")
    assert watermark.watermark_of(spark, path, "orders") is None
    assert watermark.newer_than(df, None).count() == 2

    old = df.where("id = 1")
    assert watermark.advance(spark, path, "orders", old) == first
    mark = watermark.watermark_of(spark, path, "orders")
    assert mark == first
    assert [r["id"] for r in watermark.newer_than(df, mark).collect()] == [2]

    watermark.advance(spark, path, "orders", df)
    assert watermark.newer_than(df, watermark.watermark_of(spark, path, "orders")).isEmpty()
    assert watermark.advance(spark, path, "orders", df.limit(0)) is None
    assert watermark.watermark_of(spark, path, "orders") == second
    assert watermark.watermark_of(spark, path, "other") is None


def test_watermark_of_a_zoned_load_time(spark, tmp_path):
    path = str(tmp_path / "marks")
    df = spark.range(2).withColumn("_ingested_at", F.current_timestamp())
    df.write.parquet(str(tmp_path / "bronze"))
    landed = spark.read.parquet(str(tmp_path / "bronze"))
    watermark.advance(spark, path, "orders", landed)
    mark = watermark.watermark_of(spark, path, "orders")
    assert watermark.newer_than(landed, mark).isEmpty()


def test_valid_rows_keep_their_types(spark, tmp_path):
    raw, t = str(tmp_path / "raw"), table(spark, tmp_path)
    land(spark, raw, order("a", "created", 1))
    t.load(raw, spark.createDataFrame([], DDL).schema)
    assert dict(t.read().dtypes)["order_purchase_timestamp"] == "timestamp"
    assert valid_rows(spark.read.parquet(str(tmp_path / "table" / "batches"))).count() == 1


def test_keep_is_passed_on(spark, tmp_path):
    ddl = DDL.replace("load_no int", "_ingested_at int")
    data = [order("a", "first", 1), order("a", "second", 2)]
    for keep, status in (("latest", "second"), ("earliest", "first")):
        folder = tmp_path / keep
        spark.createDataFrame(data, ddl).write.parquet(str(folder / "raw"))
        t = IncrementalTable(spark, CLEANED["orders"], str(folder / "t"), keep=keep)
        t.load(str(folder / "raw"), spark.createDataFrame([], ddl).schema)
        assert current(t) == {"a": status}
