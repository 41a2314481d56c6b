from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martloom.functions import to_double, to_int, to_timestamp
from martloom.functions.casts import apply_casts


def parse(spark, cast, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(cast(F.col("t"))).collect()]


def test_timestamp_pattern_is_strict(spark):
    texts = [
        "2017-01-05 10:00:00",
        "2017-1-5 1:0:0",
        "2017-01-05 10:00:00.123",
        "2017-02-30 00:00:00",
        "2017-01-05",
        "bad",
        None,
    ]
    first, *others = parse(spark, to_timestamp, texts)
    assert first == datetime(2017, 1, 5, 10)
    assert others == [None] * 6


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("12.5", 12.5),
        (" 3 ", 3.0),
        ("1.5d", 1.5),
        ("-0.5", -0.5),
        ("1e3", 1000.0),
        ("NaN", None),
        ("Infinity", None),
        ("-Infinity", None),
        ("12,5", None),
        ("", None),
        (None, None),
    ],
)
def test_double(spark, text, value):
    assert parse(spark, to_double, [text]) == [value]


def test_int_does_not_truncate(spark):
    assert parse(spark, to_int, ["5", "4.7", "x", " 3 ", None]) == [5, None, None, 3, None]


def test_typed_columns_pass_and_text_is_kept(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2017-01-05 10:00:00' AS at, 2.5D AS price, 'x' AS score, 'k' AS id"
    )
    out = apply_casts(df, {"at": "timestamp", "price": "double", "score": "int", "gone": "int"})
    row = out.first()
    assert row["at"] == datetime(2017, 1, 5, 10) and row["price"] == 2.5
    assert row["score"] is None and row["score_raw"] == "x"
    assert set(out.columns) == {"at", "price", "score", "id", "score_raw"}


def test_typed_nan_counts_as_missing(spark):
    df = spark.sql("SELECT double('NaN') AS price")
    assert apply_casts(df, {"price": "double"}).first()["price"] is None
