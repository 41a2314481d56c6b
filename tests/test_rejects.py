from datetime import datetime

import pytest

from martloom.operators.rejects import (
    latest_rejects,
    reason_combinations,
    reason_counts,
    rejected_sample,
)
from martloom.operators.topn import clamp, top_n


@pytest.fixture
def rejected(spark):
    return spark.createDataFrame(
        [("a", "x; y"), ("b", "x"), ("c", "x")], "order_id string, _reject_reason string"
    )


def test_reasons(rejected, rows):
    assert rows(reason_counts(rejected)) == [("x", 3), ("y", 1)]
    assert rows(reason_combinations(rejected)) == [("x", 2), ("x; y", 1)]


def test_sample(spark, rejected):
    assert [r[0] for r in rejected_sample(rejected, ["order_id"], 2).collect()] == ["a", "b"]
    for n in (0, 201):
        with pytest.raises(ValueError, match="1..200"):
            rejected_sample(rejected, ["order_id"], n)
    timed = spark.createDataFrame([(datetime(2018, 1, 5, 10), "x")], "at timestamp, r string")
    assert rejected_sample(timed, ["at"], 1).first()["at"] == "2018-01-05T10:00:00.000"


def test_top_n_is_clamped(spark):
    assert [clamp(n, 1, 100) for n in (-5, 0, 50, 1000)] == [1, 1, 50, 100]
    assert [r[0] for r in top_n(spark.range(5), ["id"], 0).collect()] == [0]
    assert top_n(spark.range(500), ["id"], 400, high=100).count() == 100


def test_latest_rejects(spark, rows):
    appended = spark.createDataFrame(
        [
            ("a", "old", 0),
            ("a", "new", 1),
            ("a", "newer", 1),
            ("b", "old", 0),
            (None, "old", 0),
            (None, "new", 1),
        ],
        "order_id string, r string, _batch_id int",
    )
    assert rows(latest_rejects(appended, ["order_id"]), "order_id", "r") == [
        ("a", "new"),
        ("a", "newer"),
        ("b", "old"),
        (None, "new"),
        (None, "old"),
    ]
