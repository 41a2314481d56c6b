import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from martloom.operators.label import label
from martloom.operators.rejects import latest_rejects
from martloom.operators.upsert import AmbiguousSource, upsert
from martloom.sources.batched_table import BatchedTable
from martloom.sources.registry import TableSpec

DDL = "k string, v int"
CALM = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
MAPPINGS = st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 99), max_size=8)


def frame(spark, data):
    return spark.createDataFrame(list(data), DDL)


def test_first_load_update_insert_and_untouched(spark, rows):
    first = upsert(None, frame(spark, [("a", 1), ("b", 2)]), ["k"])
    second = upsert(first, frame(spark, [("b", 20), ("c", 30)]), ["k"])
    assert rows(second) == [("a", 1), ("b", 20), ("c", 30)]


def test_null_keys_always_insert_unless_null_safe(spark, rows):
    target, source = frame(spark, [(None, 1)]), frame(spark, [(None, 2)])
    assert rows(upsert(target, source, ["k"])) == [(None, 1), (None, 2)]
    assert rows(upsert(target, source, ["k"], null_safe=True)) == [(None, 2)]


def test_composite_keys(spark, rows):
    ddl = "a string, b int, v int"
    target = spark.createDataFrame([("x", 1, 0), ("x", 2, 0)], ddl)
    source = spark.createDataFrame([("x", 2, 9), ("y", 2, 9)], ddl)
    assert rows(upsert(target, source, ["a", "b"])) == [("x", 1, 0), ("x", 2, 9), ("y", 2, 9)]


def test_ambiguous_sources_are_refused(spark):
    target = frame(spark, [("a", 0)])
    with pytest.raises(AmbiguousSource, match="'a'"):
        upsert(target, frame(spark, [("a", 1), ("a", 2)]), ["k"])
    nulls = frame(spark, [(None, 1), (None, 2)])
    assert upsert(target, nulls, ["k"]).count() == 3
    with pytest.raises(AmbiguousSource):
        upsert(target, nulls, ["k"], null_safe=True)


@CALM
@given(MAPPINGS, MAPPINGS)
def test_twice_is_once(spark, target, source):
    once = upsert(frame(spark, target.items()), frame(spark, source.items()), ["k"])
    twice = upsert(once, frame(spark, source.items()), ["k"])
    expected = {**target, **source}
    assert {r["k"]: r["v"] for r in once.collect()} == expected
    assert sorted(map(tuple, twice.collect())) == sorted(expected.items())


def test_rows_without_a_key_stay_out_of_the_join(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(0, 40_000, 1, 8).selectExpr(
            "if(id % 10 < 9, null, cast(id as string)) as k", "cast(id as int) as v"
        )
        out = upsert(target, frame(spark, [("9", -1), ("new", -2)]), ["k"])
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 40_001 and max(sizes) < 40_000 / 6
        assert out.where("k is null").count() == 36_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def labelled(spark, data):
    spec = TableSpec(name="t", files="", key=("k",), rules=(("neg", "v < 0"),))
    return label(frame(spark, data), spec)


def test_batches_are_read_newest_per_key(spark, tmp_path, rows):
    table = BatchedTable(spark, str(tmp_path / "t"), ["k"])
    assert table.read() is None and table.rejects() is None
    assert table.add(labelled(spark, [("a", 1), ("b", 2), ("c", -3)]), 5)["valid_records"] == 2
    assert table.add(labelled(spark, []), 6)["input_records"] == 0
    table.add(labelled(spark, [("b", 20), (None, 4)]), 7)
    table.add(labelled(spark, [("b", 21), (None, 5)]), 9)
    assert rows(table.read()) == [("a", 1), ("b", 21), (None, 4), (None, 5)]
    assert rows(table.read([5, 7])) == [("a", 1), ("b", 20), (None, 4)]
    assert rows(table.read([6])) == [] if table.read([6]) else True
    assert rows(table.rejects(), "k", "_batch_id") == [("c", 5)]
    assert table.batch_ids() == [5, 6, 7, 9]


def test_a_batch_costs_what_it_holds_and_may_be_repeated(spark, tmp_path, rows):
    table = BatchedTable(spark, str(tmp_path / "t"), ["k"])
    table.add(labelled(spark, [(f"k{i}", i) for i in range(5000)]), 0)
    for _ in range(2):
        table.add(labelled(spark, [(f"k{i}", 7) for i in range(100)]), 1)
    written = spark.read.parquet(str(tmp_path / "t" / "batches" / "_batch_id=1"))
    assert written.count() == 100
    assert table.read().count() == 5000 and table.read().where("v = 7").count() == 100


def test_compacting_changes_nothing_but_the_files_read(spark, tmp_path, rows):
    table = BatchedTable(spark, str(tmp_path / "t"), ["k"])
    for n, data in enumerate([[("a", 1), ("b", 2)], [("b", 3)], [("c", 4), (None, 0)], [("a", 9)]]):
        table.add(labelled(spark, data), n)
    before = rows(table.read([0, 2, 3]))
    assert table.compact(upto=2, only=[0, 2, 3]) == 2
    assert rows(table.read([0, 2, 3])) == before == [("a", 9), ("b", 2), ("c", 4), (None, 0)]
    assert rows(table.read([0])) == [("a", 1), ("b", 2)]
    assert not any("_batch_id=0" in f for f in table.read([0, 2, 3]).inputFiles())


@CALM
@given(st.lists(MAPPINGS, min_size=1, max_size=3))
def test_batches_equal_a_dict(spark, tmp_path_factory, batches):
    table = BatchedTable(spark, str(tmp_path_factory.mktemp("t")), ["k"])
    expected = {}
    for n, batch in enumerate(batches):
        table.add(labelled(spark, list(batch.items())), n)
        expected |= batch
    current = table.read()
    assert ({} if current is None else {r["k"]: r["v"] for r in current.collect()}) == expected


def test_a_folded_base_is_not_shuffled(spark, tmp_path, rows):
    table = BatchedTable(spark, str(tmp_path / "t"), ["k"])
    table.add(labelled(spark, [(f"k{i}", i) for i in range(500)] + [(None, 7)]), 0)
    assert table.compact(buckets=4) == 0
    table.add(labelled(spark, [(f"k{i}", 1000) for i in range(0, 600, 3)] + [(None, 8)]), 1)
    table.add(labelled(spark, [("k0", 2000)]), 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        current = table.read()
        plan = current._jdf.queryExecution().executedPlan().toString()
        # Nothing but a filter lies between the join and the scan of the base.
        lines = plan.splitlines()
        base = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        join = max(i for i, line in enumerate(lines[:base]) if "SortMergeJoin" in line)
        assert not any("Exchange" in line for line in lines[join:base])
        assert "SelectedBucketsCount: 4 out of 4" in plan and "SortAggregate" not in plan
        got = dict((r["k"], r["v"]) for r in current.where("k is not null").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    expected = {f"k{i}": i for i in range(500)} | {f"k{i}": 1000 for i in range(0, 600, 3)} | {"k0": 2000}
    assert got == expected
    assert rows(table.read().where("k is null")) == [(None, 7), (None, 8)]
    # Folding again, from base and batches, and reading it where the catalog has lost the table.
    assert table.compact(buckets=3) == 2
    spark.sql(f"DROP TABLE {table._table_name(2)}")
    assert {r["k"]: r["v"] for r in table.read().where("k is not null").collect()} == expected
    assert table.base_table(2).inputFiles() and len(table.base_table(2).inputFiles()) == 3


def test_folding_keeps_the_newest_rejects(spark, tmp_path, rows):
    table = BatchedTable(spark, str(tmp_path / "t"), ["k"])
    table.add(labelled(spark, [("a", -1), ("b", -2), (None, -3), ("c", 1)]), 0)
    table.add(labelled(spark, [("a", -4), (None, -5)]), 1)
    newest = rows(latest_rejects(table.rejects(), ["k"]), "k", "v", "_batch_id")
    assert newest == [("a", -4, 1), ("b", -2, 0), (None, -3, 0), (None, -5, 1)]
    table.compact()
    assert rows(table.rejects(), "k", "v", "_batch_id") == newest
    assert not any("batches" in f for f in table.rejects().inputFiles())
    table.add(labelled(spark, [("b", -9), ("a", 5)]), 2)
    later = rows(latest_rejects(table.rejects(), ["k"]), "k", "v", "_batch_id")
    assert later == [("a", -4, 1), ("b", -9, 2), (None, -3, 0), (None, -5, 1)]
    assert rows(table.read()) == [("a", 5), ("c", 1)]


def test_null_safe_keys_are_folded_too(spark, tmp_path, rows):
    table = BatchedTable(spark, str(tmp_path / "t"), ["k"], null_safe=True)
    spec = TableSpec(name="t", files="", key=("k",), rules=(("neg", "v < 0"),))
    add = lambda n, data: table.add(label(frame(spark, data), spec), n)
    add(0, [("a", 1), (None, 2)])
    table.compact()
    add(1, [(None, 3)])
    assert rows(table.read()) == [("a", 1), (None, 3)]
