"""Large files with line breaks in fields: many splits give the rows of one task."""

import random

import pytest
from pyspark.sql import functions as F

from martloom.sources import raw as raw_module
from martloom.sources import paths, records
from martloom.sources.raw import CORRUPT, INGESTED_AT, SOURCE_FILE, read_raw
from martloom.sources.registry import TableSpec

SPEC = TableSpec(name="t", files="*t.csv", columns=("k", "v"), multi_line=True)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def text(rng, n):
    """Records whose fields hold breaks, quotes and commas; one spans several splits."""
    out = ["k,v,text"]
    for i in range(n):
        note = "".join(rng.choice(["a", "bc ", "\n", "\n\n", ",", '""', "é"]) for _ in range(rng.randrange(30)))
        if i == n // 2:
            note = "long\n" * 2500
        shape = rng.choice([f'k{i},{i},"{note}"', f'"k{i}",{i},plain', f'k{i},"",', f'k{i},"x\n{i}"', f"k{i},1,2,3"])
        out.append(f'k{i},{i},"{note}"' if i == n // 2 else shape)
        if i % 40 == 0:
            out.append("")
    return "\n".join(out) + "\n"


def both_ways(spark, monkeypatch, folder, keep):
    def rows(df):
        kept = [f"`{c}`" for c in df.columns if c != INGESTED_AT]
        return df.columns, sorted(map(repr, df.select(*kept).collect()))

    cut = rows(read_raw(spark, folder, SPEC, keep_malformed=keep))
    with monkeypatch.context() as m:
        m.setattr(raw_module, "split_files", lambda *_: [])
        return cut, rows(read_raw(spark, folder, SPEC, keep_malformed=keep))


@pytest.mark.parametrize("keep", [False, True])
def test_many_splits_give_the_rows_of_one_task(spark, tmp_path, monkeypatch, small_splits, keep):
    rng = random.Random(5)
    (tmp_path / "a t.csv").write_text(text(rng, 400))
    (tmp_path / "b_t.csv").write_text(text(rng, 300).rstrip("\n"))
    (tmp_path / "c_t.csv").write_text('k,v,text\n1,2,"small\nfile"\n')
    files = paths.data_files(spark, str(tmp_path))
    assert len(raw_module.split_files(spark, files)) == 2
    cut, whole = both_ways(spark, monkeypatch, str(tmp_path), keep)
    assert cut == whole and len(cut[1]) == 701
    assert (CORRUPT in cut[0]) == keep
    lines = records.lines_of_records(spark, files[:1])
    assert lines.select("start").distinct().count() > 5


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    (tmp_path / "a_t.csv").write_text(text(random.Random(1), 600))
    assert read_raw(spark, str(tmp_path), SPEC).where(f"{SOURCE_FILE} = 'a_t.csv'").count() == 600
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lines = records.lines_of_records(spark, paths.data_files(spark, str(tmp_path)))
        assert lines.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize(
    "line", ['k,5" tall,x', 'k, "v",x', 'k,"v" ,x', "k,v,x\r", "   ", 'k,v,"open', 'k,v"w"x,y', 'k,"v"w,"x"']
)
def test_files_that_quotes_do_not_tell_are_read_whole(spark, tmp_path, monkeypatch, small_splits, line):
    rng = random.Random(2)
    (tmp_path / "a_t.csv").write_text(text(rng, 120) + line + "\n" + text(rng, 60), newline="")
    (tmp_path / "b_t.csv").write_text(text(rng, 120))
    files = paths.data_files(spark, str(tmp_path))
    assert raw_module.split_files(spark, files) == files[1:]
    cut, whole = both_ways(spark, monkeypatch, str(tmp_path), False)
    assert cut == whole


def test_a_long_record_leaves_its_file_to_one_task(spark, tmp_path, monkeypatch, small_splits):
    (tmp_path / "a_t.csv").write_text(text(random.Random(3), 100))
    monkeypatch.setattr(records, "LONGEST", 5000)
    assert raw_module.split_files(spark, paths.data_files(spark, str(tmp_path))) == []
