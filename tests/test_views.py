from martloom.sources.raw import read_raw
from martloom.sources.registry import SOURCES
from martloom.workload import views

TABLES = {
    "nation": ("n_nationkey long, n_name string", [(1, "North"), (2, "West")]),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
        [(50, 1, "F", None), (51, 97, "O", None)],
    ),
    "customer": ("c_custkey long, c_nationkey long", [(1, 1), (37, 2)]),
    "supplier": ("s_suppkey long, s_nationkey long", [(1, 2), (41, 1)]),
    "part": ("p_partkey long, p_type string", [(1, 'one, "two"'), (20, "ECONOMY"), (21, "")]),
    "events": ("event_id long, user_id long, event_type string, value double", [(1, 5, "view", 3.5), (2, 5, "error", 1.0)]),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
        [(50, 1, 1, 1, 2.0, 10.5, 0.1, "A", None), (51, 13, 7, 1, 1.0, 3.25, 0.0, "N", None)],
    ),
}


def test_sources_are_exported_packed_with_the_same_rows(spark, tmp_path, rows):
    for name, (ddl, data) in TABLES.items():
        spark.createDataFrame(data, ddl).write.parquet(str(tmp_path / "in" / f"{name}.parquet"))
    raw = tmp_path / "raw"
    views.export_raw(spark, str(tmp_path / "in"), str(raw))
    for name, text in views.raw_tables(spark, str(tmp_path / "in")).items():
        files = {f.name for f in raw.glob(f"{SOURCES[name].files}/part-*")}
        # The reader cuts large files of the source with line breaks in fields, so these stay plain.
        assert files and all(f.endswith(".csv" if SOURCES[name].multi_line else ".csv.gz") for f in files)
        got = read_raw(spark, str(raw), SOURCES[name]).select(*text.columns)
        assert rows(got.na.fill("")) == rows(text.na.fill(""))


def test_packed_files_have_a_million_rows_at_most(spark, tmp_path):
    text = spark.range(0, 2_100_000, 1, 1).selectExpr("cast(id as string) id")
    views.write_raw(text, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("part-*.csv.gz"))) == 3
