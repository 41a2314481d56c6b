from martloom.sources.catalog import append_table, save_table


def test_replace_with_another_schema_and_append(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS martloom_test")
    path = str(tmp_path / "t")
    save_table(spark.range(3), "martloom_test", path=path)
    two = spark.range(4).selectExpr("id", "cast(id % 2 AS int) AS part")
    save_table(two, "martloom_test", partition_by=["part"], path=path)
    assert spark.catalog.tableExists("martloom_test")
    assert spark.table("martloom_test").columns == ["id", "part"]
    assert spark.table("martloom_test").where("part = 1").count() == 2
    spark.sql("DROP TABLE martloom_test")


def test_append_creates_on_first_use(spark, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS martloom_db CASCADE")
    spark.sql(f"CREATE DATABASE martloom_db LOCATION '{tmp_path / 'db'}'")
    for _ in range(2):
        append_table(spark.range(2), "martloom_db.log")
    assert spark.table("martloom_db.log").count() == 4
    spark.sql("DROP DATABASE martloom_db CASCADE")
