"""New files only, marks from footers, even splits, nested fields, buckets and scripts with blocks."""

import pytest
from pyspark.sql import functions as F

from tablesync import (
    anti_join_bucketed, bucketed, even_bounds, even_predicates, footer_marks, load_new_files, load_table, read_target, run_script,
)
from tablesync.plans.sqljob import statements


def test_a_second_run_reads_new_files_only(spark, tmp_path):
    inbox, target, log = (str(tmp_path / x) for x in ("in", "out", "log"))
    df = spark.range(10).toDF("k")
    df.write.mode("append").parquet(inbox)
    assert load_new_files(spark, inbox, target, log, df.schema, files_per_batch=1) == 10
    assert load_new_files(spark, inbox, target, log, df.schema) == 0
    spark.range(10, 13).toDF("k").write.mode("append").parquet(inbox)
    assert load_new_files(spark, inbox, target, log, df.schema, change=lambda d: d.withColumn("k", F.col("k") * 10)) == 3
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == [*range(10), 100, 110, 120]


def test_marks_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "CASE WHEN id > 5 THEN timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id, 0) END AS at", "cast(id AS string) AS s", "date_add(date'2020-01-01', cast(id AS int)) AS d").write.parquet(path)
    found = footer_marks(spark, path, "at")
    assert found.first().asDict() == {"watermark": "2024-01-01 16:39:00", "rows": 1000}
    for column, mark in (("id", "999"), ("d", "2022-09-26")):
        found = footer_marks(spark, path, column)
        assert found.first().asDict() == {"watermark": mark, "rows": 1000}
        assert f"PushedAggregation: [MAX({column}), COUNT(*)]" in found._jdf.queryExecution().toString()
    assert footer_marks(spark, path, "s").first()["watermark"] == "999"  # read, as footers may cut texts
    empty = str(tmp_path / "e")
    spark.range(0).write.parquet(empty)
    assert footer_marks(spark, empty, "id").first().asDict() == {"watermark": "1970-01-01 00:00:00", "rows": 0}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_splits_are_even_on_a_skewed_column(spark):
    rows = spark.range(20_000).selectExpr("CASE WHEN id % 40 = 0 THEN NULL ELSE exp(id / 2000.0) END AS v", "date_add(date'2020-01-01', cast(sqrt(id) AS int)) AS d", "id % 2 AS b")
    parts = [rows.where(p).count() for p in even_predicates(rows, "v", 8)]
    assert sum(parts) == 20_000 and parts[-1] == 500
    assert all(abs(n - 19_500 / 8) <= 0.1 * 19_500 / 8 for n in parts[:-1])
    assert sum(rows.where(p).count() for p in even_predicates(rows, "d", 5)) == 20_000
    assert even_bounds(rows, "b", 8) == [0, 1] and sum(rows.where(p).count() for p in even_predicates(rows, "b", 8)) == 20_000
    nothing = rows.where("v IS NULL")
    assert even_bounds(nothing, "v", 4) == [] and sum(nothing.where(p).count() for p in even_predicates(nothing, "v", 4)) == 500


@pytest.mark.parametrize("kind", ["path", "table"])
def test_fields_are_added_inside_structs(spark, tmp_path, kind):
    target = str(tmp_path / "t") if kind == "path" else "default.nested_fields"
    first = spark.sql("SELECT 1 AS k, named_struct('x', 1) AS s, array(named_struct('a', 1)) AS l")
    more = spark.sql("SELECT 2 AS k, named_struct('y', 'two', 'X', 2) AS s, array(named_struct('b', 2.5D, 'a', 2), NULL) AS l, 'new' AS n")
    load_table(first, target, "empty", location=str(tmp_path / "tables"))
    with pytest.raises(ValueError, match="s.y"):
        load_table(more, target, "append")
    load_table(more, target, "append", add_columns=True)
    load_table(first.withColumn("s", F.lit(None).cast("struct<x:int>")), target, "append")
    got = sorted((r.asDict(recursive=True) for r in read_target(spark, target).collect()), key=str)
    assert got == sorted([
        {"k": 1, "s": {"x": 1, "y": None}, "l": [{"a": 1, "b": None}], "n": None},
        {"k": 2, "s": {"x": 2, "y": "two"}, "l": [{"a": 2, "b": 2.5}, None], "n": "new"},
        {"k": 1, "s": None, "l": [{"a": 1, "b": None}], "n": None},
    ], key=str)
    with pytest.raises(ValueError, match="s"):
        load_table(spark.sql("SELECT named_struct('x', 2.5D) AS s"), target, "append")
    spark.sql("DROP TABLE IF EXISTS default.nested_fields")


def test_buckets_meet_without_a_shuffle(spark, tmp_path):
    source = spark.range(1000).selectExpr("CASE WHEN id % 3 > 0 THEN id % 50 END AS k", "id")
    listed = spark.range(0, 50, 7).selectExpr("id AS r").union(spark.sql("SELECT cast(NULL AS bigint)"))
    kept = [bucketed(df, f"default.b_{c}", c, 4, str(tmp_path / c)) for df, c in ((source, "k"), (listed, "r"))]
    joined = anti_join_bucketed(*kept, "k", "r")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert {r["id"] for r in joined.collect()} == {i for i in range(1000) if i % 3 == 0 or i % 50 % 7}
    for c in ("k", "r"):
        spark.sql(f"DROP TABLE default.b_{c}")


def test_a_load_counts_once_it_is_committed(spark, tmp_path):
    """A driver that stops between the write and the marker leaves nothing that is read."""
    target = str(tmp_path / "t")
    load_table(spark.range(5).toDF("k"), target, "empty")
    spark.range(3).toDF("k").write.parquet(f"{target}/00000002-append")
    assert read_target(spark, target).count() == 5
    load_table(spark.range(2).toDF("k"), target, "append")
    assert read_target(spark, target).count() == 7


def test_blocks_stay_whole(spark):
    block = "BEGIN DECLARE n INT DEFAULT 0; lp: WHILE n < 3 DO SET n = n + 1; END WHILE lp; CASE n WHEN 3 THEN SELECT CASE WHEN n > 1 THEN ';' END AS a; END CASE; BEGIN SELECT n AS n; END; END"
    text = f"SELECT 1 AS begin; -- BEGIN\n /* BEGIN; */ {block}; SELECT CASE WHEN 1 > 0 THEN 'END;' END AS c;; SELECT 2"
    parts = statements(text)
    assert [p[-len(block):] if "DECLARE" in p else p for p in parts] == ["SELECT 1 AS begin", block, "SELECT CASE WHEN 1 > 0 THEN 'END;' END AS c", "SELECT 2"]
    assert run_script(spark, text)[1].result.collect()[0][0] == 3
