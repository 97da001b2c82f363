import os

import pytest
from pyspark.sql import functions as F

from tablesync import TargetNotEmpty, load_audit, load_table, read_files, read_target, remove_replaced, stage
from tablesync.operators.load import PathTarget


@pytest.fixture(params=["path", "table"])
def target(request, spark, tmp_path):
    if request.param == "path":
        yield str(tmp_path / "target")
    else:
        name = f"default.t_{os.path.basename(tmp_path).replace('-', '_')}"
        yield name
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def numbers(spark, first, last):
    return spark.range(first, last).select("id", F.concat(F.lit("n"), "id").alias("name"))


def held(spark, target):
    return sorted(map(tuple, read_target(spark, target).collect()))


def test_first_load_and_append(spark, target):
    assert read_target(spark, target) is None
    first = load_table(numbers(spark, 0, 3), target)
    assert (first.rows_before, first.rows_written, first.rows_total, first.net_change) == (0, 3, 3, 3)
    second = load_table(numbers(spark, 2, 5), target, "append", report_col="id")
    assert (second.rows_before, second.rows_written, second.rows_total) == (3, 3, 6)
    assert second.report_max == "4"
    assert held(spark, target) == [(0, "n0"), (1, "n1"), (2, "n2"), (2, "n2"), (3, "n3"), (4, "n4")]


def test_append_goes_by_name(spark, target):
    load_table(numbers(spark, 0, 1), target)
    load_table(numbers(spark, 1, 2).select("name", F.col("id").alias("ID")), target, "append")
    assert held(spark, target) == [(0, "n0"), (1, "n1")]


def test_truncate_keeps_columns_and_may_read_its_own_target(spark, target):
    load_table(numbers(spark, 0, 5), target)
    out = load_table(read_target(spark, target).where("id > 3").select("id"), target, "truncate")
    assert held(spark, target) == [(4, None)]
    assert (out.rows_before, out.rows_written, out.net_change) == (5, 1, -4)


def test_empty_load(spark, target):
    load_table(numbers(spark, 0, 0), target)
    assert read_target(spark, target).count() == 0
    load_table(numbers(spark, 0, 2), target)  # there, but without rows
    with pytest.raises(TargetNotEmpty):
        load_table(numbers(spark, 0, 2), target)
    assert len(held(spark, target)) == 2


def test_recreate_replaces_columns(spark, target):
    load_table(numbers(spark, 0, 2), target)
    load_table(spark.range(2).select(F.col("id").alias("other")), target, "recreate")
    assert held(spark, target) == [(0,), (1,)]
    assert read_target(spark, target).columns == ["other"]


def test_new_columns_need_leave(spark, target):
    load_table(numbers(spark, 0, 1), target)
    wider = numbers(spark, 1, 2).withColumn("added", F.lit(1.5))
    with pytest.raises(ValueError, match="added"):
        load_table(wider, target, "append")
    load_table(wider, target, "append", add_columns=True)
    load_table(numbers(spark, 2, 3), target, "append")
    assert sorted(held(spark, target), key=lambda r: r[0]) == [(0, "n0", None), (1, "n1", 1.5), (2, "n2", None)]


def test_failed_load_leaves_the_target(spark, target):
    load_table(numbers(spark, 0, 3), target)
    before = held(spark, target)
    broken = numbers(spark, 0, 9).withColumn("name", F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise("x"))
    for mode in ("append", "truncate", "recreate"):
        with pytest.raises(Exception, match="lost"):
            load_table(broken, target, mode)
        spark.catalog.clearCache()
        assert held(spark, target) == before


def test_replaced_data_can_be_removed(spark, target):
    load_table(numbers(spark, 0, 3), target)
    load_table(numbers(spark, 3, 5), target, "append")
    assert remove_replaced(spark, target) == 0
    load_table(numbers(spark, 5, 6), target, "truncate")
    load_table(numbers(spark, 6, 7), target, "recreate")
    load_table(numbers(spark, 7, 8), target, "append")
    before = remove_replaced(spark, target)
    assert before == (3 if "/" in target else 2)
    assert remove_replaced(spark, target) == 0
    assert held(spark, target) == [(6, "n6"), (7, "n7")]


def test_removal_spares_what_is_not_ours(spark, tmp_path):
    """A table made elsewhere has neighbours, and a plain folder has its own files."""
    numbers(spark, 0, 2).write.option("path", str(tmp_path / ("a" * 32))).saveAsTable("default.made_elsewhere")
    numbers(spark, 0, 2).write.parquet(str(tmp_path / ("b" * 32)))
    assert remove_replaced(spark, "default.made_elsewhere") == 0
    assert remove_replaced(spark, str(tmp_path / ("b" * 32))) == 0
    spark.sql("DROP TABLE default.made_elsewhere")


def test_unfinished_load_is_not_read(spark, tmp_path):
    target = str(tmp_path / "target")
    load_table(numbers(spark, 0, 3), target)
    numbers(spark, 10, 20).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).parquet(f"{target}/00000002-append")
    assert len(held(spark, target)) == 3
    load_table(numbers(spark, 3, 4), target, "append")  # takes the next number
    assert len(held(spark, target)) == 4


def test_plain_parquet_folder_as_target(spark, tmp_path):
    """A folder other tools wrote is the first load of the target."""
    target = str(tmp_path / "target")
    numbers(spark, 0, 3).write.parquet(target)
    out = load_table(numbers(spark, 3, 5), target, "append")
    assert out.rows_total == 5 and len(held(spark, target)) == 5
    load_table(numbers(spark, 5, 6), target, "truncate")
    assert held(spark, target) == [(5, "n5")]


def test_partitioned_table(spark, tmp_path):
    name = "default.partitioned_target"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    first = numbers(spark, 0, 4).withColumn("day", F.concat(F.lit("0"), F.col("id") % 2))
    first.write.format("parquet").option("path", str(tmp_path / "t")).partitionBy("day").saveAsTable(name)
    load_table(first.where("id = 0"), name, "append")
    assert read_target(spark, name).count() == 5
    load_table(read_target(spark, name).where("day = '01'"), name, "truncate", location=str(tmp_path / "new"))
    assert held(spark, name) == [(1, "n1", "01"), (3, "n3", "01")]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["day"]
    spark.sql(f"DROP TABLE {name}")


def test_stage_replaces_and_partitions(spark, tmp_path):
    path = str(tmp_path / "staged")
    stage(numbers(spark, 0, 9), path)
    stage(numbers(spark, 0, 4).withColumn("part", F.col("id") % 2), path, "part")
    assert sorted(d for d in os.listdir(path) if d[0] not in "._") == ["part=0", "part=1"]
    assert read_files(spark, path).count() == 4


def test_audit_rows(spark, tmp_path):
    target = str(tmp_path / "target")
    results = [load_table(numbers(spark, 0, 3), target), load_table(numbers(spark, 0, 1), target, "truncate")]
    rows = load_audit(spark, results).orderBy("position").collect()
    assert [(r["rows_before"], r["rows_written"], r["net_change"]) for r in rows] == [(0, 3, 3), (3, 1, -2)]


def test_a_small_part_of_many_tasks_gives_few_files(spark, tmp_path):
    path = str(tmp_path / "target")
    out = load_table(spark.range(0, 4000, 1, 40).where("id > 10"), path, rebalance=True)
    files = [f for d in os.listdir(path) for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")]
    assert out.rows_written == 3989 and len(files) == 1


def test_one_listing_however_many_loads(spark, tmp_path):
    target = PathTarget(spark, str(tmp_path / "target"))
    for i in range(4):
        load_table(numbers(spark, i, i + 1), target.name, "append")
    assert len(target._loads()) == 4
    assert held(spark, target.name) == [(i, f"n{i}") for i in range(4)]


@pytest.mark.parametrize("value, kind", [("1.7", "decimal(3,1)"), ("1.239", "decimal(5,3)"), ("2024-01-01 10:00:00", "timestamp_ntz"), ("5", "bigint"), ("0.1", "double")])
def test_an_append_that_could_change_values_fails(spark, tmp_path, value, kind):
    target = f"{tmp_path}/t"
    wanted = {"decimal(3,1)": "int", "decimal(5,3)": "decimal(10,2)", "timestamp_ntz": "date", "bigint": "int", "double": "float"}[kind]
    load_table(spark.sql(f"SELECT cast(null AS {wanted}) AS v"), target, "append")
    with pytest.raises(ValueError, match="v"):
        load_table(spark.sql(f"SELECT cast('{value}' AS {kind}) AS v"), target, "append")
    assert read_target(spark, target).count() == 1


def test_an_append_may_widen(spark, tmp_path):
    target = f"{tmp_path}/t"
    load_table(spark.sql("SELECT 1L AS a, 1.50BD AS b, 2.0D AS c, timestamp_ntz'2024-01-01 00:00:00' AS d"), target, "append")
    load_table(spark.sql("SELECT 2 AS a, 1.5BD AS b, 3 AS c, date'2024-02-01' AS d"), target, "append")
    assert sorted(str(r["a"]) + str(r["b"]) for r in read_target(spark, target).collect()) == ["11.50", "21.50"]


def test_rows_that_others_wrote_are_read_whole_or_not_touched(spark, tmp_path):
    import os

    plain, unmarked, parted = (f"{tmp_path}/{n}" for n in ("plain", "unmarked", "parted"))
    for path in (plain, unmarked):
        spark.range(10).write.parquet(path)
    os.remove(f"{unmarked}/_SUCCESS")
    spark.range(10).selectExpr("id", "id % 2 AS k").write.partitionBy("k").parquet(parted)
    assert load_table(spark.range(5), plain, "append").rows_total == 15
    for path in (unmarked, parted):
        with pytest.raises(ValueError):
            load_table(spark.range(5).selectExpr("id", "0 AS k") if path == parted else spark.range(5), path, "append")
        assert spark.read.parquet(path).count() == 10


def test_loads_without_sparks_marker_are_seen(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        results = [load_table(spark.range(5), f"{tmp_path}/t", "append") for _ in range(2)]
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert [r.rows_total for r in results] == [5, 10] and read_target(spark, f"{tmp_path}/t").count() == 10


def test_loads_know_their_rows(spark, tmp_path):
    """Only files of others are opened to count a target."""
    own, plain = f"{tmp_path}/own", f"{tmp_path}/plain"
    spark.range(3).write.parquet(plain)
    for target, before in ((own, 0), (plain, 3)):
        for i in range(2):
            out = load_table(spark.range(4), target, "append")
            assert (out.rows_before, out.rows_total) == (before + 4 * i, before + 4 * i + 4)
        opened = PathTarget(spark, target)
        assert opened.count() == before + 8 == opened.read().count() and len(opened._rows) == 2


def test_a_split_load_keeps_the_layout_and_the_values(spark, target):
    rows = spark.range(0, 400, 1, 8).selectExpr("id", "element_at(array('01', '1', '', null), cast(id % 4 as int) + 1) AS part")
    load_table(rows, target, split_by="part")
    load_table(rows.where("id < 8"), target, "append", split_by="part")
    load_table(rows.where("id = 1"), target, "append")
    found = read_target(spark, target)
    assert found.columns == ["id", "part"]
    assert {r["part"]: r["count"] for r in found.groupBy("part").count().collect()} == {"01": 102, "1": 103, "": 102, None: 102}
    if "/" in target:
        folders = [d for d in os.listdir(f"{target}/00000001-replace") if "=" in d]
        assert sorted(folders) == ["split_value=01", "split_value=1", "split_value=__HIVE_DEFAULT_PARTITION__"]


def test_files_of_a_partitioned_table_are_bounded(spark, tmp_path):
    name = "default.many_parts"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = spark.range(0, 4000, 1, 40).selectExpr("id", "id % 20 AS part")
    rows.limit(0).write.format("parquet").option("path", str(tmp_path / "t")).partitionBy("part").saveAsTable(name)
    assert load_table(rows, name, "append").rows_total == 4000
    files = [f for _, _, found in os.walk(tmp_path / "t") for f in found if f.endswith(".parquet")]
    assert len(files) <= 40
    spark.sql(f"DROP TABLE {name}")


def test_report_date_after_an_append_of_older_rows(spark, target):
    load_table(numbers(spark, 5, 9), target)
    assert load_table(numbers(spark, 0, 3), target, "append", report_col="id").report_max == "8"
    assert load_table(numbers(spark, 0, 0), target, "append", report_col="id").report_max == "8"
