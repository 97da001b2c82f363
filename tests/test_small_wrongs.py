"""Ids with fractions, CSV files whose headers differ, manifests of several files, bad entries."""

import pytest
from pyspark.sql import functions as F

from tablesync import load_manifest, normalise_key, table_of_file
from tablesync.plans.manifest import entries
from tablesync.sources.files import read_csv_strings


def test_numeric_ids_do_not_round(spark):
    texts = ["7", "07.0", "7.4", "6.6", "x", None, "12345678901234567890123456789012345678"]
    df = spark.createDataFrame([(t,) for t in texts], "k string")
    got = [r[0] for r in df.select(normalise_key(F.col("k"), "numeric").cast("string")).collect()]
    assert got == ["7", "7", None, None, None, None, texts[-1]]


def test_csv_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("x,y\n3,4\n")
    assert read_csv_strings(spark, str(tmp_path)).count() == 2
    (tmp_path / "c.csv").write_text("y,x\n5,6\n")
    with pytest.raises(Exception, match="header"):
        read_csv_strings(spark, str(tmp_path)).collect()


def test_all_files_of_a_manifest_and_their_problems(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "a.yml").write_text("- {tablename: s.one, gcptable: one, read_parts: four}\n")
    (tmp_path / "b.yml").write_text("- {tablename: s.two, gcptable: '', action: append}\n- {tablename: s.three, gcptable: three}\n")
    found = entries(load_manifest(spark, f"{tmp_path}/*.yml"))
    assert [e.tablename for e in found] == ["s.one", "s.two", "s.three"]
    assert "read_parts" in found[0].problem and "gcptable" in found[1].problem and found[2].problem is None


def test_the_table_of_a_file(spark):
    names = ["orders__2024.csv.gz", "orders.v2__x.csv", "a_b", "__x", None]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert [r[0] for r in df.select(table_of_file("f")).collect()] == ["orders", "orders", "a_b", "", None]
