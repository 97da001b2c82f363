import io
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablesync import (
    Connections, UnknownServer, catalog_columns, conform, declared_type, expand_archives, parse_run_logs, read_csv_strings,
    read_files, read_parquet_tree, read_table, read_whole_text, scrub_delims,
)
from tablesync.sources import archives


def test_csv_is_all_text(spark, tmp_path):
    file = tmp_path / "in.csv"
    file.write_text(" id , name,day \n01,a,2024-01-01\n2,,\n")
    df = read_csv_strings(spark, str(file))
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema] == [
        ("id", "string", True), ("name", "string", True), ("day", "string", True)]
    assert [tuple(r) for r in df.collect()] == [("01", "a", "2024-01-01"), ("2", None, None)]


def test_whole_text(spark, tmp_path):
    (tmp_path / "a.sql").write_text("select 1;\nselect 2\r\n")
    (tmp_path / "b.sql").write_text("select 3")
    (tmp_path / "c.sql").write_text("")  # Spark gives no row for a file without bytes
    rows = {r["path"].rsplit("/", 1)[1]: r["text"] for r in read_whole_text(spark, f"{tmp_path}/*.sql").collect()}
    assert rows == {"a.sql": "select 1;\nselect 2\r\n", "b.sql": "select 3"}


def test_parquet_tree_and_formats(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "x" / "y"))
    spark.range(3, 5).write.parquet(str(tmp_path / "z"))
    (tmp_path / "z" / "note.txt").write_text("not parquet")
    assert read_parquet_tree(spark, str(tmp_path)).count() == 5
    spark.range(2).write.json(str(tmp_path / "j"))
    assert read_files(spark, str(tmp_path / "j"), "json").count() == 2


def _zip(members):
    stream = io.BytesIO()
    with zipfile.ZipFile(stream, "w") as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return stream.getvalue()


def test_archives(spark, tmp_path, monkeypatch):
    (tmp_path / "a.zip").write_bytes(_zip({"one.txt": b"1", "sub/two.txt": b"22", "none.txt": b""}))
    (tmp_path / "b.zip").write_bytes(b"not a zip archive")
    (tmp_path / "c.zip").write_bytes(_zip({}))
    rows = expand_archives(spark, f"{tmp_path}/*.zip").collect()
    assert sorted((r["archive"].rsplit("/", 1)[1], r["member"], r["part"], bytes(r["content"])) for r in rows) == [
        ("a.zip", "none.txt", 0, b""), ("a.zip", "one.txt", 0, b"1"), ("a.zip", "sub/two.txt", 0, b"22")]


def test_long_members_come_in_parts(monkeypatch):
    monkeypatch.setattr(archives, "PART_BYTES", 4)
    content = _zip({"long": b"0123456789", "short": b"x", "even": b"01234567"})
    frames = list(archives._members(iter([pd.DataFrame({"path": ["a.zip", "b"], "content": [content, b"x"]})])))
    rows = [tuple(r) for f in frames for r in f.itertuples(index=False)]
    assert [(m, p) for _, m, p, _ in rows] == [("long", 0), ("long", 1), ("long", 2), ("short", 0), ("even", 0), ("even", 1)]
    assert b"".join(c for _, m, _, c in rows if m == "long") == b"0123456789"
    assert max(f["content"].map(len).sum() for f in frames) <= 8


def test_run_log(spark, tmp_path):
    (tmp_path / "run.log").write_text(
        "2024-02-03 19:50:51.816770 - sales.accounts Starting\n"
        "2024-02-03 19:50:53.578064 - sales.accounts Target table:accounts  upd_ts Max date = 2024-01-06 03:09:03\n"
        "2024-02-03 19:51:00.438316 - sales.accounts Rows to load = 3140759\n"
        "2024-02-03 19:51:02 - sales.accounts Getting data from source\n"
        "2024-02-03 19:51:03 - sales.accounts Writing parquet data to output directory.\n"
        "2024-02-03 19:52:03 - sales.accounts Total rows added for a.b.accounts = -5 for a total table count of 12\n"
        "2024-02-03 19:53:03 - sales.lists No date comparison, copying full table\n"
        "2024-02-03 19:53:04 - sales.empty does not have any new rows to upload.\n"
        "Traceback\n"
    )
    rows = parse_run_logs(spark, f"{tmp_path}/*.log").orderBy("logged_at").collect()
    assert [r["event"] for r in rows] == ["start", "watermark", "count", "extract", "stage", "loaded", "full", "up_to_date"]
    assert rows[0]["logged_at"].microsecond == 816770
    assert rows[1]["watermark"] == "2024-01-06 03:09:03"
    assert rows[2]["rows_to_load"] == 3140759
    assert (rows[5]["rows_added"], rows[5]["rows_total"]) == (-5, 12)


def test_catalog_columns(spark):
    spark.sql("CREATE OR REPLACE TEMP VIEW cols AS SELECT 1 AS a, 'x' AS b, cast(1 AS decimal(5,2)) AS c")
    assert [tuple(r) for r in catalog_columns(spark, ["cols"]).collect()] == [
        ("cols", 1, "a", "int", "Nullable", "a"), ("cols", 2, "b", "string", "Nullable", "b"),
        ("cols", 3, "c", "decimal(5,2)", "Nullable", "c")]


def test_read_table_takes_names_and_queries(spark):
    spark.range(4).createOrReplaceTempView("four")
    assert read_table(spark, "four").count() == 4
    assert read_table(spark, " select * from four where id > 1 ").count() == 2


def test_connections(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    spark.range(4).createOrReplaceTempView("four")
    conns = Connections(spark, {" Files ": {"format": "parquet", "path": f"{tmp_path}/{{table}}.parquet"}, "lake": {"format": "table"}})
    assert conns.read("FILES", "t").count() == 3
    assert conns.read("lake", "four").count() == 4
    for name in ("other", None):
        with pytest.raises(UnknownServer):
            conns.read(name, "t")


def test_scrub(spark):
    df = spark.createDataFrame([(1, "a\nb\r\x01c\t", "x\n"), (2, None, "y")], "id int, s string, t string")
    assert [tuple(r) for r in scrub_delims(df).collect()] == [(1, "abc\t", "x"), (2, None, "y")]
    assert scrub_delims(df, ["s"]).first()["t"] == "x\n"
    with pytest.raises(ValueError):
        scrub_delims(df, ["id"])


@pytest.mark.parametrize(
    ("declared", "expected"),
    [("string", "string"), ("str", "string"), ("INTEGER", "decimal(38,0)"), ("long", "bigint"), ("FLOAT", "decimal(20,5)"),
     ("date", "timestamp_ntz"), ("decimal(9, 2)", "decimal(9,2)"), ("timestamp-micros", "string")],
)
def test_declared_types(declared, expected):
    assert declared_type(declared) == expected


def test_conform(spark):
    df = spark.createDataFrame([("7", 1.234567, "2024-01-02")], "a string, b double, c string")
    out = conform(df.withColumn("c", F.to_date("c")), {"a": "INTEGER", "b": "FLOAT", "c": "date"})
    assert [f.dataType.simpleString() for f in out.schema] == ["decimal(38,0)", "decimal(20,5)", "timestamp_ntz"]
    assert [str(v) for v in out.first()] == ["7", "1.23457", "2024-01-02 00:00:00"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, {"c": "INTEGER"}).collect()
    with pytest.raises(ValueError):
        conform(df, {"z": "long"})
