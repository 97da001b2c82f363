import os
from functools import partial

import pytest
from pyspark.sql import functions as F

from tablesync import (
    Connections, Watermark, bind_query, load_manifest, load_table, manifest_rows, plan_manifest, read_target, run_script,
    sql_template, sync_manifest, sync_report,
)
from tablesync.plans import sync
from tablesync.plans.manifest import RAW_SCHEMA, entries
from tablesync.plans.sqljob import statements

YAML = """
- action: Append
  datecolumn: Snapshot_DT
  dntl: CUST_ID
  gcptable: Contracts_Master
  query: ' select t1.* from $1 t1 where $2 > ''$3'''
  server: SRC01
  splitby:
  tablename: DW.contracts.dbo.Contracts_Master
- action: truncate
  datecolumn:
  dntl: None
  gcptable: small
  query: 'select * from $1'
  server: src01
  splitby: Source
  tablename: small
"""


def test_yaml_manifest(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "m.yml").write_text(YAML)
    first, second = load_manifest(spark, str(tmp_path / "m.yml")).collect()
    assert first["action"] == "append" and first["datecolumn"] == "snapshot_dt" and first["dntl"] == "CUST_ID"
    assert first["gcptable"] == "contracts_master" and first["server"] == "src01" and first["splitby"] is None
    assert first["query"] == "select t1.* from $1 t1 where $2 > '$3'"
    assert (first["tablename"], first["name"]) == ("dw.contracts.dbo.contracts_master", "contracts_master")
    assert second["datecolumn"] is None and second["dntl"] is None and second["splitby"] == "source"
    assert [e.pattern for e in entries(load_manifest(spark, str(tmp_path / "m.yml")))] == ["incremental", "full"]


def test_csv_manifest(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        'server, tablename,gcptable,datecolumn,action,query\n'
        'SRC,A.b, T ,,append,"select a, ""b""\nfrom $1"\n'
        "SRC,c,U,nan,,\n"
    )
    first, second = load_manifest(spark, str(tmp_path / "m.csv")).collect()
    assert (first["datecolumn"], first["gcptable"], first["name"]) == (None, "t", "b")
    assert first["query"] == 'select a, "b"\nfrom $1'
    assert first["dntl"] is None and second["datecolumn"] is None and second["query"] is None


def entry(**fields):
    values = {"action": "append", "server": "files", "tablename": "src", "gcptable": "target", **fields}
    return tuple(values.get(f) for f in RAW_SCHEMA.names)


def manifest(spark, *rows):
    return manifest_rows(spark.createDataFrame(list(rows), RAW_SCHEMA))


@pytest.mark.parametrize(
    ("fields", "pattern"),
    [
        ({}, "full"),
        ({"action": "truncate"}, "full"),
        ({"datecolumn": "upd"}, "incremental"),
        ({"datecolumn": "upd", "query": "select * from $1 where $2 > '$3'"}, "incremental"),
        ({"datecolumn": "upd", "action": "truncate"}, "delta_replace"),
        ({"datecolumn": "upd", "action": "truncate", "query": "select * from $1 where $2 > '$3'"}, "delta_replace"),
        ({"datecolumn": "upd", "action": "truncate", "query": "select * from $1"}, "gated"),
        ({"datecolumn": "upd", "action": "truncate", "extract": "full"}, "gated"),
    ],
)
def test_patterns(spark, fields, pattern):
    assert entries(manifest(spark, entry(**fields)))[0].pattern == pattern


class Source:
    """A source folder that tests add rows to, and a list in the catalog."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path, self.root = spark, str(tmp_path / "src"), str(tmp_path / "targets")
        spark.createDataFrame([("2",), (None,)], "rid string").createOrReplaceTempView("listed")
        self.conns = Connections(spark, {"files": {"format": "parquet", "path": f"{tmp_path}/{{table}}"}, "lists": {"format": "table"}})

    def add(self, first, last):
        rows = self.spark.range(first, last).select(
            "id", F.when(F.col("id") % 5 > 0, (F.col("id") % 3).cast("string")).alias("cust"),
            F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int))").alias("upd"))
        rows.coalesce(1).write.mode("append").parquet(self.path)

    def sync(self, *rows, **options):
        return sync_manifest(self.spark, manifest(self.spark, *rows), self.conns, self.root, **options).collect()

    def held(self, target="target"):
        return sorted(r["id"] for r in read_target(self.spark, f"{self.root}/{target}").collect())


@pytest.fixture
def source(spark, tmp_path):
    out = Source(spark, tmp_path)
    out.add(0, 10)
    return out


RESTRICTED = {"dntl": "CUST", "restrict_server": "lists", "restrict_table": "listed", "restrict_key": "rid"}


def allowed(first, last):
    return [i for i in range(first, last) if i % 5 == 0 or i % 3 != 2]


def test_runs_pick_up_where_the_last_one_ended(source):
    row = entry(datecolumn="UPD", **RESTRICTED)
    first = source.sync(row)[0]
    assert (first["watermark"], first["rows_to_load"], first["rows_written"]) == ("1970-01-01 00:00:00", 10, len(allowed(0, 10)))
    assert source.held() == allowed(0, 10)
    again = source.sync(row)[0]
    assert (again["status"], again["rows_to_load"], again["rows_written"]) == ("up_to_date", 0, None)
    source.add(10, 14)
    third = source.sync(row)[0]
    assert (third["watermark"], third["rows_to_load"], third["rows_before"]) == ("2024-01-10 00:00:00", 4, len(allowed(0, 10)))
    assert source.held() == allowed(0, 14)


def test_full_gated_and_delta(source):
    full = entry(action="truncate", gcptable="full")
    gated = entry(action="truncate", datecolumn="upd", extract="full", gcptable="gated")
    delta = entry(action="truncate", datecolumn="upd", gcptable="delta")
    source.sync(full, gated, delta)
    source.add(10, 12)
    audit = source.sync(full, gated, delta)
    assert [r["status"] for r in audit] == ["loaded"] * 3
    assert source.held("full") == source.held("gated") == list(range(12))
    assert source.held("delta") == [10, 11]
    audit = source.sync(full, gated, delta)
    assert [r["status"] for r in audit] == ["loaded", "up_to_date", "up_to_date"]
    assert source.held("delta") == [10, 11]


def test_one_failing_entry_does_not_stop_the_rest(source):
    audit = source.sync(
        entry(gcptable="a", server="nowhere"),
        entry(gcptable="b", tablename="absent", datecolumn="upd"),
        entry(gcptable="c", datecolumn="no_such_column"),
        entry(gcptable="d", datecolumn="upd"),
        entry(gcptable="d", action="other"),
        parallel=4,
    )
    assert [r["position"] for r in audit] == [1, 2, 3, 4, 5]
    assert [r["status"] for r in audit] == ["error", "error", "error", "loaded", "error"]
    assert audit[0]["error"].startswith("UnknownServer") and audit[4]["error"].startswith("TargetNotEmpty")


def test_a_sync_leaves_no_intermediates(source, spark, monkeypatch):
    """Lists, counts and copies go after the run, also where an entry fails."""
    shared = f"{spark.conf.get('spark.checkpoint.dir')}/tablesync"
    before = os.listdir(shared) if os.path.isdir(shared) else []
    monkeypatch.setattr(sync, "anti_join", partial(sync.anti_join, limit=0))
    audit = source.sync(entry(datecolumn="upd", **RESTRICTED), entry(gcptable="b", **RESTRICTED),
                        entry(gcptable="c", splitby="absent", **RESTRICTED), parallel=2)
    assert [r["status"] for r in audit] == ["loaded", "loaded", "error"]
    assert source.held() == source.held("b") == allowed(0, 10)
    assert sorted(os.listdir(shared)) == sorted(before)


def test_new_columns_and_the_report_date_as_options(source, spark):
    """An entry may let new columns in, and names the column whose largest value is reported."""
    options = {"datecolumn": "upd", "report_col": "upd"}
    assert source.sync(entry(**options))[0]["report_max"] == "2024-01-10 00:00:00"
    wider = "select *, id * 2 as added from $1 where $2 > '$3'"
    source.add(10, 12)
    assert source.sync(entry(query=wider, **options))[0]["error"].startswith("ValueError: columns not in")
    audit = source.sync(entry(query=wider, add_columns="true", **options))[0]
    assert (audit["status"], audit["report_max"]) == ("loaded", "2024-01-12 00:00:00")
    rows = read_target(spark, f"{source.root}/target")
    assert sorted(r["added"] for r in rows.where("added is not null").collect()) == [20, 22]


def test_a_failure_has_no_mark(source):
    assert source.sync(entry(gcptable="a", server="nowhere"))[0]["watermark"] is None


def test_an_error_in_the_target_does_not_reload_it(source, spark):
    """Only a missing or empty target starts at the epoch."""
    load_table(spark.range(3), f"{source.root}/target")
    assert source.sync(entry(datecolumn="upd"))[0]["status"] == "error"
    assert source.held() == [0, 1, 2]


def test_staged_by_partition_keeps_values(source, spark):
    source.sync(entry(action="truncate", splitby="cust"))
    rows = read_target(spark, f"{source.root}/target")
    assert dict(rows.dtypes)["cust"] == "string" and source.held() == list(range(10))
    assert rows.where("cust is null").count() == 2


def test_catalog_targets(source, spark):
    source.root = "default"
    try:
        row = entry(datecolumn="upd", gcptable="SYNC_catalog_target")
        source.sync(row)
        source.add(10, 11)
        assert source.sync(row)[0]["rows_total"] == 11
        assert spark.table("default.sync_catalog_target").count() == 11
    finally:
        spark.sql("DROP TABLE IF EXISTS default.sync_catalog_target")


def test_audit_log_and_report(source, spark):
    log = f"{source.root}/audit_log"
    rows = [entry(datecolumn="upd", gcptable="a"), entry(datecolumn="upd", gcptable="b", extract="full")]
    first = sync_manifest(spark, manifest(spark, *rows), source.conns, source.root, audit_target=log)
    assert sorted(r["message"] for r in sync_report(first).collect()) == [
        f"{t} : Last date: 1970-01-01 00:00:00" for t in ("a", "b")]
    second = sync_manifest(spark, manifest(spark, *rows), source.conns, source.root, audit_target=log)
    assert [r["message"] for r in sync_report(second).collect()] == ["Tables are up to date."]
    assert read_target(spark, log).count() == 4


def test_plan_loads_nothing(source, spark):
    rows = [entry(datecolumn="upd", query="select * from $1 where $2 > '$3'"), entry(gcptable="x", server="nowhere")]
    plan = plan_manifest(spark, manifest(spark, *rows), source.conns, source.root).collect()
    assert plan[0]["query"] == "select * from src where upd > '1970-01-01 00:00:00'"
    assert [(r["status"], r["rows_to_load"]) for r in plan] == [("pending", 10), ("error", None)]
    assert read_target(spark, f"{source.root}/target") is None


def test_sql_entries_run_in_spark(source):
    query = "select t1.* from $1 t1 left join listed r on t1.cust = r.rid where r.rid is null and $2 > '$3'"
    source.sync(entry(datecolumn="upd", query=query))
    source.add(10, 14)
    assert source.sync(entry(datecolumn="upd", query=query))[0]["rows_written"] == len(allowed(10, 14))
    assert source.held() == allowed(0, 14)


def test_placeholders(spark):
    assert bind_query("$1 $10 $2 '$3'", "t", "c", "m") == "t $10 c 'm'"
    assert bind_query("select * from $1", "t") == "select * from t"
    spark.range(5).selectExpr("id", "date_add(date'2024-01-01', cast(id as int)) AS d").createOrReplaceTempView("days")
    mark = Watermark("2024-01-03")
    assert sql_template(spark, "select * from $1 where $2 > '$3'", "days", "d", mark).count() == 2
    assert sql_template(spark, "select * from IDENTIFIER(:table) where IDENTIFIER(:column) > :mark", "days", "d", mark).count() == 2
    hostile = Watermark("2024-01-03' or '1'='1")
    with pytest.raises(Exception):
        sql_template(spark, "select * from $1 where $2 > '$3'", "days", "d", hostile).collect()


def test_statements():
    text = """select 'a;b' as x; -- no; split
    ;
    select "c;d", `e;f` /* g;h */ from t where y = 'it''s;';
    -- only a comment;
    """
    assert statements(text) == [
        "select 'a;b' as x",
        """select "c;d", `e;f` /* g;h */ from t where y = 'it''s;'""",
    ]


def test_script(spark):
    out = run_script(spark, "create or replace temp view one as select 1 as a;\nselect * from one;\nselect * from one where a > 1;")
    assert [r.message for r in out] == ["Statement complete", None, "Statement complete"]
    assert out[1].result.first()["a"] == 1
    with pytest.raises(Exception):
        run_script(spark, "select 1; selec 2")
