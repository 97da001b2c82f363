from __future__ import annotations

from tablesync import Connections, load_table, manifest_rows, plan_manifest, read_target, sync_manifest, sync_report
from tablesync.plans.manifest import RAW_SCHEMA
from tablesync.session import new_path

from .registry import R_SQL, T_SQL, W_SQL, as_text, loaded_orders, orders, query, restricted

KEPT = f"o_custkey NOT IN (SELECT c_custkey FROM {R_SQL})"
NEWER = f"o_orderdate > {W_SQL}"

RESTRICTED = {"dntl": "o_custkey", "restrict_server": "lists", "restrict_table": "listed_customers", "restrict_key": "c_custkey"}


def _entry(gcptable, **fields):
    values = {"action": "append", "server": "files", "tablename": "orders", "gcptable": gcptable, **fields}
    return tuple(values.get(f) for f in RAW_SCHEMA.names)


def _manifest(spark, *entries):
    return manifest_rows(spark.createDataFrame(list(entries), RAW_SCHEMA))


def _connections(spark, sf_dir):
    """The tables as files; the restricted customers in the catalog."""
    restricted(spark, sf_dir).createOrReplaceTempView("listed_customers")
    return Connections(spark, {
        "files": {"format": "parquet", "path": f"{sf_dir}/{{table}}.parquet"},
        "lists": {"format": "table"},
    })


def _synced(spark, sf_dir, entry, before=None):
    """Run one entry over a target that holds `before`; the target's contents."""
    root = new_path(spark, "targets")
    if before is not None:
        load_table(before, f"{root}/orders_t")
    audit = sync_manifest(spark, _manifest(spark, entry), _connections(spark, sf_dir), root)
    failed = [r["error"] for r in audit.collect() if r["error"]]
    if failed:
        raise RuntimeError(failed[0])
    return read_target(spark, f"{root}/orders_t")


@query(f"SELECT * FROM {T_SQL} UNION ALL SELECT * FROM orders WHERE {NEWER} AND {KEPT}")
def incremental_append(spark, sf_dir):
    entry = _entry("orders_t", datecolumn="o_orderdate", **RESTRICTED)
    return _synced(spark, sf_dir, entry, loaded_orders(spark, sf_dir))


@query(f"SELECT * FROM orders WHERE {KEPT}")
def full_refresh(spark, sf_dir):
    entry = _entry("orders_t", action="truncate", **RESTRICTED)
    return _synced(spark, sf_dir, entry, loaded_orders(spark, sf_dir))


@query("SELECT * FROM orders")
def gated_refresh(spark, sf_dir):
    """There are newer rows, so everything is loaded again."""
    entry = _entry("orders_t", action="truncate", datecolumn="o_orderdate", extract="full")
    return _synced(spark, sf_dir, entry, loaded_orders(spark, sf_dir))


@query(f"SELECT * FROM orders WHERE {NEWER}")
def gated_refresh_skip(spark, sf_dir):
    """The target holds the newest row, so it stays as it is, gaps included."""
    entry = _entry("orders_t", action="truncate", datecolumn="o_orderdate", extract="full")
    newest = orders(spark, sf_dir).join(loaded_orders(spark, sf_dir), "o_orderkey", "left_anti")
    return _synced(spark, sf_dir, entry, newest)


@query(f"SELECT * FROM orders WHERE {NEWER} AND {KEPT}")
def delta_replace(spark, sf_dir):
    """A truncate with a mark leaves the newest rows only."""
    entry = _entry("orders_t", action="truncate", datecolumn="o_orderdate", **RESTRICTED)
    return _synced(spark, sf_dir, entry, loaded_orders(spark, sf_dir))


@query(f"SELECT * FROM {T_SQL} UNION ALL SELECT * FROM orders WHERE {NEWER} AND {KEPT}")
def incremental_by_sql(spark, sf_dir):
    """The restriction as SQL text of the manifest, in place of declared fields."""
    sql = "select t1.* from $1 t1 left join listed_customers r on t1.o_custkey = r.c_custkey where r.c_custkey is null and $2 > '$3'"
    entry = _entry("orders_t", datecolumn="o_orderdate", query=sql)
    return _synced(spark, sf_dir, entry, loaded_orders(spark, sf_dir))


@query(f"SELECT * FROM orders WHERE {KEPT}")
def staged_by_partition(spark, sf_dir):
    entry = _entry("orders_t", action="truncate", splitby="o_orderstatus", **RESTRICTED)
    return _synced(spark, sf_dir, entry)


def _several(spark):
    return _manifest(
        spark,
        _entry("orders_inc", datecolumn="O_ORDERDATE", **RESTRICTED),
        _entry("orders_full", action="truncate"),
        _entry("lineitem_inc", tablename="lineitem", datecolumn="l_shipdate", **{**RESTRICTED, "dntl": "l_suppkey"}),
        _entry("events_inc", tablename="events", datecolumn="ts", precision="milli"),
        _entry("lost", server="nowhere", datecolumn="o_orderdate"),
    )


def _with_loaded_orders(spark, sf_dir):
    root = new_path(spark, "targets")
    load_table(loaded_orders(spark, sf_dir), f"{root}/orders_inc")
    return root


_MARK = f"(SELECT strftime({W_SQL}, '%Y-%m-%d %H:%M:%S'))"
_EPOCH = "'1970-01-01 00:00:00'"
_LOST = "'UnknownServer: no connection is named ''nowhere'''"
_LINES = f"(SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT c_custkey FROM {R_SQL}))"


@query(
    f"""SELECT * REPLACE (cast(rows_to_load AS varchar) AS rows_to_load, cast(rows_before AS varchar) AS rows_before,
      cast(rows_written AS varchar) AS rows_written, cast(rows_total AS varchar) AS rows_total,
      cast(net_change AS varchar) AS net_change) FROM (
    WITH n AS (SELECT (SELECT count(*) FROM {T_SQL}) t, (SELECT count(*) FROM orders) o,
      (SELECT count(*) FROM orders WHERE {NEWER}) newer, (SELECT count(*) FROM orders WHERE {NEWER} AND {KEPT}) kept,
      (SELECT count(*) FROM lineitem) l, {_LINES} lk, (SELECT count(*) FROM events) e)
    SELECT 1 AS position, 'orders' AS table_name, 'orders_inc' AS target, 'incremental' AS pattern, {_MARK} AS watermark,
      newer AS rows_to_load, t AS rows_before, kept AS rows_written, t + kept AS rows_total, kept AS net_change,
      'loaded' AS status, NULL AS error FROM n
    UNION ALL SELECT 2, 'orders', 'orders_full', 'full', {_EPOCH}, NULL, 0, o, o, o, 'loaded', NULL FROM n
    UNION ALL SELECT 3, 'lineitem', 'lineitem_inc', 'incremental', {_EPOCH}, l, 0, lk, lk, lk, 'loaded', NULL FROM n
    UNION ALL SELECT 4, 'events', 'events_inc', 'incremental', {_EPOCH}, e, 0, e, e, e, 'loaded', NULL FROM n
    UNION ALL SELECT 5, 'orders', 'lost', 'incremental', NULL, NULL, NULL, NULL, NULL, NULL, 'error', {_LOST})""",
    name="sync_manifest",
)
def sync_manifest_run(spark, sf_dir):
    """Several entries, one of which names a source that does not exist."""
    root = _with_loaded_orders(spark, sf_dir)
    audit = sync_manifest(spark, _several(spark), _connections(spark, sf_dir), root, parallel=3)
    counts = ("rows_to_load", "rows_before", "rows_written", "rows_total", "net_change")
    return as_text(audit.drop("run_at", "action", "report_max"), *counts)


@query(
    f"""SELECT 1 AS position, 'files' AS server, 'append' AS action, 'o_orderdate' AS datecolumn, 'orders_inc' AS target,
      {_MARK} AS watermark, cast((SELECT count(*) FROM orders WHERE {NEWER}) AS varchar) AS rows_to_load, 'pending' AS status
    UNION ALL SELECT 2, 'files', 'truncate', NULL, 'orders_full', {_EPOCH}, NULL, 'pending'
    UNION ALL SELECT 3, 'files', 'append', 'l_shipdate', 'lineitem_inc', {_EPOCH}, cast((SELECT count(*) FROM lineitem) AS varchar), 'pending'
    UNION ALL SELECT 4, 'files', 'append', 'ts', 'events_inc', {_EPOCH}, cast((SELECT count(*) FROM events) AS varchar), 'pending'
    UNION ALL SELECT 5, 'nowhere', 'append', 'o_orderdate', 'lost', NULL, NULL, 'error'""",
    name="plan_manifest",
)
def plan_manifest_run(spark, sf_dir):
    root = _with_loaded_orders(spark, sf_dir)
    plan = plan_manifest(spark, _several(spark), _connections(spark, sf_dir), root)
    return as_text(plan.drop("query", "pattern", "error"), "rows_to_load")


@query(
    f"""SELECT 'orders_inc' AS target, {_MARK} AS last_date, 'orders_inc : Last date: ' || {_MARK} AS message
    UNION ALL SELECT t, {_EPOCH}, t || ' : Last date: ' || {_EPOCH} FROM (VALUES ('orders_full'), ('lineitem_inc'), ('events_inc')) v(t)""",
    name="sync_report",
)
def sync_report_first(spark, sf_dir):
    root = _with_loaded_orders(spark, sf_dir)
    return sync_report(sync_manifest(spark, _several(spark), _connections(spark, sf_dir), root))


@query("SELECT cast(NULL AS varchar) AS target, cast(NULL AS varchar) AS last_date, 'Tables are up to date.' AS message")
def sync_report_again(spark, sf_dir):
    """A second run finds nothing newer in whole tables."""
    root, conns = new_path(spark, "targets"), _connections(spark, sf_dir)
    manifest = _manifest(
        spark,
        _entry("orders_inc", datecolumn="o_orderdate"),
        _entry("lineitem_inc", tablename="lineitem", datecolumn="l_shipdate"),
        _entry("events_inc", tablename="events", datecolumn="ts"),
    )
    sync_manifest(spark, manifest, conns, root, audit_target=f"{root}/audit_log")
    return sync_report(sync_manifest(spark, manifest, conns, root, audit_target=f"{root}/audit_log"))
