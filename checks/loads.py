from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablesync import (
    TargetNotEmpty, anti_join_bucketed, bucketed, catalog_columns, load_audit, load_new_files, load_table, newer_than, read_files, read_parquet_tree, read_target, stage,
)
from tablesync.session import new_path, shared_dir

from .registry import LOADED_UNTIL, T_SQL, W_SQL, loaded_orders, orders, query, table


def _past_orders(spark, sf_dir):
    return newer_than(orders(spark, sf_dir), "o_orderdate", LOADED_UNTIL)


def _new_table():
    return f"default.t_{uuid.uuid4().hex}"


def _location(spark):
    return f"{shared_dir(spark)}/tablesync/tables"


@query("SELECT * FROM orders")
def load_append(spark, sf_dir):
    """Rows up to the mark, then the rest: the whole table, none twice."""
    target = new_path(spark, "target")
    load_table(loaded_orders(spark, sf_dir), target, "empty")
    load_table(_past_orders(spark, sf_dir), target, "append")
    return read_target(spark, target)


@query(f"SELECT * FROM {T_SQL} UNION ALL SELECT * FROM orders")
def load_append_table(spark, sf_dir):
    """An append keeps rows that are there already."""
    target = _new_table()
    load_table(loaded_orders(spark, sf_dir), target, "empty", location=_location(spark))
    load_table(orders(spark, sf_dir), target, "append")
    return read_target(spark, target)


@query(f"SELECT * FROM orders WHERE o_orderdate > {W_SQL}")
def load_truncate(spark, sf_dir):
    target = new_path(spark, "target")
    load_table(orders(spark, sf_dir), target, "empty")
    load_table(newer_than(read_target(spark, target), "o_orderdate", LOADED_UNTIL), target, "truncate")
    return read_target(spark, target)


@query(f"SELECT * FROM orders WHERE o_orderdate > {W_SQL}")
def load_truncate_table(spark, sf_dir):
    """A table replaced by a part of itself."""
    target = _new_table()
    load_table(orders(spark, sf_dir), target, "empty", location=_location(spark))
    part = newer_than(read_target(spark, target), "o_orderdate", LOADED_UNTIL)
    load_table(part, target, "truncate", location=_location(spark))
    return read_target(spark, target)


@query(f"SELECT *, true AS second_load_refused FROM {T_SQL}")
def load_empty(spark, sf_dir):
    target = new_path(spark, "target")
    load_table(loaded_orders(spark, sf_dir), target)
    try:
        load_table(orders(spark, sf_dir), target)
        refused = False
    except TargetNotEmpty:
        refused = True
    return read_target(spark, target).withColumn("second_load_refused", F.lit(refused))


@query("SELECT o_orderkey, o_totalprice AS amount FROM orders")
def load_recreate(spark, sf_dir):
    """Rows and columns of the target give way."""
    target = _new_table()
    load_table(loaded_orders(spark, sf_dir), target, "empty", location=_location(spark))
    other = orders(spark, sf_dir).select("o_orderkey", F.col("o_totalprice").alias("amount"))
    load_table(other, target, "recreate", location=_location(spark))
    return read_target(spark, target)


_ADDED_SQL = (
    f"SELECT * EXCLUDE (o_orderpriority), CASE WHEN o_orderdate > {W_SQL} THEN o_orderpriority END AS o_orderpriority FROM orders"
)


@query(_ADDED_SQL)
def load_add_columns(spark, sf_dir):
    target = new_path(spark, "target")
    load_table(loaded_orders(spark, sf_dir).drop("o_orderpriority"), target, "empty")
    load_table(_past_orders(spark, sf_dir), target, "append", add_columns=True)
    return read_target(spark, target)


@query(_ADDED_SQL)
def load_add_columns_table(spark, sf_dir):
    target = _new_table()
    load_table(loaded_orders(spark, sf_dir).drop("o_orderpriority"), target, "empty", location=_location(spark))
    load_table(_past_orders(spark, sf_dir), target, "append", add_columns=True)
    return read_target(spark, target)


@query(
    f"""WITH t AS (SELECT count(*) n FROM {T_SQL}), d AS (SELECT count(*) n FROM orders WHERE o_orderdate > {W_SQL}),
    m AS (SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') hi FROM orders)
    SELECT 1 AS position, 0 AS rows_before, t.n AS rows_written, t.n AS rows_total, t.n AS net_change,
           (SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM {T_SQL}) AS report_max FROM t
    UNION ALL SELECT 2, t.n, d.n, t.n + d.n, d.n, m.hi FROM t, d, m
    UNION ALL SELECT 3, t.n + d.n, d.n, d.n, -t.n, m.hi FROM t, d, m""",
    name="load_audit",
)
def load_audit_rows(spark, sf_dir):
    """Counts and report date after a first load, an append and a truncate."""
    target = new_path(spark, "target")
    past = _past_orders(spark, sf_dir)
    results = [
        load_table(loaded_orders(spark, sf_dir), target, "empty", report_col="o_orderdate"),
        load_table(past, target, "append", report_col="o_orderdate"),
        load_table(past, target, "truncate", report_col="o_orderdate"),
    ]
    audit = load_audit(spark, results)
    return audit.select("position", "rows_before", "rows_written", "rows_total", "net_change", "report_max")


@query("SELECT * FROM orders")
def stage_parquet(spark, sf_dir):
    """Staged twice in one place: the second extract replaces the first."""
    path = new_path(spark, "staged")
    stage(loaded_orders(spark, sf_dir), path)
    stage(orders(spark, sf_dir), path)
    return read_files(spark, path)


@query("SELECT * FROM orders")
def stage_partitioned(spark, sf_dir):
    path = new_path(spark, "staged")
    stage(orders(spark, sf_dir), path, "o_orderstatus")
    return read_files(spark, path)


@query("SELECT * EXCLUDE (o_orderstatus) FROM orders")
def parquet_tree_scan(spark, sf_dir):
    path = new_path(spark, "staged")
    stage(orders(spark, sf_dir), path, "o_orderstatus")
    return read_parquet_tree(spark, path)


@query(
    """SELECT * REPLACE (cast(tables AS bigint) AS tables) FROM (VALUES
    (1, 'c_custkey', 'bigint', 'Nullable', 'c_custkey', 1), (2, 'c_name', 'string', 'Nullable', 'c_name', 1),
    (3, 'c_nationkey', 'int', 'Nullable', 'c_nationkey', 1), (4, 'c_acctbal', 'double', 'Nullable', 'c_acctbal', 1),
    (5, 'c_mktsegment', 'string', 'Nullable', 'c_mktsegment', 1), (6, 'loaded_rows', 'bigint', 'Nullable', 'loaded_rows', 1))
    v(ordinal, name, type, mode, description, tables)""",
    name="catalog_columns",
)
def catalog_column_list(spark, sf_dir):
    """Columns of a table as loaded, one of them counted over the whole source."""
    target = _new_table()
    source = table(spark, sf_dir, "customer")
    load_table(source.withColumn("loaded_rows", F.lit(source.count()).cast("bigint")), target, location=_location(spark))
    columns = catalog_columns(spark, [target])
    return columns.groupBy("ordinal", "name", "type", "mode", "description").agg(
        F.count_distinct("table_name").alias("tables")
    )


_NESTED_SQL = (
    f"SELECT o_orderkey, o_totalprice, o_orderstatus, CASE WHEN o_orderdate > {W_SQL} THEN o_orderpriority END AS o_orderpriority, "
    f"CASE WHEN o_orderdate > {W_SQL} THEN cast(o_custkey AS varchar) END AS o_custkey FROM orders"
)


def _nested(spark, sf_dir, target, location):
    """Rows up to the mark, then rows whose structs have more fields, in another order."""
    first = loaded_orders(spark, sf_dir).selectExpr("o_orderkey", "struct(o_totalprice AS price, struct(o_orderstatus AS status) AS state) AS detail")
    load_table(first, target, "empty", location=location)
    more = _past_orders(spark, sf_dir).selectExpr(
        "o_orderkey", "struct(struct(o_orderpriority AS priority, o_orderstatus AS status) AS state, o_totalprice AS price, o_custkey AS customer) AS detail")
    load_table(more, target, "append", add_columns=True)
    return read_target(spark, target).selectExpr(
        "o_orderkey", "detail.price AS o_totalprice", "detail.state.status AS o_orderstatus", "detail.state.priority AS o_orderpriority",
        "cast(detail.customer AS string) AS o_custkey")


@query(_NESTED_SQL)
def load_add_nested(spark, sf_dir):
    return _nested(spark, sf_dir, new_path(spark, "target"), None)


@query(_NESTED_SQL)
def load_add_nested_table(spark, sf_dir):
    return _nested(spark, sf_dir, _new_table(), _location(spark))


@query(
    "SELECT l.* FROM lineitem l LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'F') r "
    "ON l.l_orderkey = r.o_orderkey WHERE r.o_orderkey IS NULL"
)
def anti_join_in_buckets(spark, sf_dir):
    """A source and a list kept in buckets of the id: nothing is shuffled when they meet."""
    kept = [
        bucketed(df, _new_table(), key, 16, new_path(spark, "bucketed"))
        for df, key in ((table(spark, sf_dir, "lineitem"), "l_orderkey"), (orders(spark, sf_dir).where("o_orderstatus = 'F'"), "o_orderkey"))
    ]
    return anti_join_bucketed(*kept, "l_orderkey", "o_orderkey")


@query(f"SELECT *, CASE WHEN o_orderdate > {W_SQL} THEN 2 ELSE 1 END AS load FROM orders")
def incremental_files(spark, sf_dir):
    """Two loads of a folder that gets files in between: the second reads the new files only."""
    folder, target, log = (new_path(spark, name) for name in ("inbox", "target", "log"))
    for load, rows in enumerate((loaded_orders(spark, sf_dir), _past_orders(spark, sf_dir)), 1):
        rows.write.mode("append").parquet(folder)
        load_new_files(spark, folder, target, log, rows.schema, change=lambda df, load=load: df.withColumn("load", F.lit(load)))
    return spark.read.parquet(target)
