from __future__ import annotations

from pyspark.sql import functions as F

from tablesync import count_new, footer_marks, newer_than, read_watermark, resolve_watermark

from .registry import EVENTS_UNTIL, LOADED_UNTIL, T_SQL, W_SQL, loaded_events, loaded_orders, orders, query, table

EVENTS_MARK = f"(SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '{EVENTS_UNTIL}')"


@query(f"SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS watermark FROM {T_SQL}")
def watermark_max(spark, sf_dir):
    return resolve_watermark(loaded_orders(spark, sf_dir), "o_orderdate")


@query(
    "SELECT coalesce(strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S'), '1970-01-01 00:00:00') AS watermark "
    "FROM orders WHERE o_orderdate IS NULL"
)
def watermark_empty(spark, sf_dir):
    return resolve_watermark(orders(spark, sf_dir).where("o_orderdate IS NULL"), "o_orderdate")


def _events_past(spark, sf_dir, precision):
    mark = read_watermark(loaded_events(spark, sf_dir), "ts", precision)
    return newer_than(table(spark, sf_dir, "events"), "ts", mark)


@query(f"SELECT * FROM events WHERE ts > {EVENTS_MARK}")
def watermark_micro(spark, sf_dir):
    return _events_past(spark, sf_dir, "micro")


@query(f"SELECT * FROM events WHERE ts > date_trunc('milliseconds', {EVENTS_MARK})")
def watermark_milli(spark, sf_dir):
    return _events_past(spark, sf_dir, "milli")


@query(f"SELECT * FROM events WHERE ts > date_trunc('second', {EVENTS_MARK})")
def watermark_second(spark, sf_dir):
    return _events_past(spark, sf_dir, "second")


@query(f"SELECT * FROM events WHERE ts > date_trunc('second', {EVENTS_MARK})")
def watermark_epoch_ms(spark, sf_dir):
    """The target keeps times as whole milliseconds since the epoch."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    target = loaded_events(spark, sf_dir).select(F.floor(micros / 1000).alias("ts_ms"))
    return newer_than(table(spark, sf_dir, "events"), "ts", read_watermark(target, "ts_ms", "epoch_ms"))


@query(
    "SELECT *, year(o_orderdate) * 100 + month(o_orderdate) AS ccyymm FROM orders WHERE year(o_orderdate) * 100 + "
    f"month(o_orderdate) > (SELECT max(year(o_orderdate) * 100 + month(o_orderdate)) FROM {T_SQL})"
)
def watermark_ccyymm(spark, sf_dir):
    ccyymm = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint")
    target = loaded_orders(spark, sf_dir).select(ccyymm.alias("ccyymm"))
    mark = read_watermark(target, "ccyymm", "int")
    return newer_than(orders(spark, sf_dir).withColumn("ccyymm", ccyymm), "ccyymm", mark)


@query("SELECT * FROM lineitem WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)")
def watermark_reused(spark, sf_dir):
    """The newest rows; a mark known from earlier runs narrows the search to recent row groups."""
    target = table(spark, sf_dir, "lineitem")
    earlier = read_watermark(target.where(F.col("l_shipdate") <= F.lit(LOADED_UNTIL).cast("timestamp_ntz")), "l_shipdate")
    mark = read_watermark(target, "l_shipdate", at_least=earlier)
    return target.where(F.col("l_shipdate") == mark.literal(target.schema["l_shipdate"].dataType))


@query(f"SELECT count(*) AS rows_to_load FROM orders WHERE o_orderdate > {W_SQL}", name="count_new")
def count_new_rows(spark, sf_dir):
    mark = read_watermark(loaded_orders(spark, sf_dir), "o_orderdate")
    return count_new(orders(spark, sf_dir), "o_orderdate", mark)


@query(f"SELECT * FROM orders WHERE o_orderdate > {W_SQL}")
def incremental_extract(spark, sf_dir):
    mark = read_watermark(loaded_orders(spark, sf_dir), "o_orderdate")
    return newer_than(orders(spark, sf_dir), "o_orderdate", mark)


@query("SELECT cast(max(l_orderkey) AS varchar) AS watermark, count(*) AS rows FROM lineitem")
def watermark_from_footers(spark, sf_dir):
    """A mark by order number and the rows behind it, without reading a row."""
    return footer_marks(spark, f"{sf_dir}/lineitem.parquet", "l_orderkey")
