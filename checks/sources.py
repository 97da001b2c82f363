from __future__ import annotations

import io
import sys
import zipfile
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tablesync import (
    Connections, anti_join, conform, even_predicates, expand_members, load_manifest, parse_run_logs, read_csv_strings,
    read_table, read_whole_text, run_script, run_sql, scrub_delims, sql_template, text_splits,
)
from tablesync.operators.watermark import Watermark
from tablesync.session import new_path
from tablesync.sources.jdbc import HotValue, hot_splits

from .registry import LOADED_UNTIL, R_SQL, W_SQL, as_text, orders, query, restricted, table


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _view(spark, sf_dir, name):
    view = f"v_{name}"
    table(spark, sf_dir, name).createOrReplaceTempView(view)
    return view


@query("SELECT * FROM orders")
def table_scan(spark, sf_dir):
    return read_table(spark, _view(spark, sf_dir, "orders"))


@query(
    "SELECT o_orderpriority, count(*) AS n, cast(round(sum(o_totalprice), 2) AS double) AS total FROM orders "
    "GROUP BY o_orderpriority ORDER BY o_orderpriority LIMIT 3"
)
def sql_query(spark, sf_dir):
    """A top-3 report: the limit is what it is for."""
    view = _view(spark, sf_dir, "orders")
    return run_sql(
        spark,
        f"SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {view} "
        "GROUP BY o_orderpriority ORDER BY o_orderpriority LIMIT 3",
    )


@query(f"SELECT t1.* FROM orders t1 WHERE o_orderdate > TIMESTAMP '{LOADED_UNTIL}'", name="sql_template")
def sql_template_bound(spark, sf_dir):
    view = _view(spark, sf_dir, "orders")
    return sql_template(spark, "select t1.* from $1 t1 where $2 > '$3'", view, "o_orderdate", Watermark(LOADED_UNTIL))


@query(
    "SELECT o_orderstatus, count(*) AS n, 'a;b' AS note FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderstatus"
)
def sql_script(spark, sf_dir):
    view = _view(spark, sf_dir, "orders")
    results = run_script(
        spark,
        f"""-- first a view; then a report
        CREATE OR REPLACE TEMP VIEW v_urgent AS SELECT * FROM {view} WHERE o_orderpriority <> '5-LOW';
        ;
        SELECT o_orderstatus, count(*) AS n, 'a;b' AS note FROM v_urgent GROUP BY o_orderstatus;
        """,
    )
    return results[-1].result


@query(
    "SELECT cast(c_custkey AS varchar) AS c_custkey, c_name, cast(c_nationkey AS varchar) AS c_nationkey, "
    "cast(cast(c_acctbal AS decimal(15,2)) AS varchar) AS c_acctbal, c_mktsegment FROM customer"
)
def csv_string_scan(spark, sf_dir):
    """Numbers stay text and padded header names are trimmed."""
    path = new_path(spark, "csv")
    source = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(15,2)"))
    source.toDF(*[f" {c}  " for c in source.columns]).write.option("header", True).csv(path)
    return read_csv_strings(spark, path)


@query("SELECT count(*) AS documents, cast(sum(length(text) + 1) AS bigint) AS chars FROM documents")
def whole_text_scan(spark, sf_dir):
    """Texts written as files of a few documents each, then read file by file. Each
    document ends in a form feed, which no text holds."""
    path = new_path(spark, "text")
    texts = table(spark, sf_dir, "documents").select(F.concat("text", F.lit("\f")).alias("value"))
    texts.write.option("lineSep", "\n").option("maxRecordsPerFile", 500).text(path)
    files = read_whole_text(spark, path)
    documents = F.length("text") - F.length(F.translate("text", "\f", ""))
    per_file = files.select(documents.alias("documents"), F.length("text").alias("chars"))
    return per_file.agg(
        F.sum("documents").cast("bigint").alias("documents"),
        (F.sum("chars") - F.sum("documents")).cast("bigint").alias("chars"),
    )


def _zipped(batches):
    """Each document becomes an archive of two members, or stays as it is when German."""
    for batch in batches:
        rows = []
        for doc_id, text, lang in zip(batch["doc_id"], batch["text"], batch["lang"]):
            content = text.encode()
            if lang != "de":
                stream = io.BytesIO()
                with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("body/text.txt", content)
                    archive.writestr("lang.txt", lang)
                content = stream.getvalue()
            rows.append((f"{doc_id}.zip", content))
        yield pd.DataFrame(rows, columns=["path", "content"])


@query(
    "SELECT cast(doc_id AS varchar) || '.zip' AS archive, 'body/text.txt' AS member, 0 AS part, text FROM documents WHERE lang <> 'de' "
    "UNION ALL SELECT cast(doc_id AS varchar) || '.zip', 'lang.txt', 0, lang FROM documents WHERE lang <> 'de'"
)
def archive_expand(spark, sf_dir):
    archives = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    members = expand_members(archives.mapInPandas(_zipped, "path string, content binary"))
    return members.select("archive", "member", "part", F.decode("content", "UTF-8").alias("text"))


@query(
    """SELECT 'append' AS action, CASE WHEN c_acctbal > 0 THEN 'changed_at' END AS datecolumn, c_mktsegment AS dntl,
    lower(c_name) AS gcptable, 'select * from $1 where $2 > ''$3'', "' || c_name || '"' AS query, 'src1' AS server, cast(NULL AS varchar) AS splitby,
    'db.dbo.t' || cast(c_custkey AS varchar) AS tablename, 't' || cast(c_custkey AS varchar) AS name FROM customer"""
)
def manifest_scan(spark, sf_dir):
    """One entry per customer, with blanks, padding and mixed case."""
    path = new_path(spark, "manifest") + ".csv"
    raw = table(spark, sf_dir, "customer").select(
        F.lit(" Append ").alias("action"),
        F.when(F.col("c_acctbal") > 0, "CHANGED_AT").otherwise(" None ").alias("datecolumn"),
        F.col("c_mktsegment").alias("dntl"),
        F.upper("c_name").alias(" gcptable"),
        F.concat(F.lit("select * from $1 where $2 > '$3', \""), "c_name", F.lit('"')).alias("query"),
        F.lit("SRC1").alias("server"),
        F.lit("nan").alias("splitby"),
        F.concat(F.lit("DB.dbo.T"), F.col("c_custkey").cast("string")).alias("tablename "),
    )
    raw.write.options(header=True, quote='"', escape='"').csv(path)
    entries = load_manifest(spark, path)
    return entries.select("action", "datecolumn", "dntl", "gcptable", "query", "server", "splitby", "tablename", "name")


_LOG_SQL = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"


@query(
    f"""SELECT ts AS logged_at, 'dm.' || event_type AS table_name,
    CASE event_type WHEN 'click' THEN 'count' WHEN 'error' THEN 'watermark' WHEN 'view' THEN 'loaded' ELSE 'start' END AS event,
    CASE WHEN event_type = 'error' THEN {_LOG_SQL} END AS watermark,
    CASE WHEN event_type = 'click' THEN cast(event_id AS varchar) END AS rows_to_load,
    CASE WHEN event_type = 'view' THEN cast(-event_id AS varchar) END AS rows_added,
    CASE WHEN event_type = 'view' THEN cast(user_id AS varchar) END AS rows_total FROM events"""
)
def run_log_parse(spark, sf_dir):
    """Log lines of four kinds, one per event."""
    path = new_path(spark, "log")
    events = table(spark, sf_dir, "events")
    logged = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    number, kind = F.col("event_id").cast("string"), F.col("event_type")
    message = (
        F.when(kind == "click", F.concat(F.lit("Rows to load = "), number))
        .when(kind == "error", F.concat(F.lit("Target table:target  changed_at Max date = "), logged))
        .when(kind == "view", F.concat(
            F.lit("Total rows added for a.b.c = -"), number,
            F.lit(" for a total table count of "), F.col("user_id").cast("string")))
        .otherwise("Starting")
    )
    events.select(F.concat(logged, F.lit(" - dm."), kind, F.lit(" "), message).alias("value")).write.text(path)
    return as_text(parse_run_logs(spark, path).drop("message"), "rows_to_load", "rows_added", "rows_total")


@query("SELECT doc_id, translate(text, chr(10) || chr(13) || chr(1), '') AS text, lang, source, n_chars FROM documents", name="scrub_delims")
def scrub_delimiters(spark, sf_dir):
    return scrub_delims(table(spark, sf_dir, "documents"))


@query(
    """SELECT cast(cast(o_orderkey AS decimal(38,0)) AS varchar) AS o_orderkey, o_custkey,
    cast(cast(o_totalprice AS decimal(20,5)) AS varchar) AS o_totalprice, date_trunc('day', o_orderdate) AS o_orderdate,
    cast(cast(o_orderkey AS decimal(12,2)) AS varchar) AS amount, o_orderpriority, o_orderstatus FROM orders"""
)
def conform_types(spark, sf_dir):
    source = orders(spark, sf_dir).withColumn("amount", F.col("o_orderkey")).withColumn("o_orderdate", F.to_date("o_orderdate"))
    declared = {
        "o_orderkey": "INTEGER", "o_custkey": "long", "o_totalprice": "FLOAT", "o_orderdate": "date",
        "amount": "decimal(12,2)", "o_orderpriority": "string", "o_orderstatus": "unheard-of",
    }
    typed = conform(source, declared)
    return typed.withColumns({c: F.col(c).cast("string") for c in ("o_orderkey", "o_totalprice", "amount")})


@query(
    f"SELECT o.* FROM orders o LEFT JOIN {R_SQL} r ON o.o_custkey = r.c_custkey WHERE r.c_custkey IS NULL AND o.o_orderdate > {W_SQL}"
)
def federated_anti_join(spark, sf_dir):
    """Orders from one source, the restriction list as text from another."""
    path = new_path(spark, "csv")
    restricted(spark, sf_dir).write.option("header", True).csv(f"{path}/listed")
    conns = Connections(spark, {
        "warehouse": {"format": "parquet", "path": f"{sf_dir}/{{table}}.parquet"},
        "lists": {"format": "csv", "path": f"{path}/{{table}}", "header": "true"},
    })
    newer = conns.read("warehouse", "orders").where(F.col("o_orderdate") > F.lit(LOADED_UNTIL).cast("timestamp_ntz"))
    return anti_join(newer, conns.read("lists", "listed"), "o_custkey", "c_custkey", "numeric")


def _reads(source, splits):
    """How many rows are read how often when each predicate is a read."""
    met = [F.when(F.expr(p), 1).otherwise(0) for p in splits]
    return source.select(sum(met[1:], met[0]).alias("reads")).groupBy("reads").agg(F.count("*").alias("n"))


@query("SELECT 1 AS reads, count(*) AS n FROM lineitem")
def split_read_text(spark, sf_dir):
    """The predicates of a parallel read by a text column send each row to one read,
    rows without a value included."""
    source = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.concat("l_returnflag", F.col("l_partkey").cast("string"))).alias("source")
    )
    low, high = source.agg(F.min("source"), F.max("source")).first()
    return _reads(source, text_splits("source", low, high, 5))


@query("SELECT 1 AS reads, count(*) AS n FROM lineitem")
def split_read_hot_text(spark, sf_dir):
    """A text column of three values, each of which alone exceeds a ninth of the rows."""
    source = table(spark, sf_dir, "lineitem")
    rows, low, high = source.agg(F.count("*"), F.min("l_returnflag"), F.max("l_returnflag")).first()
    counted = source.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.min("l_orderkey"), F.max("l_orderkey"))
    hot = [HotValue(v, 9 * n // rows + 1, lo, hi) for v, n, lo, hi in counted.where(F.col("n") * 9 > rows).collect()]
    return _reads(source, hot_splits("l_returnflag", "l_orderkey", text_splits("l_returnflag", low, high, 9), hot))


@query(
    "SELECT o_orderstatus, count(*) AS n, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS state FROM orders "
    "WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders) GROUP BY ALL"
)
def sql_script_compound(spark, sf_dir):
    """A script whose block declares a variable, branches and ends in a report."""
    view = _view(spark, sf_dir, "orders")
    results = run_script(
        spark,
        f"""-- BEGIN; in a comment opens nothing
        CREATE OR REPLACE TEMP VIEW v_all AS SELECT *, 'BEGIN; END' AS note FROM {view};
        BEGIN
            DECLARE least DOUBLE DEFAULT 0;
            IF (SELECT count(*) FROM v_all) > 0 THEN
                SET least = (SELECT avg(o_totalprice) FROM v_all);
            END IF;
            SELECT o_orderstatus, count(*) AS n, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS state
            FROM v_all WHERE o_totalprice > least GROUP BY ALL;
        END;
        """,
    )
    return results[-1].result


@query("SELECT * FROM lineitem")
def split_read_even(spark, sf_dir):
    """A skewed column cut at its quantiles: every row is in one of the parts."""
    lines = table(spark, sf_dir, "lineitem")
    parts = [lines.where(p) for p in even_predicates(lines, "l_extendedprice", 8)]
    return reduce(lambda a, b: a.union(b), parts)
