"""Run a manifest: mark, count, extract, load and audit, table by table.

The driver walks over entries; all rows stay in Spark jobs. An entry that fails leaves
an audit row and does not stop the others.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import scrub_delims
from ..operators.load import LoadResult, load_table, read_target
from ..operators.restrict import RestrictionList, anti_join, prepare_list
from ..operators.watermark import EPOCH, Watermark, count_new, dtype_of, newer_than, read_watermark
from ..session import delete, intermediates, noting
from ..sources.connections import Connections
from ..sources.jdbc import jdbc_literal, mark_text
from .manifest import Entry, entries
from .sqljob import bind_query, sql_template

AUDIT_SCHEMA = (
    "run_at timestamp, position int, table_name string, target string, pattern string, action string, "
    "watermark string, rows_to_load bigint, rows_before bigint, rows_written bigint, rows_total bigint, "
    "net_change bigint, report_max string, status string, error string"
)

PLAN_SCHEMA = (
    "position int, query string, server string, action string, datecolumn string, target string, "
    "pattern string, watermark string, rows_to_load bigint, status string, error string"
)

# Texts of the report.
UP_TO_DATE = "Tables are up to date."
LAST_DATE = " : Last date: "


@dataclass(frozen=True)
class Pending:
    """An entry with its mark and the number of newer rows; None when not counted.

    mark_type is the type of a database's date column, None for other sources.
    """

    entry: Entry
    mark: Watermark | None
    rows_to_load: int | None
    mark_type: T.DataType | None = None

    @property
    def due(self) -> bool:
        return self.rows_to_load is None or self.rows_to_load > 0


class _Run:
    """What the entries of one run share."""

    def __init__(self, spark: SparkSession, conns: Connections, targets: str, past_marks: dict[str, str]):
        self.spark, self.conns, self.targets = spark, conns, targets
        self.past_marks = past_marks
        self._lists: dict[tuple, RestrictionList] = {}
        self._locks: dict[tuple, Lock] = {}
        self._paths: list[str] = []  # of the lists, which outlive an entry

    def target(self, entry: Entry) -> str:
        return f"{self.targets.rstrip('/')}/{entry.gcptable}" if "/" in self.targets else f"{self.targets}.{entry.gcptable}"

    def pending(self, entry: Entry) -> Pending:
        if entry.problem:
            raise ValueError(entry.problem)
        self.conns.config(entry.server)
        if entry.datecolumn is None:
            return Pending(entry, None, None)
        target = read_target(self.spark, self.target(entry))
        past = self.past_marks.get(entry.gcptable)
        mark = read_watermark(target, entry.datecolumn, entry.precision, Watermark(past) if past else None)
        if past and mark.text == EPOCH and target is not None and entry.pattern == "delta_replace":
            # All newer rows were restricted and left the target empty: its mark is the audited one.
            mark = Watermark(past)
        dtype = None
        if self.conns.is_jdbc(entry.server):
            dtype = dtype_of(self.conns.read(entry.server, entry.tablename), entry.datecolumn)
        return Pending(entry, mark, self._count(entry, mark, dtype), dtype)

    def _count(self, entry: Entry, mark: Watermark, dtype: T.DataType | None) -> int:
        if self.conns.is_jdbc(entry.server):
            literal = jdbc_literal(mark, self.conns.dialect(entry.server), dtype, self.conns.timezone(entry.server))
            counted = self.conns.read(
                entry.server,
                f"select count(*) rows_to_load from {entry.tablename} where {entry.datecolumn} > {literal}",
            )
        else:
            counted = count_new(self.conns.read(entry.server, entry.tablename), entry.datecolumn, mark)
        return int(counted.first()[0])

    def bound_query(self, p: Pending) -> str | None:
        if p.entry.query is None:
            return None
        server, text = p.entry.server, None
        if p.mark:
            text = mark_text(p.mark, self.conns.dialect(server), p.mark_type, self.conns.timezone(server))
        return bind_query(p.entry.query, p.entry.tablename, p.entry.datecolumn, text)

    def extract(self, p: Pending) -> DataFrame:
        rows = self._extract(p)
        return scrub_delims(rows) if p.entry.scrub else rows

    def _extract(self, p: Pending) -> DataFrame:
        entry = p.entry
        split = entry.split_read if self.conns.is_jdbc(entry.server) else {}
        if entry.query is not None and self.conns.is_jdbc(entry.server):
            return self.conns.read(entry.server, self.bound_query(p), **split)
        source = self.conns.read(entry.server, entry.tablename, **split)
        if entry.query is not None:
            # A name of its own: other syncs of the session have views too.
            view = f"tablesync_source_{uuid.uuid4().hex}"
            source.createTempView(view)
            try:
                return sql_template(self.spark, entry.query, view, entry.datecolumn, p.mark)
            finally:
                self.spark.catalog.dropTempView(view)
        if entry.uses_mark:
            source = newer_than(source, entry.datecolumn, p.mark)
        if entry.restrict_table is None:
            return source
        return anti_join(source, self._list(entry), entry.dntl, keep_right=entry.keep_right)

    def _list(self, entry: Entry) -> RestrictionList:
        """Lists are few and shared by many entries, so each is reduced once per run."""
        server = entry.restrict_server or entry.server
        key = (server, entry.restrict_table, entry.restrict_key, entry.normalise)
        with self._locks.setdefault(key, Lock()):  # entries wait for their own list only
            if key not in self._lists:
                split = {"split_by": entry.restrict_read_by, "num_partitions": entry.read_parts} if self.conns.is_jdbc(server) else {}
                listed = self.conns.read(server, entry.restrict_table, **split)
                with noting(self._paths):
                    self._lists[key] = prepare_list(listed, entry.restrict_key, entry.normalise)
            return self._lists[key]

    def remove_lists(self) -> None:
        for path in self._paths:
            delete(self.spark, path)

    def load(self, p: Pending) -> LoadResult:
        entry = p.entry
        return load_table(self.extract(p), self.target(entry), entry.mode, add_columns=entry.add_columns,
                          report_col=entry.report_col, rebalance=entry.uses_mark, split_by=entry.splitby)

    def audited(self, entry: Entry) -> tuple:
        """Run one entry and describe it; the description of a failure is its row."""
        mark = to_load = error = None
        loaded, status = None, "error"
        try:
            p = self.pending(entry)
            mark, to_load = p.mark, p.rows_to_load
            if p.due:
                with intermediates(self.spark):
                    loaded = self.load(p)
            status = "loaded" if p.due else "up_to_date"
        except Exception as e:  # an entry must not stop the others
            error = f"{type(e).__name__}: {str(e)[:1000]}"
        return audit_row(entry.position, entry.tablename, entry.gcptable, entry.pattern, entry.mode, mark, to_load, loaded, status, error)


def audit_row(position, table, target, pattern, action, mark, to_load, loaded: LoadResult | None, status, error=None) -> tuple:
    counts = (None,) * 5
    if loaded:
        counts = (loaded.rows_before, loaded.rows_written, loaded.rows_total, loaded.net_change, loaded.report_max)
    # A failed entry's mark is unknown until it was read; an entry without one starts at the epoch.
    text = mark.text if mark else None if status == "error" else EPOCH
    return (dt.datetime.now(), position, table, target, pattern, action, text, to_load, *counts, status, error)


def load_audit(spark: SparkSession, results: Iterable[LoadResult], mode: str = "append") -> DataFrame:
    """Audit rows of single loads: counts before, written and after, and the report date."""
    rows = [
        audit_row(i, r.target, r.target, None, mode, None, None, r, "loaded") for i, r in enumerate(results, start=1)
    ]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def _past_marks(spark: SparkSession, audit_target: str | None) -> dict[str, str]:
    """The last mark each target reached: one small row per target."""
    audit = read_target(spark, audit_target) if audit_target else None
    if audit is None:
        return {}
    reached = audit.where("watermark is not null and status in ('loaded', 'up_to_date')")
    last = reached.groupBy("target").agg(F.max_by("watermark", "run_at").alias("mark"))
    return {r["target"]: r["mark"] for r in last.collect()}


def plan_manifest(spark: SparkSession, manifest: DataFrame, conns: Connections, targets: str) -> DataFrame:
    """What a sync would extract, entry by entry, without loading anything."""
    run = _Run(spark, conns, targets, {})
    rows = []
    for entry in entries(manifest):
        mark, to_load, query, status, error = None, None, entry.query, "error", None
        try:
            p = run.pending(entry)
            mark, to_load, query = p.mark, p.rows_to_load, run.bound_query(p)
            status = "pending" if p.due else "up_to_date"
        except Exception as e:
            error = f"{type(e).__name__}: {str(e)[:1000]}"
        rows.append(
            (entry.position, query, entry.server, entry.mode, entry.datecolumn, entry.gcptable, entry.pattern,
             mark.text if mark else None if status == "error" else EPOCH, to_load, status, error)
        )
    return spark.createDataFrame(rows, PLAN_SCHEMA)


def sync_manifest(
    spark: SparkSession,
    manifest: DataFrame,
    conns: Connections,
    targets: str,
    audit_target: str | None = None,
    parallel: int = 1,
) -> DataFrame:
    """Run all entries and return their audit rows, in manifest order.

    targets is a folder or a catalog database that the target names go below. With
    parallel > 1 several targets load at once; entries of one target keep their order.
    """
    run = _Run(spark, conns, targets, _past_marks(spark, audit_target))
    groups: dict[str, list[Entry]] = {}
    for entry in entries(manifest):
        groups.setdefault(entry.gcptable, []).append(entry)

    def in_order(group: list[Entry]) -> list[tuple]:
        return [run.audited(entry) for entry in group]

    try:
        with ThreadPoolExecutor(max_workers=max(parallel, 1)) as pool:
            rows = [row for rows in pool.map(in_order, groups.values()) for row in rows]
    finally:
        run.remove_lists()
    audit = spark.createDataFrame(sorted(rows, key=lambda r: r[1]), AUDIT_SCHEMA)
    if audit_target:
        load_table(audit, audit_target, "append")
    return audit


def sync_report(audit: DataFrame) -> DataFrame:
    """The tables that were loaded with the date they start from, or that all is up to date."""
    loaded = audit.where("status = 'loaded'").select(
        "target",
        F.col("watermark").alias("last_date"),
        F.concat("target", F.lit(LAST_DATE), "watermark").alias("message"),
    )
    nothing = audit.agg(F.count_if(F.col("status") == "loaded").alias("n")).where("n = 0")
    return loaded.unionByName(
        nothing.select(
            F.lit(None).cast("string").alias("target"),
            F.lit(None).cast("string").alias("last_date"),
            F.lit(UP_TO_DATE).alias("message"),
        )
    )
