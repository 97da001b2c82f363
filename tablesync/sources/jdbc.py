"""JDBC reads and writes.

A connection is a mapping of Spark's jdbc options (url, driver, user, ...) that the
caller supplies. `dialect` ('oracle' or 'sqlserver'), `database` and `timezone`, the zone that the
database's times without an offset are in (UTC if not named), are ours.
"""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.watermark import EPOCH, Watermark
from .files import read_parquet_tree

# Rows per round trip and parallel writers.
FETCH_SIZE = 100_000
BATCH_SIZE = 1_000
WRITE_PARTITIONS = 10
SPLITS = 5

OWN_OPTIONS = ("dialect", "database", "timezone")

NUMBER = re.compile(r"-?\d+(\.\d+)?")


def jdbc_options(conn: Mapping[str, str], database: str | None = None) -> dict[str, str]:
    """Spark's options for a connection, pointed at another database if one is named."""
    options = {k: str(v) for k, v in conn.items() if k not in OWN_OPTIONS}
    database = database or conn.get("database")
    if database:
        options["url"] = options["url"].rstrip(";") + f";databaseName={database}"
    return options


def relation(table_or_query: str) -> str:
    """A table name as it is, a query as a derived table. The placeholder that import
    jobs keep for their splits is open here: the splits go around the query."""
    text = table_or_query.strip().rstrip("; ").replace("$CONDITIONS", "1 = 1")
    if text.split(None, 1)[0].lower() in ("select", "with"):
        return f"({text}) query"
    return text


def text_splits(column: str, low: str, high: str, parts: int) -> list[str]:
    """Predicates that send each row of a text column to exactly one of `parts` reads.

    Bounds are spread evenly between the smallest and the largest value. A row belongs
    to the first bound it lies below. Each predicate therefore rules out all earlier
    bounds, which stays disjoint and complete under any collation of the database.
    Nulls get a predicate of their own.
    """
    bounds = _between(low, high, parts - 1)
    splits = _first_below(column, [_quoted(b) for b in bounds])
    return [" AND ".join(terms) or f"{column} IS NOT NULL" for terms in splits] + [f"{column} IS NULL"]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _first_below(column: str, bounds: list[str]) -> list[list[str]]:
    """Terms per split: below its own bound and not below any earlier one."""
    ends = [[f"{column} < {b}"] for b in bounds] + [[]]
    return [[f"{column} >= {b}" for b in bounds[:i]] + end for i, end in enumerate(ends)]


@dataclass(frozen=True)
class HotValue:
    """A value, or null, that fills more than one part, and the span of its second column."""

    value: str | None
    parts: int
    low: int
    high: int


def hot_splits(column: str, then_by: str, splits: list[str], hot: list[HotValue]) -> list[str]:
    """Take hot values out of the splits and divide each by a second, whole-number column."""
    common = [h.value for h in hot if h.value is not None]
    out = [s for s in splits if s != f"{column} IS NULL" or all(h.value is not None for h in hot)]
    if common:
        listed = ", ".join(_quoted(v) for v in common)
        out = [s if s.endswith("IS NULL") else f"{s} AND {column} NOT IN ({listed})" for s in out]
    for h in hot:
        bounds = sorted({h.low + (h.high - h.low) * k // h.parts for k in range(1, h.parts)})
        here = f"{column} IS NULL" if h.value is None else f"{column} = {_quoted(h.value)}"
        pieces = [" AND ".join([here, *terms]) for terms in _first_below(then_by, [str(b) for b in bounds])]
        out += [*pieces, f"{here} AND {then_by} IS NULL"] if bounds else [here]
    return out


def _hot_values(spark: SparkSession, options: Mapping[str, str], column: str, then_by: str, parts: int) -> list[HotValue]:
    """Values that fill more than one part: fewer than parts, found by the database."""
    rel = options["dbtable"]
    counted = f"SELECT {column} AS v, count(*) AS n, min({then_by}) AS lo, max({then_by}) AS hi FROM {rel} GROUP BY {column}"
    total = int(_load(spark, {**options, "dbtable": f"(SELECT count(*) AS n FROM {rel}) total"}).first()[0])
    share = max(total // parts, 1)
    rows = _load(spark, {**options, "dbtable": f"({counted} HAVING count(*) > {share}) hot"}).collect()
    return [HotValue(v, math.ceil(n / share), int(lo), int(hi)) for v, n, lo, hi in rows if lo is not None]


def _between(low: str, high: str, n: int, width: int = 8) -> list[str]:
    """n texts spread between two texts, which are read as fractions in base `base`.

    Bounds use printable ASCII after the common prefix; rows beyond it still fall
    below or above a bound.
    """
    shared = 0
    while shared < min(len(low), len(high)) and low[shared] == high[shared]:
        shared += 1
    first, base = ord(" "), 95

    def number(text: str) -> int:
        digits = [min(max(ord(c) - first, 0), base - 1) for c in text[shared:shared + width]]
        return sum(d * base ** (width - 1 - i) for i, d in enumerate(digits))

    def text(value: int) -> str:
        digits = [value // base ** (width - 1 - i) % base for i in range(width)]
        return low[:shared] + "".join(chr(first + d) for d in digits).rstrip(" ")

    start, end = number(low), number(high)
    found = [text(start + (end - start) * k // (n + 1)) for k in range(1, n + 1)]
    return [b for b in dict.fromkeys(found) if low < b <= high]


def _load(spark: SparkSession, options: Mapping[str, str], predicates: list[str] | None = None) -> DataFrame:
    if predicates is None:
        return spark.read.format("jdbc").options(**options).load()
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=rest)


def read_jdbc(
    spark: SparkSession,
    conn: Mapping[str, str],
    table_or_query: str,
    split_by: str | None = None,
    num_partitions: int = SPLITS,
    then_by: str | None = None,
    predicates: list[str] | None = None,
    fetchsize: int = FETCH_SIZE,
    database: str | None = None,
) -> DataFrame:
    """A table or a query of the database; filters and columns are pushed to it.

    With split_by the read runs in num_partitions parallel parts. The bounds come from
    one min/max query. Numbers, dates and timestamps split into even ranges, text by
    text_splits. A part holds at least one value, so name a column of many values, or
    for text a whole-number column then_by that divides the values which alone exceed
    a part. Own `predicates` must be disjoint and complete.
    """
    source = relation(table_or_query)
    options = {**jdbc_options(conn, database), "dbtable": source, "fetchsize": str(fetchsize)}
    if predicates is not None:
        return _load(spark, options, predicates)
    if split_by is None or num_partitions < 2:
        return _load(spark, options)

    bounds = _load(
        spark,
        {**options, "dbtable": f"(SELECT min({split_by}) AS lo, max({split_by}) AS hi FROM {source}) bounds"},
    ).toDF("lo", "hi")
    kind = bounds.schema["lo"].dataType.typeName()
    low, high = bounds.selectExpr("cast(lo as string)", "cast(hi as string)").first()
    if low is None or low == high:
        return _load(spark, options)
    if kind == "string":
        splits = text_splits(split_by, low, high, num_partitions)
        if then_by is not None:
            splits = hot_splits(split_by, then_by, splits, _hot_values(spark, options, split_by, then_by, num_partitions))
        return _load(spark, options, splits)
    if kind in ("decimal", "float", "double"):
        low, high = str(math.floor(Decimal(low))), str(math.ceil(Decimal(high)))
    ranged = {
        "partitionColumn": split_by,
        "lowerBound": low,
        "upperBound": high,
        "numPartitions": str(num_partitions),
    }
    return _load(spark, {**options, **ranged})


def jdbc_literal(mark: Watermark, dialect: str | None, dtype: T.DataType | None = None, zone: str = "UTC") -> str:
    """A mark as SQL text of the source database; an Oracle DATE holds whole seconds.

    dtype is the type of the compared column; without it the mark's text tells.
    """
    text = mark_text(mark, dialect, dtype, zone)
    if isinstance(dtype, T.NumericType) or (dtype is None and NUMBER.fullmatch(text)):
        return text
    if dialect == "oracle" and _moment(mark.text, dtype):
        return f"to_date('{text[:10]}','yyyy-mm-dd')" if len(text) == 10 else f"to_date('{text}','yyyy-mm-dd hh24:mi:ss')"
    return f"'{text}'"


def mark_text(mark: Watermark, dialect: str | None, dtype: T.DataType | None = None, zone: str = "UTC") -> str:
    """The mark as its source compares it: numbers as they are, times in whole seconds or
    milliseconds. A mark with an offset becomes the time on the clock of zone, the source's."""
    if isinstance(dtype, T.NumericType) and mark.text == EPOCH:
        return "0"
    moment = _moment(mark.text, dtype)
    if moment is None:
        return mark.text
    if len(mark.text) == 10:
        return mark.text
    if isinstance(dtype, T.DateType):
        return moment.date().isoformat()
    if moment.tzinfo is not None:
        moment = moment.astimezone(ZoneInfo(zone)).replace(tzinfo=None)
    fine = moment.microsecond and dialect != "oracle"
    return moment.isoformat(sep=" ", timespec="milliseconds" if fine else "seconds")


def _moment(text: str, dtype: T.DataType | None) -> dt.datetime | None:
    """A mark's time, if it is one: text of a number or of a text column is none."""
    if isinstance(dtype, (T.NumericType, T.StringType)) or NUMBER.fullmatch(text):
        return None
    try:
        return dt.datetime.fromisoformat(text)
    except ValueError:
        return None


def write_jdbc(
    df: DataFrame,
    conn: Mapping[str, str],
    table: str,
    mode: str = "append",
    batchsize: int = BATCH_SIZE,
    num_partitions: int = WRITE_PARTITIONS,
) -> None:
    """Write rows to a database table over at most num_partitions connections.

    append adds them; truncate empties the table first and keeps its definition.
    Failures are raised. Each task commits for itself, so after a failed append load
    again with truncate or remove the rows first.
    """
    if mode not in ("append", "truncate"):
        raise ValueError(f"mode must be 'append' or 'truncate', not {mode!r}")
    options = {
        **jdbc_options(conn),
        "dbtable": table,
        "batchsize": str(batchsize),
        "numPartitions": str(num_partitions),
        "truncate": str(mode == "truncate").lower(),
    }
    df.write.format("jdbc").options(**options).mode("append" if mode == "append" else "overwrite").save()


def export_tree(spark: SparkSession, path: str, conn: Mapping[str, str], table: str, mode: str = "append") -> None:
    """Write all parquet files below path to a database table in one job."""
    write_jdbc(read_parquet_tree(spark, path), conn, table, mode)
