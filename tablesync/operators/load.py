"""Loads: staging, write dispositions, row counts.

A path target holds one folder per load, named <number>-<kind>. A marker that is written
last says that a load is complete, so a load shows up whole or not at all: a half-written
folder is never read. The marker's name ends in the load's number of rows. A replacement starts a new series; nothing that
a running query may still be reading is overwritten. A table target swaps its location
instead. Both assume one writer per target at a time.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete, matching, path_exists, touch

MODES = ("append", "truncate", "empty", "recreate")

SPLIT = "split_value"
NUMBERED = "[0-9]" * 8
COMMITTED = "_COMMITTED"  # Spark's own marker can be switched off
UNIQUE = re.compile(r"[0-9a-f]{32}")


class TargetNotEmpty(Exception):
    """An 'empty' load met a target that has rows."""


@dataclass(frozen=True)
class LoadResult:
    """What a load did; report_max is the largest value of the report column, as text."""

    target: str
    rows_before: int
    rows_written: int
    rows_total: int
    report_max: str | None = None

    @property
    def net_change(self) -> int:
        return self.rows_total - self.rows_before


class PathTarget:
    """A parquet target in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.name = spark, path.rstrip("/")
        self.split_by: str | None = None
        self._written: str | None = None
        self._rows: dict[str, int] = {}

    def _loads(self) -> list[str]:
        """Folders that make up the current contents, oldest first. Files that lie in
        the target's folder itself count as its first load."""
        markers = [m.rpartition("/")[::2] for m in matching(self.spark, f"{self.name}/{NUMBERED}-*/{COMMITTED}*")]
        self._rows = {folder: int(name.rpartition("-")[2]) for folder, name in markers if "-" in name}
        done = sorted({folder for folder, _ in markers})
        starts = [i for i, d in enumerate(done) if d.endswith("-replace")]
        if starts:
            return done[starts[-1]:]
        own = [p for p in matching(self.spark, f"{self.name}/[!_.]*") if not _number(p)]
        if not own:
            return done
        # Rows that this library did not load must be read whole or not be touched at all.
        if any("=" in p.rpartition("/")[2] for p in own):
            raise ValueError(f"{self.name} is partitioned: load it as a table")
        if not path_exists(self.spark, f"{self.name}/_SUCCESS"):
            raise ValueError(f"{self.name} holds files but no _SUCCESS marker that says they are complete")
        return [self.name, *done]

    def replaced(self) -> list[str]:
        """Numbered folders from before the current contents, unfinished ones included."""
        current = self._loads()
        found = matching(self.spark, f"{self.name}/{NUMBERED}-*")
        return [p for p in found if current and _number(p) < min(map(_number, current))]

    def exists(self) -> bool:
        return bool(self._loads())

    def read(self) -> DataFrame:
        """Every load is written with all columns known by then, so the last one has the
        columns of all; earlier ones read as null without a look at their footers."""
        return self._read(self._loads())

    def _read(self, loads: list[str]) -> DataFrame:
        def reader(path: str):
            # Folders of a split load repeat a column that its files have too.
            return self.spark.read.option("recursiveFileLookup", path != self.name)

        schema = reader(loads[-1]).parquet(loads[-1]).schema
        own, loaded = [p for p in loads if p == self.name], [p for p in loads if p != self.name]
        parts = [reader(paths[0]).schema(schema).parquet(*paths) for paths in (own, loaded) if paths]
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def count(self) -> int:
        """Rows of the current contents. Loads know theirs; only files of others are counted."""
        loads = self._loads()
        unknown = [p for p in loads if p not in self._rows]
        return sum(self._rows.get(p, 0) for p in loads) + (self._read(unknown).count() if unknown else 0)

    def _write(self, df: DataFrame, kind: str) -> None:
        taken = matching(self.spark, f"{self.name}/{NUMBERED}-*")
        path = f"{self.name}/{max(map(_number, taken), default=0) + 1:08d}-{kind}"
        if self.split_by is None:
            df.write.parquet(path)
        else:
            # A copy of the column: a folder name can't tell an empty text from null, nor '01' from 1.
            folder = SPLIT
            while folder in {c.lower() for c in df.columns}:
                folder += "_"
            df.withColumn(folder, F.col(f"`{self.split_by}`")).write.partitionBy(folder).parquet(path)
        self._written = path

    def commit(self, rows: int) -> None:
        """Make the load that was written visible."""
        touch(self.spark, f"{self._written}/{COMMITTED}-{rows}")

    def partition_columns(self) -> list[str]:
        return [self.split_by] if self.split_by else []

    def create(self, df: DataFrame) -> None:
        self._write(df, "replace")

    recreate = create

    def truncate(self, df: DataFrame) -> None:
        self._write(_same_columns(df, self.read().schema), "replace")

    def append(self, df: DataFrame, add_columns: bool) -> None:
        schema = _merged_schema(df, self.read().schema, self.name, add_columns)
        self._write(_same_columns(df, schema), "append")


class TableTarget:
    """A parquet table of the session catalog."""

    def __init__(self, spark: SparkSession, name: str, location: str | None = None):
        self.spark, self.name = spark, name
        self._base = location
        self.split_by: str | None = None

    def _new_location(self) -> str:
        base = self._base or self.spark.conf.get("spark.sql.warehouse.dir")
        return f"{base.rstrip('/')}/{self.name.replace('.', '/')}/{uuid.uuid4().hex}"

    def replaced(self) -> list[str]:
        """Locations this library gave the table before, beside the current one."""
        current = self._described("Location")
        parent, _, name = current.rpartition("/")
        if not parent.endswith("/" + self.name.replace(".", "/")) or not UNIQUE.fullmatch(name):
            return []
        beside = matching(self.spark, f"{parent}/*")
        return [p for p in beside if UNIQUE.fullmatch(p.rpartition("/")[2]) and p.rpartition("/")[2] != name]

    def _partition_columns(self) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name) if c.isPartition]

    def partition_columns(self) -> list[str]:
        """What rows are gathered by before a write: a table that has no partitions keeps a
        column it is split by in files of few values, which Spark skips by their statistics."""
        parts = self._partition_columns() if self.exists() else []
        return parts or ([self.split_by] if self.split_by else [])

    def count(self) -> int:
        return self.read().count()

    def commit(self, rows: int) -> None:
        """The catalog has made the load visible."""

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def create(self, df: DataFrame) -> None:
        df.write.format("parquet").option("path", self._new_location()).saveAsTable(self.name)

    def recreate(self, df: DataFrame) -> None:
        """The new rows are complete before the old table goes."""
        location = self._new_location()
        df.write.parquet(location)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.catalog.createTable(self.name, path=location, source="parquet")

    def truncate(self, df: DataFrame) -> None:
        location, schema = self._new_location(), self.read().schema
        parts = self._partition_columns()
        _same_columns(df, schema).write.partitionBy(*parts).parquet(location)
        if parts:
            self._define(schema, location)
        else:
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{location}'")
        self.spark.catalog.refreshTable(self.name)

    def _described(self, what: str) -> str:
        return self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where(F.col("col_name") == what).first()["data_type"]

    def _define(self, schema: T.StructType, location: str | None = None) -> None:
        """Define the table anew over files that stay where they are, its own by default."""
        if location is None:
            if self._described("Type") != "EXTERNAL":
                raise ValueError(f"{self.name} owns its files: fields inside its columns can't be added")
            location = self._described("Location")
        parts = self._partition_columns()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        listed = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
        self.spark.sql(f"DROP TABLE {self.name}")
        self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet {listed} LOCATION '{location}'")
        if parts:
            self.spark.catalog.recoverPartitions(self.name)

    def append(self, df: DataFrame, add_columns: bool) -> None:
        schema = self.read().schema
        merged = _merged_schema(df, schema, self.name, add_columns)
        if merged[: len(schema)] != schema:
            self._define(merged)
        elif merged != schema:
            listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in merged[len(schema) :])
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({listed})")
        writer = _same_columns(df, self.read().schema).write.mode("append").format("parquet")
        writer.partitionBy(*self._partition_columns()).saveAsTable(self.name)


def open_target(spark: SparkSession, target: str, location: str | None = None):
    """A name with a slash is a folder, any other a catalog table. Names are lower-cased
    for tables; location is the folder below which new tables keep their files."""
    if "/" in target:
        return PathTarget(spark, target)
    return TableTarget(spark, target.lower(), location)


def read_target(spark: SparkSession, target: str) -> DataFrame | None:
    """Current contents, or None when the target does not exist."""
    opened = open_target(spark, target)
    return opened.read() if opened.exists() else None


def remove_replaced(spark: SparkSession, target: str) -> int:
    """Delete what truncate and recreate loads have replaced; how many folders that was.

    For when no query still reads, and no load still writes, the target.
    """
    folders = open_target(spark, target).replaced()
    for folder in folders:
        delete(spark, folder)
    return len(folders)


def _number(folder: str) -> int:
    """The number of a load's folder; 0 for the target's own folder."""
    name = folder.rpartition("/")[2]
    return int(name[:8]) if re.match(r"\d{8}-", name) else 0


def _merged_type(known: T.DataType, given: T.DataType, at: str, added: list[str]) -> T.DataType:
    """known with the fields that given has beside it inside structs and lists; their names go to added."""
    if isinstance(known, T.ArrayType) and isinstance(given, T.ArrayType):
        return T.ArrayType(_merged_type(known.elementType, given.elementType, at, added), known.containsNull)
    if not (isinstance(known, T.StructType) and isinstance(given, T.StructType)):
        return known
    have = {f.name.lower(): f for f in given}
    fields = [
        T.StructField(f.name, _merged_type(f.dataType, have[f.name.lower()].dataType, f"{at}{f.name}.", added) if f.name.lower() in have else f.dataType,
                      f.nullable, f.metadata)
        for f in known
    ]
    names = {f.name.lower() for f in known}
    new = [T.StructField(f.name, f.dataType) for f in given if f.name.lower() not in names]
    added += [f"{at}{f.name}" for f in new]
    return T.StructType([*fields, *new])


def _merged_schema(df: DataFrame, schema: T.StructType, target: str, allowed: bool) -> T.StructType:
    """schema with the fields of df that the target lacks, at any depth, which only an add_columns load may bring."""
    added: list[str] = []
    merged = _merged_type(schema, df.schema, "", added)
    if added and not allowed:
        raise ValueError(f"columns not in {target}: {added}")
    return merged


def _shaped(col, given: T.DataType, wanted: T.DataType):
    """A value with its structs' fields by name in the order of wanted; those it lacks are null."""
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType) and given != wanted:
        return F.transform(col, lambda x: _shaped(x, given.elementType, wanted.elementType))
    if not (isinstance(given, T.StructType) and isinstance(wanted, T.StructType)) or given == wanted:
        return col.cast(wanted)
    have = {f.name.lower(): f for f in given}
    fields = [
        (_shaped(col.getField(have[f.name.lower()].name), have[f.name.lower()].dataType, f.dataType) if f.name.lower() in have
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in wanted
    ]
    return F.when(col.isNotNull(), F.struct(*fields))


def _same_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df by name in the order and types of schema; columns df lacks are null."""
    _merged_schema(df, schema, "the target", False)
    have = {f.name.lower(): f for f in df.schema}
    known = {f.name.lower(): f.dataType for f in schema}
    narrowed = [f.name for f in df.schema if not _keeps_values(f.dataType, known[f.name.lower()])]
    if narrowed:
        raise ValueError(f"columns whose values the target's types may change: {narrowed}")

    def column(f: T.StructField):
        found = have.get(f.name.lower())
        if found is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return _shaped(F.col(f"`{found.name}`"), found.dataType, f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema])


# Whole decimal digits that hold every value of a type.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
# Whole numbers that a binary fraction holds exactly.
EXACT = {T.FloatType: (T.ByteType, T.ShortType), T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)}


def _keeps_values(given: T.DataType, wanted: T.DataType) -> bool:
    """Does a cast keep every value: is it to the same type, or a widening one?"""
    if isinstance(given, T.NullType) or given.simpleString() == wanted.simpleString():
        return True
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        known = {f.name.lower(): f.dataType for f in wanted}
        return all(f.name.lower() in known and _keeps_values(f.dataType, known[f.name.lower()]) for f in given)
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return _keeps_values(given.elementType, wanted.elementType)
    if isinstance(wanted, T.DecimalType):
        if isinstance(given, T.DecimalType):
            return given.scale <= wanted.scale and given.precision - given.scale <= wanted.precision - wanted.scale
        return DIGITS.get(type(given), 99) <= wanted.precision - wanted.scale
    if type(given) in DIGITS and type(wanted) in DIGITS:
        return DIGITS[type(given)] <= DIGITS[type(wanted)]
    if type(wanted) in EXACT:
        return isinstance(given, EXACT[type(wanted)])
    if isinstance(given, T.DateType):
        return isinstance(wanted, (T.TimestampType, T.TimestampNTZType))
    return isinstance(wanted, T.StringType) and isinstance(given, (T.CharType, T.VarcharType, T.StringType))


def load_table(
    df: DataFrame,
    target: str,
    mode: str = "empty",
    add_columns: bool = False,
    report_col: str | None = None,
    location: str | None = None,
    rebalance: bool = False,
    split_by: str | None = None,
) -> LoadResult:
    """Load df in one write.

    append     add the rows; add_columns lets df bring new nullable columns, and fields
               inside structs and lists of structs
    truncate   replace the rows, keep the columns
    empty      load only if the target is absent or has no rows
    recreate   replace rows and columns

    Rows written are counted by the write itself, which reads the source once. Each task
    writes a file; rebalance gathers the rows of a small part of a large source, which
    come from many tasks, into files of ordinary size first. split_by keeps the values of a
    column apart: a path target gets a folder per value in the load's folder, a table files
    of few values. Rows of a partitioned table are gathered by its partitions.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    spark = df.sparkSession
    opened = open_target(spark, target, location)
    have = {c.lower() for c in df.columns}
    if split_by and split_by.lower() not in have:
        raise ValueError(f"no column {split_by!r} to split by")
    opened.split_by = split_by
    exists = opened.exists()
    if mode == "empty" and exists and not opened.read().isEmpty():
        raise TargetNotEmpty(f"{target} holds rows")
    before = opened.count() if exists and mode != "empty" else 0

    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if report_col:
        metrics.append(F.max(report_col).cast("string").alias("report"))
    gather = [c for c in opened.partition_columns() if c.lower() in have]
    # Before the count, which then is part of the write's own stage: a task that runs twice counts once.
    df = df.hint("rebalance", *gather) if gather or rebalance else df
    counted = df.observe(seen, *metrics)
    if not exists:
        opened.create(counted)
    elif mode == "append":
        opened.append(counted, add_columns)
    elif mode == "recreate":
        opened.recreate(counted)
    else:
        opened.truncate(counted)

    rows = seen.get["rows"]
    opened.commit(rows)
    total = before + rows if mode == "append" else rows
    report_max = seen.get.get("report")
    if report_col and mode == "append" and before:
        # The target's largest value is among those that reach the load's: few row groups hold such.
        held = opened.read()
        if report_max is not None:
            held = held.where(F.col(report_col) >= F.lit(report_max).cast(held.select(report_col).schema[0].dataType))
        report_max = held.agg(F.max(report_col).cast("string")).first()[0]
    return LoadResult(target, before, rows, total, report_max)


def bucketed(df: DataFrame, name: str, key: str, buckets: int, location: str) -> DataFrame:
    """df as a table in buckets of a key, sorted within: tables of as many buckets meet on it without a shuffle.

    Worth it for a source and a list that meet again and again. A bucket is one task of a join, so
    buckets are sized for the largest table, and a key that holds much of the rows is better
    left to a join that shuffles.
    """
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", location).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def stage(df: DataFrame, path: str, split_by: str | None = None) -> None:
    """Write an extract as parquet, replacing what was staged before.

    With split_by there is one folder per value. The rebalance hint gathers each value
    into few files and lets Spark split a value that holds much of the data.
    """
    if split_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        df.hint("rebalance", split_by).write.mode("overwrite").partitionBy(split_by).parquet(path)
