"""Manifests: which tables to sync, and how."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.jdbc import SPLITS

# Fields of an entry.
FIELDS = ("action", "datecolumn", "dntl", "gcptable", "query", "server", "splitby", "tablename")

# Fields that keep their case.
AS_WRITTEN = ("dntl", "query", "restrict_key", "read_by", "read_then_by", "restrict_read_by")

# Our own, optional. A declared restriction in place of SQL text, dntl being its source
# key; how the mark is cut and used; a parallel read of a database, and of the list; clean
# text; may the extract bring new columns, and whose largest value does the audit report.
OPTIONS = (
    "restrict_server", "restrict_table", "restrict_key", "normalise", "keep_right", "restrict_read_by",
    "precision", "extract", "read_by", "read_then_by", "read_parts", "scrub", "add_columns", "report_col",
)

# Texts that mean that a field is empty.
BLANKS = ("", "none", "nan", "null")

RAW_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in (*FIELDS, *OPTIONS)])


def manifest_rows(raw: DataFrame) -> DataFrame:
    """Entries with trimmed values, lower-cased except for queries and keys. Blank
    fields are null. `name` is the last part of the dotted table name."""
    have = {c.strip().lower(): c for c in raw.columns}

    def value(field: str):
        if field not in have:
            return F.lit(None).cast("string").alias(field)
        text = F.trim(F.col(f"`{have[field]}`").cast("string"))
        text = F.when(~F.lower(text).isin(*BLANKS), text)
        return (text if field in AS_WRITTEN else F.lower(text)).alias(field)

    entries = raw.select(*[value(f) for f in (*FIELDS, *OPTIONS)])
    return entries.withColumn("name", F.element_at(F.split("tablename", r"\."), -1))


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a YAML list or of a CSV file with a header, in file order."""
    if path.lower().endswith(".csv"):
        raw = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path)
        return manifest_rows(raw.toDF(*[c.strip() for c in raw.columns]))
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML manifests need PyYAML; CSV manifests do not") from e
    # A manifest is configuration: all files of the path come to the driver, in the order of their names.
    files = spark.read.text(path, wholetext=True).orderBy("_metadata.file_path").collect()
    listed = [e for file in files for e in yaml.safe_load(file[0]) or []]
    entries = [{str(k).strip().lower(): v for k, v in e.items()} for e in listed]
    rows = [tuple(None if e.get(f) is None else str(e[f]) for f in RAW_SCHEMA.names) for e in entries]
    return manifest_rows(spark.createDataFrame(rows, RAW_SCHEMA))


@dataclass(frozen=True)
class Entry:
    """One manifest entry. A manifest is configuration: its rows come to the driver."""

    position: int
    action: str | None
    datecolumn: str | None
    dntl: str | None
    gcptable: str
    query: str | None
    server: str | None
    splitby: str | None
    tablename: str
    restrict_server: str | None
    restrict_table: str | None
    restrict_key: str | None
    normalise: str
    keep_right: bool
    restrict_read_by: str | None
    precision: str
    extract: str | None
    read_by: str | None
    read_then_by: str | None
    read_parts: int
    scrub: bool
    add_columns: bool
    report_col: str | None
    problem: str | None = None  # why the entry can't run

    @classmethod
    def of(cls, position: int, row: Row) -> Entry:
        values = row.asDict()
        values.pop("name")
        values["normalise"] = values["normalise"] or "plain"
        values["precision"] = values["precision"] or "micro"
        parts = values["read_parts"] or str(SPLITS)
        values["read_parts"] = int(parts) if parts.isdecimal() and int(parts) else SPLITS
        missing = [f for f in ("gcptable", "tablename") if values[f] is None]
        if missing:
            values["problem"] = f"blank fields: {missing}"
        elif not parts.isdecimal() or not int(parts):
            values["problem"] = f"read_parts must be a whole number of 1 or more, not {parts!r}"
        for switch in ("keep_right", "scrub", "add_columns"):
            values[switch] = values[switch] in ("true", "yes", "1")
        return cls(position, **values)

    @property
    def split_read(self) -> dict:
        """How read_jdbc divides this entry's read."""
        return {"split_by": self.read_by, "then_by": self.read_then_by, "num_partitions": self.read_parts}

    @property
    def uses_mark(self) -> bool:
        """Does the extract itself filter by the mark, or only the decision to run it?"""
        if self.datecolumn is None:
            return False
        if self.query is not None:
            return "$3" in self.query or ":mark" in self.query
        return self.extract != "full"

    @property
    def pattern(self) -> str:
        if self.datecolumn is None:
            return "full"
        if not self.uses_mark:
            return "gated"
        return "delta_replace" if self.mode in ("truncate", "recreate") else "incremental"

    @property
    def mode(self) -> str:
        return self.action if self.action in ("append", "truncate", "recreate") else "empty"


def entries(manifest: DataFrame) -> list[Entry]:
    return [Entry.of(i, row) for i, row in enumerate(manifest.collect(), start=1)]
