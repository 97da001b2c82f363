"""Run logs: text lines to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A log line, and the messages that carry a value.
LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d+)?) - (\S+) (.*)$"
MARK = r" Max date = (.*)$"
TO_LOAD = r"Rows to load = (\d+)"
ADDED = r"Total rows added for (\S+) = (-?\d+) for a total table count of (\d+)"
EVENTS = {
    "Starting": "start",
    "No date comparison": "full",
    "Max date =": "watermark",
    "Rows to load =": "count",
    "does not have any new rows": "up_to_date",
    "Getting data": "extract",
    "Writing parquet": "stage",
    "uploading parquet": "upload",
    "Copying": "load",
    "Total rows added": "loaded",
}


def _part(col: str, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def parse_log_lines(lines: DataFrame) -> DataFrame:
    """Lines in column `value` to (logged_at, table_name, event, message, ...); lines of
    another shape give no row."""
    fields = lines.where(F.col("value").rlike(LINE)).select(
        F.regexp_extract("value", LINE, 1).cast("timestamp_ntz").alias("logged_at"),
        F.regexp_extract("value", LINE, 2).alias("table_name"),
        F.regexp_extract("value", LINE, 3).alias("message"),
    )
    event = F.lit("other")
    for text, name in reversed(EVENTS.items()):
        event = F.when(F.col("message").contains(text), name).otherwise(event)
    return fields.select(
        "logged_at",
        "table_name",
        event.alias("event"),
        "message",
        _part("message", MARK, 1).alias("watermark"),
        _part("message", TO_LOAD, 1).cast("bigint").alias("rows_to_load"),
        _part("message", ADDED, 2).cast("bigint").alias("rows_added"),
        _part("message", ADDED, 3).cast("bigint").alias("rows_total"),
    )


def parse_run_logs(spark: SparkSession, path: str) -> DataFrame:
    return parse_log_lines(spark.read.text(path))
