"""Catalog tables, SQL text and column metadata."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMN_SCHEMA = "table_name string, ordinal int, name string, type string, mode string, description string"


def read_table(spark: SparkSession, name_or_sql: str) -> DataFrame:
    """A catalog table by name, or the result of a query."""
    text = name_or_sql.strip()
    return spark.sql(text) if any(c.isspace() for c in text) else spark.table(text)


def catalog_columns(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    """Name, type, mode and description of each column; every column is nullable and
    described by its own name. Reads metadata only."""
    rows = [
        (table, i, c.name, c.dataType, "Nullable", c.name)
        for table in tables
        for i, c in enumerate(spark.catalog.listColumns(table), start=1)
    ]
    return spark.createDataFrame(rows, COLUMN_SCHEMA).orderBy("table_name", F.col("ordinal"))
