"""Sources by configured name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .catalog import read_table
from .jdbc import read_jdbc


class UnknownServer(Exception):
    """A manifest entry names a connection that is not configured."""


class Connections:
    """Named sources, from configuration the caller supplies.

    Each is a mapping with a `format`:

    jdbc     Spark's jdbc options, plus `dialect`, `database` and `timezone`
    table    catalog tables; `database` is put before plain names
    other    files; `path` holds {table}, the rest are reader options
    """

    def __init__(self, spark: SparkSession, configs: Mapping[str, Mapping[str, str]]):
        self.spark = spark
        self._configs = {name.strip().lower(): dict(c) for name, c in configs.items()}

    def config(self, server: str | None) -> dict[str, str]:
        try:
            return dict(self._configs[(server or "").strip().lower()])
        except KeyError:
            raise UnknownServer(f"no connection is named {server!r}") from None

    def is_jdbc(self, server: str | None) -> bool:
        return self.config(server)["format"] == "jdbc"

    def dialect(self, server: str | None) -> str | None:
        return self.config(server).get("dialect")

    def timezone(self, server: str | None) -> str:
        return self.config(server).get("timezone", "UTC")

    def read(self, server: str | None, table: str, **jdbc) -> DataFrame:
        """A table of the named source; jdbc sources take a query as well."""
        config = self.config(server)
        format = config.pop("format")
        if format == "jdbc":
            return read_jdbc(self.spark, config, table, **jdbc)
        if format == "table":
            database = config.get("database")
            return read_table(self.spark, f"{database}.{table}" if database and "." not in table else table)
        path = config.pop("path").format(table=table)
        return self.spark.read.format(format).options(**config).load(path)
