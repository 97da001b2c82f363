"""Registry and the roles the given tables play."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

# The last moment that earlier runs have loaded, for orders and for events.
LOADED_UNTIL = "2000-01-01 00:00:00"
EVENTS_UNTIL = "2024-01-15 12:00:00"

T_SQL = f"orders WHERE o_orderdate <= TIMESTAMP '{LOADED_UNTIL}'"
W_SQL = f"(SELECT max(o_orderdate) FROM {T_SQL})"
R_SQL = "(SELECT * FROM customer WHERE c_mktsegment = 'BUILDING')"


def query(sql: str | None = None, name: str | None = None):
    """Register a query under a name, its function's by default, with its SQL if there is one."""

    def register(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLE_SQL[key] = sql
        return fn

    return register


def as_text(df: DataFrame, *cols: str) -> DataFrame:
    """Whole numbers that may be null as text, which every client reads the same way."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the target already holds."""
    return orders(spark, sf_dir).where(F.col("o_orderdate") <= F.lit(LOADED_UNTIL).cast("timestamp_ntz"))


def loaded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("ts") <= F.lit(EVENTS_UNTIL).cast("timestamp_ntz"))


def restricted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers that must not leave the source."""
    return table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
