"""Splits of a table into parts of about equal size, whatever its column's distribution."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 100  # a bound is off by at most this part of a share


def _literal(value) -> str:
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    return str(value)


def even_bounds(df: DataFrame, col: str, parts: int) -> list:
    """Up to parts - 1 ascending values that cut the column, nulls aside, into even shares.

    They come from a quantile sketch, which tasks build and merge: one row reaches the driver,
    whatever the number of rows. A value that holds more than a share is one bound.
    """
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(F.col(col), shares, ACCURACY * parts)).first()[0] if shares else []
    return sorted(set(found or []))


def even_predicates(df: DataFrame, col: str, parts: int) -> list[str]:
    """SQL conditions, each row meeting one, for a read in parallel parts; the last part has the nulls.

    For numbers, dates and times; df may be a sample or another copy of what is read, as the
    conditions cover every value.
    """
    bounds = [_literal(b) for b in even_bounds(df, col, parts)]
    if not bounds:
        return [f"{col} IS NOT NULL", f"{col} IS NULL"]
    inner = [f"{col} > {a} AND {col} <= {b}" for a, b in zip(bounds, bounds[1:], strict=False)]
    return [f"{col} <= {bounds[0]}", *inner, f"{col} > {bounds[-1]}", f"{col} IS NULL"]
