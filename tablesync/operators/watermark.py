"""The high-water mark of a target, and the source rows past it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The mark of a target that has no rows.
EPOCH = "1970-01-01 00:00:00"

# Characters kept of `yyyy-MM-dd HH:mm:ss.ffffff` per precision.
KEPT = {"micro": 26, "milli": 23, "second": 19}

# The same for instants, whose offset keeps the text exact in any session time zone.
OFFSET_FORMATS = {
    "micro": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
    "milli": "yyyy-MM-dd HH:mm:ss.SSSXXX",
    "second": "yyyy-MM-dd HH:mm:ssXXX",
}

PRECISIONS = (*KEPT, "int", "epoch_ms")


@dataclass(frozen=True)
class Watermark:
    """A mark as text, bound as a literal of the compared column's type."""

    text: str

    def literal(self, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.NumericType) and self.text == EPOCH:
            return F.lit(0).cast(dtype)
        return F.lit(self.text).cast(dtype)


def dtype_of(df: DataFrame, col: str) -> T.DataType:
    """The type of a column, whose name may differ in case."""
    return df.select(col).schema[0].dataType


def resolve_watermark(target: DataFrame, col: str, precision: str = "micro") -> DataFrame:
    """One row, one text column `watermark`: the largest value of col in the target.

    micro is exact. milli and second cut the fraction, so a reload may repeat rows of
    that last unit. int keeps whole numbers such as ccyymm. epoch_ms reads whole
    milliseconds as a UTC time of whole seconds.
    """
    if precision not in PRECISIONS:
        raise ValueError(f"unknown precision {precision!r}, expected one of {PRECISIONS}")
    dtype = dtype_of(target, col)
    largest = F.max(F.col(col))
    if precision == "epoch_ms":
        text = F.expr(
            f"cast(timestamp_ntz'{EPOCH}' + make_dt_interval(0, 0, 0, max(`{col}`) div 1000) as string)"
        )
    elif precision == "int" or not isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.StringType)):
        text = largest.cast("string")
    elif isinstance(dtype, T.TimestampType):
        text = F.date_format(largest, OFFSET_FORMATS[precision])
    else:
        text = F.substring(largest.cast("string"), 1, KEPT[precision])
    return target.agg(F.coalesce(text, F.lit(EPOCH)).alias("watermark"))


def read_watermark(
    target: DataFrame | None, col: str, precision: str = "micro", at_least: Watermark | None = None
) -> Watermark:
    """The mark as a value, so that it can reach the source scan as a literal.

    at_least is a mark the target reached before. Only row groups that may hold that
    or more are read; if nothing is there, the target was replaced and is read whole.
    """
    if target is None:
        return Watermark(EPOCH)
    if at_least is not None and at_least.text != EPOCH and precision != "epoch_ms":
        recent = target.where(F.col(col) >= F.lit(at_least.text).try_cast(dtype_of(target, col)))
        found = resolve_watermark(recent, col, precision).first()[0]
        if found != EPOCH:
            return Watermark(found)
    return Watermark(resolve_watermark(target, col, precision).first()[0])


def newer_than(df: DataFrame, col: str | None, mark: Watermark | str | None) -> DataFrame:
    """Rows strictly past the mark; all rows when there is no date column."""
    if col is None:
        return df
    mark = Watermark(mark) if isinstance(mark, str) else mark
    return df.where(F.col(col) > mark.literal(dtype_of(df, col)))


def count_new(df: DataFrame, col: str | None, mark: Watermark | str | None) -> DataFrame:
    """One row: how many rows lie past the mark. Reads the date column only."""
    return newer_than(df, col, mark).agg(F.count("*").alias("rows_to_load"))


def footer_marks(spark: SparkSession, path: str, col: str) -> DataFrame:
    """One row: the largest value of a column of parquet files as text `watermark`, and their `rows`.

    Spark answers both from the files' footers, without reading a page, for columns of numbers
    and dates that are no partition folders; of times and texts, whose footers it does not trust,
    it reads the one column. The settings for that hold in a session of their own. Without rows the
    mark is the epoch.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    found = own.read.parquet(path).agg(F.max(F.col(col)).alias("largest"), F.count("*").alias("rows"))
    rows = F.greatest("rows", F.lit(0)).alias("rows")  # without files the footers give no count at all
    return found.select(F.coalesce(F.col("largest").cast("string"), F.lit(EPOCH)).alias("watermark"), rows)
