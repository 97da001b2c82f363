"""File scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet_tree(spark: SparkSession, path: str) -> DataFrame:
    """All *.parquet files below path, at any depth. Folder names add no columns;
    use read_files for a tree that was written with partition folders."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)


def read_files(spark: SparkSession, path: str, format: str = "parquet", **options) -> DataFrame:
    """Files of any format the session knows, partition folders included. Avro needs
    the spark-avro package on the class path; its logical types are read natively."""
    return spark.read.format(format).options(**options).load(path)


def load_new_files(spark: SparkSession, path: str, target: str, log: str, schema: T.StructType, format: str = "parquet",
                   change: Callable[[DataFrame], DataFrame] | None = None, files_per_batch: int = 1000, **options) -> int:
    """Append the rows of files below path that no earlier call with this log has loaded; how many rows.

    Files are told by their names, which the log in the shared folder keeps, so a call lists the
    folder and reads what is new, files_per_batch at a time. Target is a folder of parquet files
    with a log of its own: a batch that is repeated after a failure does not count twice. change
    is applied to the rows on their way.
    """
    rows = spark.readStream.format(format).schema(schema).options(maxFilesPerTrigger=files_per_batch, **options).load(path)
    rows = change(rows) if change else rows
    run = rows.writeStream.format("parquet").option("checkpointLocation", log).trigger(availableNow=True).start(target)
    run.awaitTermination()
    return sum(p["numInputRows"] for p in run.recentProgress)


def read_csv_strings(spark: SparkSession, path: str, sep: str = ",", **options) -> DataFrame:
    """CSV files with one header: names trimmed, every column a nullable string.

    Columns go by position, so a file whose header differs from the first one's is an error.
    """
    df = spark.read.options(header=True, inferSchema=False, enforceSchema=False, sep=sep, **options).csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per object: its path and its whole text. An object without bytes gives no row."""
    return spark.read.text(path, wholetext=True).selectExpr("_metadata.file_path AS path", "value AS text")
