"""Session helpers: where jobs may write, and how they cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Where paths handed out in this thread are noted, if anywhere.
_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def local_session(cores: int | str = "*", **conf) -> SparkSession:
    """A session for tests and benches; on a cluster the deployer supplies one."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tablesync")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a purely local session may fall back to a temporary folder.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tablesync-")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    path = f"{shared_dir(spark)}/tablesync/{label}-{uuid.uuid4().hex}"
    if (noted := _noted.get()) is not None:
        noted.append(path)
    return path


@contextmanager
def noting(paths: list[str]) -> Iterator[None]:
    """Note in paths what new_path hands out in this thread."""
    before = _noted.set(paths)
    try:
        yield
    finally:
        _noted.reset(before)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Remove at the end, after a failure too, what was written to new paths of this thread."""
    paths: list[str] = []
    try:
        with noting(paths):
            yield
    finally:
        for path in paths:
            delete(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Let shuffle files go with the query that made them, not when the driver next collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted; one listing however many there are."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return sorted(s.getPath().toString() for s in found or [])


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path).close()
