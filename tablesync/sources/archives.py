"""Zip archives as rows of member content."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART_BYTES = 32 * 1024 * 1024

MEMBER_SCHEMA = "archive string, member string, part int, content binary"
COLUMNS = ["archive", "member", "part", "content"]


def _parts(path: str, content: bytes) -> Iterator[tuple[str, str, int, bytes]]:
    """Members of one archive, long ones in several parts; none if it is no archive."""
    stream = io.BytesIO(content)
    if not zipfile.is_zipfile(stream):
        return
    with zipfile.ZipFile(stream) as archive:
        for info in archive.infolist():
            with archive.open(info) as member:
                part, chunk = 0, member.read(PART_BYTES)
                while chunk or part == 0:
                    yield path, info.filename, part, chunk
                    part, chunk = part + 1, member.read(PART_BYTES)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of bounded bytes: a task never holds a whole expanded archive."""
    rows, held = [], 0
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            for row in _parts(path, content):
                rows.append(row)
                held += len(row[3])
                if held >= PART_BYTES:
                    yield pd.DataFrame(rows, columns=COLUMNS)
                    rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=COLUMNS)


def expand_members(archives: DataFrame) -> DataFrame:
    """(path, content) rows to one row per archive member.

    Content that is not a zip archive gives no rows. A member longer than PART_BYTES
    comes as several rows, numbered by part; any other has the single part 0.
    """
    return archives.select("path", "content").mapInPandas(_members, MEMBER_SCHEMA)


def expand_archives(spark: SparkSession, path: str) -> DataFrame:
    """Members of all archives that path matches; `<archive>/<member>` names each.

    Archives spread over tasks one by one: a file is not split, and a task takes few.
    """
    return expand_members(spark.read.format("binaryFile").load(path))
