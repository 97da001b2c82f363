"""Every registered query against its SQL in DuckDB, at SF `TEST_SF_DIR`."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from checks import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    assert rows
    expected = duck.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert bag(df.columns, rows) == bag(expected.columns, expected.fetchall())
