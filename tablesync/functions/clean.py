"""Column clean-up on the way in: control characters and declared types."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters a line-oriented table cannot hold inside a field.
DELIMITERS = "\n\r\x01"

# Declared type name -> type of the loaded column.
DECLARED_TYPES = {
    "string": "string",
    "INTEGER": "decimal(38,0)",
    "long": "bigint",
    "FLOAT": "decimal(20,5)",
    "date": "timestamp_ntz",
}


def scrub_delims(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Remove line breaks and \\x01 from the named, or from all, string columns."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    chosen = strings if cols is None else list(cols)
    wrong = sorted(set(chosen) - set(strings))
    if wrong:
        raise ValueError(f"not string columns: {wrong}")
    return df.withColumns({c: F.translate(F.col(c), DELIMITERS, "") for c in chosen})


def declared_type(declared: str) -> str:
    """The Spark type of a declared name; decimal(p,s) is kept, unknown names are strings."""
    decimal = re.fullmatch(r"decimal\(\s*(\d+)\s*,\s*(\d+)\s*\)", declared)
    if decimal:
        return f"decimal({decimal[1]},{decimal[2]})"
    return DECLARED_TYPES.get(declared, "string")


def conform(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Cast the mapped columns to their declared types; a value that does not fit fails."""
    absent = sorted(set(mapping) - set(df.columns))
    if absent:
        raise ValueError(f"no such columns: {absent}")
    return df.withColumns({c: F.col(c).cast(declared_type(t)) for c, t in mapping.items()})


def table_of_file(name: str) -> Column:
    """The table that a file's name stands for: what comes before the first dot and before `__`."""
    return F.split_part(F.split_part(F.col(name), F.lit("."), F.lit(1)), F.lit("__"), F.lit(1))
