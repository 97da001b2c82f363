"""SQL text: one query, a template with parameters, a script."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.watermark import Watermark

# Placeholders of manifest queries for table, date column and mark.
PLACEHOLDERS = {"1": "table", "2": "column", "3": "mark"}

# A semicolon, or a stretch of text inside which a semicolon does not end a statement.
QUOTED = r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`[^`]*`|--[^\n]*|/\*.*?\*/"""
PIECE = re.compile(QUOTED + r"|;|\bBEGIN\b|\bCASE\b|\bEND(?:\s+(?:IF|WHILE|LOOP|REPEAT|FOR|CASE)\b)?|\w+", re.S | re.I)
COMMENT = re.compile(r"--[^\n]*|/\*.*?\*/", re.S)
BLOCK = re.compile(r"\s*BEGIN", re.I)


def run_sql(spark: SparkSession, text: str, args: Mapping | None = None) -> DataFrame:
    return spark.sql(text, args=dict(args)) if args else spark.sql(text)


def sql_template(
    spark: SparkSession, text: str, table: str, column: str | None = None, mark: Watermark | None = None
) -> DataFrame:
    """A query with $1 table, $2 date column and $3 mark, or :table, :column and :mark.

    They are bound as parameters of the statement, not pasted into its text. A quoted
    '$3' is one parameter as well.
    """
    names = re.sub(r"'\$3'|\$3(?!\d)", ":mark", text)
    names = re.sub(r"\$([12])(?!\d)", lambda m: f"IDENTIFIER(:{PLACEHOLDERS[m[1]]})", names)
    values = {"table": table, "column": column, "mark": mark.text if mark else None}
    return spark.sql(names, args={k: v for k, v in values.items() if v is not None})


def bind_query(text: str, table: str, column: str | None = None, mark: str | None = None) -> str:
    """The text of a query for another database, which takes no Spark parameters.

    $1, $2 and $3 are replaced, $10 is not.
    """
    values = {"1": table, "2": column, "3": mark}
    return re.sub(r"\$([123])(?!\d)", lambda m: m[0] if values[m[1]] is None else values[m[1]], text)


def statements(text: str) -> list[str]:
    """The statements of a script: split at semicolons outside quotes, comments and blocks.

    A statement that begins with BEGIN goes on to the END that closes it, with all it declares,
    loops over and branches to; Spark runs it whole.
    """
    parts, begin, depth = [], 0, None  # depth is None outside a block
    for m in PIECE.finditer(text):
        word = m[0].upper()
        if word == ";" and not depth:
            parts.append(text[begin : m.start()])
            begin, depth = m.end(), None
        elif word == "BEGIN" and depth is None:
            depth = 1 if BLOCK.fullmatch(COMMENT.sub(" ", text[begin : m.end()])) else None
        elif depth and word in ("BEGIN", "CASE"):
            depth += 1
        elif depth and word.split() in (["END"], ["END", "CASE"]):  # END IF and its like close what opened no block
            depth -= 1
    parts.append(text[begin:])
    return [p.strip() for p in parts if COMMENT.sub("", p).strip()]


@dataclass(frozen=True)
class StatementResult:
    statement: str
    result: DataFrame

    @property
    def message(self) -> str | None:
        """'Statement complete' for a statement without rows."""
        empty = not self.result.columns or self.result.isEmpty()
        return "Statement complete" if empty else None


def run_script(spark: SparkSession, text: str) -> list[StatementResult]:
    """Run the statements in order; a failing one stops the script."""
    return [StatementResult(s, spark.sql(s)) for s in statements(text)]
