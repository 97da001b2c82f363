"""Every operator as a query over the given tables, next to the SQL that must agree."""

from . import loads, restrict, sources, sync, watermark  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
