"""Key normalisation: what makes a source id equal to a restricted id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Restricted ids are zero padded and cut to this width.
PAD_WIDTH = 10
PADDING = "0000000000"

# Accents count, case and trailing blanks do not, and Unicode's equivalent spellings are one.
COLLATION = "UNICODE_CI_RTRIM"

KINDS = ("plain", "pad10", "ci", "pad10_ci", "collated", "pad10_collated", "numeric", "integer")


def padded(col: Column) -> Column:
    """The last ten characters of the zero-prefixed id.

    Not lpad: for an id longer than ten characters lpad keeps the left end.
    """
    return F.right(F.concat(F.lit(PADDING), col.cast("string")), F.lit(PAD_WIDTH))


def folded(col: Column) -> Column:
    """Fold case and trailing blanks, keep accents.

    A folded string compares byte by byte, so the join on it can be broadcast or
    hashed. A collated key would force a sort-merge join of the whole source.
    """
    return F.lower(F.rtrim(col.cast("string")))


def normalise_key(col: Column | str, kind: str = "plain", side: str = "source") -> Column:
    """The comparable form of an id column on the 'source' or the 'list' side.

    Padding applies to the list side only; a source id is compared as it stands.
    An id that a numeric kind cannot read becomes null, and null never matches.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown key normalisation {kind!r}, expected one of {KINDS}")
    if side not in ("source", "list"):
        raise ValueError(f"side must be 'source' or 'list', not {side!r}")
    col = F.col(col) if isinstance(col, str) else col
    if kind == "numeric":
        # A cast alone would round: an id with a fraction equals no whole number.
        whole, exact = col.try_cast("decimal(38,0)"), col.try_cast("decimal(38,9)")
        return F.when(exact.isNull() | (exact % 1 == 0), whole)
    if kind == "integer":
        return col.try_cast("bigint")
    if kind.startswith("pad10"):
        col = padded(col) if side == "list" else col.cast("string")
    if kind.endswith("_ci") or kind == "ci":
        col = folded(col)
    if kind.endswith("collated"):
        col = F.collate(col.cast("string"), COLLATION)
    return col
