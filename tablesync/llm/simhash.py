"""SimHash near-duplicates, found through segment popcounts.

A fingerprint has 64 bits: bit j is 1 if it is set in over half of the XXH64 hashes of the
text's word shingles. Two fingerprints that differ in at most m bits have segment popcounts
whose Manhattan distance is at most m too, because one flipped bit moves one popcount by one.
So fingerprints are embedded as 32 popcounts of 2 bits each and cut into m // 2 + 1 parts:
in one part at least the popcounts are equal or differ by one in one segment. Each part is a
grid of unit cells. A fingerprint lies in one cell of it and also probes the cells one step
up along each axis; a step down is the other fingerprint's step up. An equi-join on the cell
yields the candidates, and the bits of both are compared before a pair leaves the join.

Only distinct fingerprints are joined, so a group of copies, however large, is one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, Scratch, as_bytes, column, components, free_name

SEED = 42
SEGMENTS = 32  # of two bits each


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as an unsigned number; without words 0."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(shingle, len(words))
    last = ends[size - 1 :].tolist()
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, dtype=np.int64), len(last)
    for at in range(0, n, 1 << 16):  # the bits of a long text in blocks
        spans = zip(first[at : at + (1 << 16)], last[at : at + (1 << 16)], strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint long) of every row. A null or blank text has fingerprint 0."""
    narrow = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    id_type = narrow.schema["id"].dataType

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in as_bytes(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["id", "print"])

    schema = T.StructType([T.StructField("id", id_type), T.StructField("print", T.LongType())])
    return narrow.mapInArrow(run, schema)


def _cells(prints: DataFrame, parts: int, probes: bool) -> DataFrame:
    """(part, cell, print, probe): the cell each print lies in, and with probes those one step up."""
    groups = np.array_split(np.arange(SEGMENTS), parts)

    def run(batches):
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            counts = np.bitwise_count((own[:, None] >> np.arange(0, 64, 2, dtype=np.uint64)) & np.uint64(3))
            for part, segments in enumerate(groups):
                steps = 3 ** np.arange(len(segments), dtype=np.int64)
                cell = counts[:, segments].astype(np.int64) @ steps
                found = [(cell, own, False)]
                for k, segment in enumerate(segments if probes else ()):
                    rows = counts[:, segment] < 2
                    found.append((cell[rows] + steps[k], own[rows], True))
                for cells, of, probe in found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(of), part, np.int32)), pa.array(cells), pa.array(of.view(np.int64)),
                         pa.array(np.full(len(of), probe))],
                        ["part", "cell", "print", "probe"],
                    )

    return prints.select("print").mapInArrow(run, "part int, cell long, print long, probe boolean")


def linked_prints(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that differ in 1 to max_bits bits.

    prints must be distinct. A pair may come more than once.
    """
    parts = max_bits // 2 + 1
    left = _cells(prints, parts, False).select("part", "cell", F.col("print").alias("a"))
    right = _cells(prints, parts, True).select("part", "cell", F.col("print").alias("b"), "probe")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, max_bits)
    same = [F.col("l.part") == F.col("r.part"), F.col("l.cell") == F.col("r.cell")]
    once = F.col("probe") | (F.col("a") < F.col("b"))
    return left.alias("l").join(right.alias("r").hint("merge"), [*same, near, once]).select("a", "b")


def _classes(prints: DataFrame, max_bits: int, scratch: Scratch) -> DataFrame:
    """(print, component, component_id) of every distinct print, written."""
    distinct, distinct_at = scratch.save(prints.groupBy("print").agg(F.min("id").alias("id")), "distinct")
    groups, groups_at = scratch.save(components(linked_prints(distinct, max_bits), scratch), "groups")
    # A print without links is a component of its own.
    named = distinct.join(groups, distinct["print"] == groups["node"], "left")
    named = named.select("print", "id", F.coalesce("component", "print").alias("component"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    classes, _ = scratch.save(named.drop("id").join(least, "component"), "classes")
    scratch.drop(distinct_at, groups_at)
    return classes


def _found(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    scratch = Scratch(docs.sparkSession, "simhash")
    prints, _ = scratch.save(fingerprints(docs, shingle, id_col, text_col), "prints")
    return prints, _classes(prints, max_bits, scratch)


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of docs: (doc_id, fingerprint, component_id).

    component_id is the smallest id among the texts that links of at most max_bits bits
    reach, itself included; fingerprint is 16 hexadecimal digits. Null and blank texts have
    fingerprint zero and are linked like any other. Null ids count last: they name a
    component only if it has no other id. Repeated rows are copies. Other columns of docs,
    whatever their names, are neither read nor returned. An empty table gives no rows.
    """
    prints, classes = _found(docs, shingle, max_bits, id_col, text_col)
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return prints.join(classes, "print").select(F.col("id").alias(id_col), digits.alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """docs with one row of each group of near-duplicates, the one with the smallest id.

    Columns stay as they are. Where ids repeat or are null, a group keeps the row with the
    smallest id (null last) and, among those, the smallest text.
    """
    prints, classes = _found(docs, shingle, max_bits, id_col, text_col)
    repeats = prints.groupBy("id").count().where(F.col("id").isNull() | (F.col("count") > 1))
    if not repeats.isEmpty():
        return _first_rows(docs, classes, shingle, id_col, text_col)
    kept_id = free_name(docs, "kept_id")
    kept = classes.select(F.col("component_id").alias(kept_id)).distinct()
    return docs.join(kept, column(id_col) == F.col(kept_id), "left_semi")


def _first_rows(docs: DataFrame, classes: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """One whole row per component, for ids that don't tell rows apart."""

    @F.pandas_udf("long")
    def print_of(texts):
        return texts.map(lambda t: np.uint64(fingerprint(t.encode(), shingle)).view(np.int64))

    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    order = F.struct(column(id_col).isNull(), column(id_col).alias("id"), text.alias("text"))
    packed = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), order.alias("order"))
    packed = packed.withColumn("print", print_of("order.text")).join(classes, "print")
    first = packed.groupBy("component").agg(F.min_by("row", "order").alias("row"))
    return first.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
