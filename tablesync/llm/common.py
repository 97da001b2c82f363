"""What the operators of this package share: word hashes, scratch tables, linked components."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete, new_path, shuffles_released

BLANKS = b" \t\n\v\f\r"
CHUNK = 1 << 20  # bytes of text that are hashed at once
MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
WORD_STEP = np.uint64(0xD6E8FEB86659FD93)


def column(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, wanted: str) -> str:
    """wanted, or a longer name if df already has that one."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


class Scratch:
    """Tables in the shared folder that a job writes on its way, and removes when done with them."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.label = f"{label}-{uuid.uuid4().hex[:8]}"

    def save(self, df: DataFrame, name: str) -> tuple[DataFrame, str]:
        """df written and read back, which cuts its lineage, and its path."""
        path = new_path(self.spark, f"{self.label}-{name}")
        with shuffles_released(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, *paths: str | None) -> None:
        for path in paths:
            if path:
                delete(self.spark, path)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


class _Tables:
    """Powers that grow with the longest chunk seen, one set per Python worker."""

    up = _powers(MULTIPLIER, 1 << 12)
    down = _powers(pow(MULTIPLIER, -1, 1 << 64), 1 << 12)
    byte = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER))

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.up) < n:
            cls.up = _powers(MULTIPLIER, n)
            cls.down = _powers(pow(MULTIPLIER, -1, 1 << 64), n)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are no ASCII white space."""
    blank = np.ones(len(data) + 2, dtype=bool)
    np.less_equal(data - np.uint8(9), 4, out=blank[1:-1])  # below 9 it wraps
    blank[1:-1] |= data == 32
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[0::2], edges[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, by differences of one running sum."""
    _Tables.reach(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    values = _Tables.byte[data]
    values *= _Tables.up[: len(data)]
    np.cumsum(values, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _Tables.down[starts] + (ends - starts).astype(np.uint64))


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about CHUNK bytes, cut at white space only."""
    at = 0
    while len(text) - at > CHUNK:
        cut = max(text.rfind(c, at, at + CHUNK) for c in (b" ", b"\n"))
        if cut <= at:  # a word longer than a chunk stays whole
            cut = min((i for c in BLANKS if (i := text.find(bytes([c]), at + 1)) > 0), default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def _chunks(texts: Iterable[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    held, size = [], 0
    for i, text in enumerate(texts):
        for piece in _pieces(text):
            held.append((i, piece))
            size += len(piece) + 1
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased) in order, and the number of words of each text."""
    counts = np.zeros(len(texts), dtype=np.int64)
    parts = []
    for chunk in _chunks(texts):
        data = np.frombuffer(b"\n".join(p for _, p in chunk).translate(LOWER), dtype=np.uint8)
        starts, ends = word_bounds(data)
        parts.append(span_hashes(data, starts, ends))
        limits = np.cumsum([len(p) + 1 for _, p in chunk])
        per_piece = np.diff(np.searchsorted(starts, limits), prepend=0)
        np.add.at(counts, [i for i, _ in chunk], per_piece)
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64), counts


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of size words; fewer words make one run, none make none."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        out += words[i : i + n] * _power_of_step(i)
    return mixed(out)


def _power_of_step(i: int) -> np.uint64:
    return np.uint64(pow(int(WORD_STEP), i + 1, 1 << 64))


def slices(batches, text_column: str, most: int = 4 * CHUNK):
    """Arrow batches in pieces of about `most` bytes of text; a longer text is a piece of its own."""
    for batch in batches:
        lengths = batch.column(text_column).cast("binary")
        lengths = [len(v.as_buffer()) if v.is_valid else 0 for v in lengths]
        first, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += n
        if first < batch.num_rows:
            yield batch.slice(first)


def as_bytes(values) -> list[bytes]:
    """An Arrow column of texts as UTF-8; a null is an empty text."""
    return [b"" if v is None else v for v in values.cast("binary").to_pylist()]


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """Each node that has an edge, with its component's smallest node: (node, component).

    Rounds of contraction: every node points at its neighbour with the smallest hash, if
    smaller than its own, edges move to the nodes pointed at, and repeats collapse. Hashes
    make the number of rounds grow with the logarithm of the nodes, whatever the shape.
    Rounds read and write tables in the shared folder; a node's many edges meet only in
    minimums, which combine before the shuffle, and in joins that Spark can split.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), c.alias("node"))
    links = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    links, links_at = scratch.save(links, "links")
    both = links.select(F.explode(F.array("a", "b")).alias("node"))
    labels, labels_at = scratch.save(both.distinct().withColumn("label", F.col("node")), "labels")
    while not links.isEmpty():
        ends = links.select("a", "b").union(links.select("b", "a"))
        to = ends.groupBy("a").agg(F.least(F.min(rank(F.col("b"))), F.first(rank(F.col("a"))))["node"].alias("to"))
        to, to_at = scratch.save(to, "to")
        moved = labels.join(to, labels["label"] == to["a"], "left")
        new_labels, new_labels_at = scratch.save(
            moved.select("node", F.coalesce("to", "label").alias("label")), "labels"
        )
        left, right = to.toDF("a", "left"), to.toDF("b", "right")
        moved = links.join(left, "a").join(right, "b")
        moved = moved.select(F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b"))
        new_links, new_links_at = scratch.save(moved.where("a < b").distinct(), "links")
        scratch.drop(links_at, labels_at, to_at)
        links, links_at, labels, labels_at = new_links, new_links_at, new_labels, new_labels_at
    scratch.drop(links_at)
    least = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(least, "label").select("node", "component")


def runs(batches, keys: list[str]):
    """Consecutive rows with equal keys, as Arrow tables, from batches that are sorted by them.

    keys are whole numbers without nulls. A run may span batches; one is held at a time.
    """
    import pyarrow as pa

    held = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, part]) if held is not None else part
        if not held.num_rows:
            continue
        differs = np.zeros(held.num_rows - 1, dtype=bool)
        for key in keys:
            values = held.column(key).to_numpy()
            differs |= values[1:] != values[:-1]
        starts = [0, *(np.flatnonzero(differs) + 1).tolist()]
        held = held.combine_chunks()
        for a, b in zip(starts, starts[1:], strict=False):
            yield held.slice(a, b - a)
        held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held
