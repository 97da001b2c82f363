"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the k smallest distinct 48-bit hashes of a text's word shingles, written in order
as base64 text. A sketch of a union is the k smallest of both sketches, so sketches of parts
merge. Two sketches estimate resemblance and containment, one the number of shingles.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, column, shingle_hashes, word_hashes

K = 128
SHINGLE = 5
BITS = 48
ROWS_PER_BUCKET = 4096
MOST_BUCKETS = 8192


# Sketches as sorted arrays of numbers


def sketch(words: np.ndarray, k: int = K, shingle: int = SHINGLE) -> np.ndarray:
    """The sketch of a text given by its word hashes; a text without words has an empty one."""
    hashes = shingle_hashes(words, shingle) >> np.uint64(64 - BITS)
    if len(hashes) > 4 * k:  # the k smallest distinct ones are nearly always among these
        few = np.unique(np.partition(hashes, 2 * k)[: 2 * k])
        if len(few) >= k:
            return few[:k]
    return np.unique(hashes)[:k]


def sketches(texts: list[bytes], k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    words, counts = word_hashes(texts)
    return [sketch(part, k, shingle) for part in np.split(words, np.cumsum(counts)[:-1])] if texts else []


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness of two shingle sets; two empty ones are alike."""
    joined = np.concatenate([a, b])
    joined.sort()
    if not len(joined):
        return 1.0
    repeated = joined[1:] == joined[:-1]
    distinct = len(joined) - int(repeated.sum())
    if distinct <= k:
        return float(repeated.sum()) / distinct
    first = np.concatenate([[True], ~repeated])
    limit = joined[np.flatnonzero(first)[k - 1]]
    return float((repeated & (joined[1:] <= limit)).sum()) / k


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact for a sketch that isn't full."""
    return float(len(a)) if len(a) < k else (k - 1) * float(1 << BITS) / (float(a[k - 1]) + 1.0)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has too, from resemblance and both counts."""
    alike, n, m = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return 1.0 if not n else min(1.0, alike * (n + m) / (1 + alike) / n)


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :].tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), dtype=np.uint8).reshape(-1, BITS // 8)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, 8 - BITS // 8 :] = raw
    return wide.view(">u8").ravel().astype(np.uint64)


# Sketches in tables


def with_sketch(docs: DataFrame, k: int = K, shingle: int = SHINGLE, text_col: str = "text",
                out: str = "fingerprint") -> DataFrame:
    """docs with a column more: the sketch of each text. Null and blank texts have an empty one.

    out replaces a column of that name.
    """

    @F.pandas_udf("string")
    def run(texts):
        return texts.__class__([to_text(s) for s in sketches([t.encode() for t in texts], k, shingle)], index=texts.index)

    return docs.withColumn(out, run(F.coalesce(column(text_col).cast("string"), F.lit(""))))


def merged(parts: DataFrame, by: str, k: int = K, sketch_col: str = "fingerprint") -> DataFrame:
    """One sketch per value of by, null included, of all its parts' shingles: (by, fingerprint).

    The smallest values of a group are found per task before they meet, so a group of any
    size sends at most k values from each task.
    """

    @F.pandas_udf("array<long>")
    def values(texts):
        return texts.map(lambda t: from_text(t or "").astype(np.int64))

    @F.pandas_udf("string")
    def text_of(lists):
        return lists.map(lambda x: to_text(np.sort(np.array(x, dtype=np.uint64))))

    group = F.struct(column(by).alias("value"))
    rows = parts.select(group.alias("group"), F.explode_outer(values(column(sketch_col))).alias("v"))
    rank = F.row_number().over(Window.partitionBy("group").orderBy(F.col("v").asc_nulls_last()))
    smallest = rows.distinct().withColumn("rank", rank).where(F.col("rank") <= k)
    lists = smallest.groupBy("group").agg(F.collect_list("v").alias("v"))
    return lists.select(F.col("group.value").alias(by), text_of("v").alias(sketch_col))


def edited(text: str, following: str) -> str:
    """text with its last third replaced by as many characters from the start of the next one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _buckets(ids: DataFrame) -> tuple[Bucketizer, int, list[tuple]]:
    """Ranges of ids, largest first, and each one's number and first id."""
    wanted = min(MOST_BUCKETS, -(-max(ids.count(), 1) // ROWS_PER_BUCKET))
    cuts = ids.approxQuantile("key", [i / wanted for i in range(1, wanted)], 0.1 / wanted) if wanted > 1 else []
    splits = [float("-inf"), *sorted({c for c in cuts if abs(c) < float("inf")} or {0.0}), float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="key", outputCol="bucket")
    found = bucketizer.transform(ids).groupBy("bucket").agg(F.max("id").alias("id")).orderBy("bucket").collect()
    return bucketizer, len(splits) - 1, [(int(r["bucket"]), r["id"]) for r in found]


def compare_with_next(docs: DataFrame, k: int = K, shingle: int = SHINGLE, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Each text's sketch against its edited text's and against the next document's.

    Documents follow each other by descending id, null ids last, equal ids by text; after
    the last comes the first. Ids are numbers. Returns (doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, n_shingles), a row per row of
    docs. Null texts are empty; an empty table gives no rows; a single row is its own next.

    Texts are shuffled once, into ranges of ids that counts of the ids alone have cut (at most
    MOST_BUCKETS of them, about ROWS_PER_BUCKET rows each while there are fewer). The first
    row of each range is sent to the range before it as well.
    """
    spark = docs.sparkSession
    key = F.coalesce(-F.col("id").cast("double"), F.lit(float("inf")))
    ids = docs.select(column(id_col).alias("id")).withColumn("key", key)
    bucketizer, n_buckets, firsts = _buckets(ids)
    id_type = ids.schema["id"].dataType.simpleString()
    seams = [(firsts[i][1], firsts[i - 1][0]) for i in range(len(firsts))]
    seams = spark.createDataFrame(seams, f"first {id_type}, before int")
    narrow = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    rows = bucketizer.transform(narrow.withColumn("key", key)).withColumn("bucket", F.col("bucket").cast("int"))
    rows = rows.join(F.broadcast(seams), F.col("id").eqNullSafe(F.col("first")), "left")
    sent = F.array(F.struct(F.col("bucket").alias("to"), F.lit(False).alias("ahead")))
    seam = F.array(F.struct(F.col("before").alias("to"), F.lit(True).alias("ahead")))
    rows = rows.withColumn("sent", F.explode(F.when(F.col("before").isNull(), sent).otherwise(F.concat(sent, seam))))
    rows = rows.select("sent.to", "sent.ahead", "id", "text")
    tasks = min(n_buckets, max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_buckets // 8))
    rows = rows.repartition(tasks, "to").sortWithinPartitions("to", "ahead", F.col("id").desc_nulls_last(), "text")

    def run(batches):
        held = None  # the row whose next one has not come yet
        for batch in batches:
            size = max(1, batch.nbytes >> 22)
            for at in range(0, batch.num_rows, step := -(-batch.num_rows // size)):
                part = batch.slice(at, step)
                texts = as_bytes(part.column("text"))
                rows = list(zip(part.column("to").to_pylist(), part.column("ahead").to_pylist(),
                                part.column("id").to_pylist(), texts, sketches(texts, k, shingle), strict=True))
                rows = [held, *rows] if held else rows
                held = rows[-1]
                yield _compared([(a, b) for a, b in zip(rows, rows[1:], strict=False) if not a[1] and a[0] == b[0]], k, shingle, id_arrow, names)

    schema = (f"`{id_col}` {id_type}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double, n_shingles double")
    id_arrow = pa_type(spark, id_type)
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_shingles"]
    return rows.mapInArrow(run, schema)


def pa_type(spark, simple: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(spark.createDataFrame([], f"x {simple}").schema[0].dataType)


def _compared(pairs: list[tuple], k: int, shingle: int, id_arrow, names: list[str]) -> pa.RecordBatch:
    texts = [a[3].decode(errors="replace") for a, _ in pairs]
    changed = [edited(t, b[3].decode(errors="replace")).encode() for t, (_, b) in zip(texts, pairs, strict=True)]
    others = sketches(changed, k, shingle)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([a[2] for a, _ in pairs], id_arrow),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
            pa.array([to_text(a[4]) for a, _ in pairs], pa.string()),
            pa.array([to_text(s) for s in others], pa.string()),
            pa.array([resemblance(a[4], s, k) for (a, _), s in zip(pairs, others, strict=True)], pa.float64()),
            pa.array([resemblance(a[4], b[4], k) for a, b in pairs], pa.float64()),
            pa.array([distinct_shingles(a[4], k) for a, _ in pairs], pa.float64()),
        ],
        names,
    )
