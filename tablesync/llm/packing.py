"""Packing token sequences by bounded-space online best-fit.

Tokenising is a pass over the documents that writes one narrow row per piece. Packing then
streams pieces through a fixed number of open bins in each task: an item goes into the open
bin with the least sufficient free space, found as the lowest set bit of a bitset keyed by
free space; when no bin takes it a new one is opened, and the fullest bin closes if too many
are open. A task's memory is the open bins, whatever the number of pieces, and a task gets
PIECES_PER_TASK pieces, so what bins stay unfilled at a task's end is a fixed small share.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, column

LENGTH = 2048
OPEN_BINS = 256
PIECES_PER_TASK = 100_000
END_ID = 0
BPE_JSON = "byte_bpe_50k.json"
BPE_RANKS = "byte_bpe_50k.tiktoken"


def vocabulary_paths() -> tuple[str, str]:
    """Where the installed public vocabulary is: its tokenizers file and the same ranks."""
    import public_tokenizers

    return public_tokenizers.path(BPE_JSON), public_tokenizers.path(BPE_RANKS)


class Encoder:
    """Token ids of a text, as the tokenizers file gives them.

    Most texts hold only characters on whose classes every regular expression engine agrees
    (ASCII, Latin letters, common punctuation). They take a faster engine over the same ranks,
    whose ids are the same; all others take the tokenizers library itself.
    """

    plain = re.compile("[\t\n\r -~¡-©«-±´¶-¸»¿-ɏ‐-‧]*", re.DOTALL)
    special = "<|endoftext|>"

    def __init__(self, json_path: str, ranks_path: str | None):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(json_path)
        self.fast = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast and self.plain.fullmatch(text) and self.special not in text:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all full, but for the first."""
    first = n % length or min(n, length)
    return [(0, first), *((at, length) for at in range(first, n, length))]


def pieces(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
           order: list[Column] = (), paths: tuple[str, str | None] | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) and the order columns, a row per piece of each document.

    A null text counts as empty, bytes that are no UTF-8 as U+FFFD. An empty table gives no rows.
    """
    json_path, ranks_path = paths or vocabulary_paths()
    orders = [c.alias(f"order{i}") for i, c in enumerate(order)]
    narrow = docs.select(column(id_col).alias(id_col), column(text_col).cast("string").alias(text_col), *orders)
    kept = [f for i, f in enumerate(narrow.schema) if i != 1]

    def run(batches):
        encode = Encoder(json_path, ranks_path)
        for batch in batches:
            rows, piece, start, size, crc = [], [], [], [], []
            for i, value in enumerate(batch.column(1).cast("binary")):
                text = (value.as_py() or b"").decode(errors="replace")
                ids = np.append(encode(text), np.uint32(END_ID)).astype("<u4", copy=False)
                for k, (at, n) in enumerate(cut(len(ids), length)):
                    rows.append(i)
                    piece.append(k)
                    start.append(at)
                    size.append(n)
                    crc.append(zlib.crc32(ids[at : at + n].tobytes()))
            take = pa.array(rows, pa.int64())
            columns = [batch.column(i).take(take) for i in range(batch.num_columns) if i != 1]
            new = [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, size, crc))]
            yield pa.RecordBatch.from_arrays(columns + new, names)

    fields = [*kept, T.StructField("piece", T.IntegerType()),
              *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))]
    names = [f.name for f in fields]
    return narrow.mapInArrow(run, T.StructType(fields))


class Bins:
    """At most `most` open bins; place() says which bin an item goes to, and where in it."""

    def __init__(self, length: int, most: int):
        self.length, self.most, self.open = length, most, 0
        self.free: int = 0  # bit f is set if a bin with f places is open
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.made = 0

    def _take(self, space: int) -> int:
        bins = self.by_free[space]
        taken = bins.pop()
        if not bins:
            self.free ^= 1 << space
        self.open -= 1
        return taken

    def _put(self, number: int, space: int) -> None:
        if space:
            self.by_free[space].append(number)
            self.free |= 1 << space
            self.open += 1

    def place(self, size: int) -> tuple[int, int]:
        enough = self.free >> size
        if enough:
            space = size + (enough & -enough).bit_length() - 1
            number = self._take(space)
        else:
            if self.open >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            space, number = self.length, self.made
            self.made += 1
        self._put(number, space - size)
        return number, self.length - space


def pack(docs: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, id_col: str = "doc_id",
         text_col: str = "text", order: list[Column] = (), paths: tuple[str, str | None] | None = None) -> DataFrame:
    """Where every piece of every document goes: pieces() with sequence_id and offset.

    With order columns, each task packs a range of that order front to back, so a sequence
    holds documents that are near each other; else pieces come in the order of a hash. Null
    and empty texts are one piece of one id. Repeated rows are packed each. An empty table
    gives no rows. Columns of docs other than the id are not returned.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    rows, _ = scratch.save(pieces(docs, length, id_col, text_col, order, paths), "pieces")
    tasks = -(-max(rows.count(), 1) // PIECES_PER_TASK)
    if order:
        by = [F.col(f"order{i}") for i in range(len(order))]
        dealt = rows.repartitionByRange(tasks, *by).sortWithinPartitions(*by, "piece")
    else:
        by = F.xxhash64(column(id_col), "piece", "ids_crc32")
        dealt = rows.withColumn("order0", by).repartition(tasks, "order0").sortWithinPartitions("order0", column(id_col), "piece")
    at = dealt.columns.index("length")

    def run(batches):
        bins, base = Bins(length, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            places = [bins.place(n) for n in batch.column(at).to_pylist()]
            new = [pa.array([base + number for number, _ in places], pa.int64()), pa.array([x for _, x in places], pa.int64())]
            kept = [batch.column(i) for i in keep]
            yield pa.RecordBatch.from_arrays(kept + new, names)

    keep = [i for i, c in enumerate(dealt.columns) if not re.fullmatch(r"order\d+", c)]
    fields = [dealt.schema[i] for i in keep] + [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")]
    names = [f.name for f in fields]
    return dealt.mapInArrow(run, T.StructType(fields))
