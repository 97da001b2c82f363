"""Packing token sequences so that their attention costs are alike.

A piece of n tokens costs n for what grows with its length and n * n / BREAK_EVEN for attention
inside it; a sequence costs the sum of its pieces. Documents are dealt by a hash into buckets of
about BUCKET pieces. A bucket's tokens say how many sequences it fills: all of full length, and
for what is left one for each power of two in it, so that nothing is padded. Its documents come
longest first, and each goes to the sequence of lowest cost that has room for it. Only where none
has, it is cut: the lowest-cost sequence with any room is filled, and the rest goes on.

Tokenising is one pass, whose result is written once with two bytes a token; a bucket's total is
a sum over it that meets its bucket as the first row. A task streams its rows and holds a number
for each sequence of one bucket. Rows have numbers of their own, so repeated ones spread.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, column, mixed, span_hashes

LENGTH = 4096
BREAK_EVEN = 12_288  # tokens of a piece whose attention costs as much as all else of it
BUCKET = 10_000  # pieces
END_ID = 2
BPE_JSON = "word_bpe_49k.json"
BATCH_BYTES = 1 << 24
TEXTS = 1 << 22  # characters that are encoded at once
LETTER, DIGIT, OTHER = 1, 2, 3
# What the tokenizer cuts off after an apostrophe.
SHORT_ENDINGS, LONG_ENDINGS = ("s", "t", "m", "d"), ("re", "ve", "ll")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BPE_JSON)


class WordEncoder:
    """Token ids of texts, as the tokenizers file gives them.

    Its tokens never hold white space, so texts of characters whose case and class are plain
    are cut into words by numpy, and each word of a group of texts is encoded once, by a faster
    engine over the same merges in whose vocabulary MARK ends a word. Words are told apart by
    64-bit hashes and lengths. Any other text goes to the tokenizers library whole.
    """

    ascii = b"\t\n\r" + bytes(range(32, 127))
    plain = re.compile("[¡-©«-±´¶-¸»¿-įı-ž‐-‧]*")
    MARK = "\x01"

    def __init__(self, json_path: str):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(json_path)
        self.dtype = "<u2" if self.exact.get_vocab_size() <= 1 << 16 else "<u4"
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = self._fast(json_path)
        kinds = [0 if c.isspace() else LETTER if c.isalpha() else DIGIT if c.isdigit() else OTHER for c in map(chr, range(0x2028))]
        self.kinds = np.array(kinds, dtype=np.uint8)

    def _fast(self, json_path: str):
        import tiktoken

        with open(json_path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        end = model.get("end_of_word_suffix")
        if not end:
            return None
        # Byte-level vocabularies write the bytes that don't print as the characters from 256 on.
        prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in prints]
        byte = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks, self.ends = {}, np.zeros(self.exact.get_vocab_size(), dtype=bool)
        for token, rank in model["vocab"].items():
            if token not in self.special:
                self.ends[rank] = token.endswith(end)
                shown, mark = (token[: -len(end)], self.MARK) if self.ends[rank] else (token, "")
                ranks[bytes(byte[c] for c in shown) + mark.encode()] = rank
        return tiktoken.Encoding("words", pat_str=f"[^{self.MARK}]+{self.MARK}", mergeable_ranks=ranks, special_tokens={})

    def is_plain(self, text: str) -> bool:
        rest = text.encode(errors="replace").translate(None, self.ascii)
        return (not rest or self.plain.fullmatch(rest.decode()) is not None) and not any(s in text for s in self.special)

    def _words(self, text: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words: runs of letters or of signs, single digits, short endings."""
        kind = np.concatenate([[0], self.kinds[codes], [0]])
        edge = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        starts = np.flatnonzero(edge & (kind[1:] != 0))
        ends = np.flatnonzero((edge & (kind[:-1] != 0))[1:]) + 1
        for i in np.flatnonzero((codes[starts] == ord("'")) & (ends - starts == 1) & (kind[ends + 1] == LETTER)).tolist():
            after = text[ends[i] : ends[i] + 2]
            n = 2 if after in LONG_ENDINGS else 1 if after[0] in SHORT_ENDINGS else 0
            ends[i] += n
            starts[i + 1] += n
        kept = starts < ends
        return starts[kept], ends[kept]

    def _plain_ids(self, texts: list[str]) -> list[np.ndarray]:
        text = "\n".join(texts).lower()
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        starts, ends = self._words(text, codes)
        if not len(starts):
            return [np.zeros(0, dtype=self.dtype)] * len(texts)
        h = span_hashes((codes & 255).astype(np.uint8), starts, ends)
        if (codes > 255).any():
            h = mixed(h) + span_hashes((codes >> 8).astype(np.uint8), starts, ends)
        _, first, word = np.unique(h, return_index=True, return_inverse=True)
        own = [text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        ids = np.array(self.fast.encode_ordinary(self.MARK.join([*own, ""])), dtype=self.dtype)
        last = np.flatnonzero(self.ends[ids]) + 1
        begin = np.concatenate([[0], last[:-1]])
        n = (last - begin)[word]
        done = np.cumsum(n)
        out = ids[np.repeat(begin[word] - (done - n), n) + np.arange(done[-1])]
        limits = np.cumsum([len(t) + 1 for t in texts[:-1]])
        cuts = np.concatenate([[0], done])[np.searchsorted(starts, limits)]
        return np.split(out, cuts)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        plain = [self.fast is not None and self.is_plain(text) for text in texts]
        fast = iter(self._plain_ids([text for text, p in zip(texts, plain, strict=True) if p]) if any(plain) else ())
        return [next(fast) if p else np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=self.dtype)
                for text, p in zip(texts, plain, strict=True)]


@cache
def encoder(json_path: str) -> WordEncoder:
    """One a Python worker."""
    return WordEncoder(json_path)


def _encoded(encode: WordEncoder, values):
    """(row, ids) of each text, some texts at a time."""
    texts, held, first = [], 0, 0
    for i, value in enumerate(values):
        texts.append((value.as_py() or b"").decode(errors="replace"))
        held += len(texts[-1])
        if held >= TEXTS or i + 1 == len(values):
            yield from enumerate(encode(texts), first)
            texts, held, first = [], 0, i + 1


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenised(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
              json_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(id, row, doc_tokens, start, length, ids_crc32, ids): each document's full pieces and the rest.

    Only the rest has its ids, as it may be cut; row is a number of its own. A null text counts
    as empty, which has the end's id alone; bytes that are no UTF-8 count as U+FFFD.
    """
    path = json_path or vocabulary_path()
    text = column(text_col).cast("string").cast("binary")
    narrow = docs.select(column(id_col).alias(id_col), text.alias("text_"))

    def run(batches):
        encode, row = encoder(path), TaskContext.get().partitionId() << 40
        end = np.array([end_id], dtype=encode.dtype)
        for batch in batches:
            rows, held = [], 0

            def done(batch=batch):
                take, *columns = zip(*rows, strict=True)
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(take, pa.int64())), *(pa.array(x, pa.int64()) for x in columns[:-1]), pa.array(columns[-1], pa.binary())], names)

            for i, ids in _encoded(encode, batch.column(1)):
                ids = np.append(ids, end)
                n = len(ids)
                for at in range(0, n, length):
                    piece = ids[at : at + length]
                    whole = len(piece) == length
                    rows.append((i, row, n, at, len(piece), crc(piece) if whole else None, None if whole else piece.tobytes()))
                    row += 1
                    held += 0 if whole else piece.nbytes
                if held >= BATCH_BYTES or len(rows) >= 100_000:
                    yield done()
                    rows, held = [], 0
            if rows:
                yield done()

    fields = [narrow.schema[0], *(T.StructField(c, T.LongType()) for c in ("row", "doc_tokens", "start", "length", "ids_crc32")),
              T.StructField("ids", T.BinaryType())]
    names = [f.name for f in fields]
    return narrow.mapInArrow(run, T.StructType(fields))


class Sequences:
    """Sequences that hold `total` tokens to the last place; place() gives the pieces of the next document."""

    def __init__(self, total: int, length: int = LENGTH, break_even: int = BREAK_EVEN):
        rest = total % length
        rooms = [length] * (total // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        self.rooms, self.break_even = rooms, break_even
        self.used = [0] * len(rooms)
        self.none = 1 << 100
        # The sequences with so many free places, cheapest first, below a tree of minimums over places.
        self.by_room: list[list[int]] = [[] for _ in range(length + 1)]
        self.leaves = 1 << length.bit_length()
        self.tree = [self.none] * (2 * self.leaves)
        for number, room in enumerate(rooms):
            self.by_room[room].append(number)  # ascends, so it is a heap
        for room in set(rooms):
            self._changed(room)

    def _changed(self, room: int) -> None:
        at, tree = room + self.leaves, self.tree
        tree[at] = self.by_room[room][0] if self.by_room[room] else self.none
        at >>= 1
        while at:
            best = min(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                break
            tree[at] = best
            at >>= 1

    def _cheapest(self, least_room: int) -> int:
        """The cost (above 32 bits) and number of the cheapest sequence with so much room."""
        best, low, high, tree = self.none, least_room + self.leaves, 2 * self.leaves, self.tree
        while low < high:
            if low & 1:
                best = min(best, tree[low])
                low += 1
            if high & 1:
                high -= 1
                best = min(best, tree[high])
            low >>= 1
            high >>= 1
        return best

    def cost(self, n: int) -> int:
        """Linear and quadratic cost of a piece, times break_even."""
        return n * self.break_even + n * n

    def place(self, n: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, tokens) of each piece."""
        pieces = []
        while n:
            key = self._cheapest(n)
            if key == self.none:
                key = self._cheapest(1)
            number = key & 0xFFFFFFFF
            room, offset = self.rooms[number], self.used[number]
            size = min(n, room)
            heappop(self.by_room[room])
            self._changed(room)
            self.rooms[number] = room - size
            self.used[number] = offset + size
            if room > size:
                heappush(self.by_room[room - size], key + (self.cost(size) << 32))
                self._changed(room - size)
            pieces.append((number, offset, size))
            n -= size
        return pieces


def pack(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", json_path: str | None = None,
         end_id: int = END_ID, break_even: int = BREAK_EVEN, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost), a row per piece.

    Every sequence has `length` tokens or a power of two, and none is padded. length itself is a
    power of two. cost is a piece's own, in tokens of linear work. Null and empty texts have one
    id. Repeated rows, null ids included, are packed each. An empty table gives no rows. Other
    columns of docs are not returned.
    """
    scratch = Scratch(docs.sparkSession, "balanced")
    rows, _ = scratch.save(tokenised(docs, length, id_col, text_col, json_path, end_id), "tokens")
    buckets = -(-max(rows.count(), 1) // bucket)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name not in ("bucket", "row", "length")]
    totals = rows.groupBy("bucket").agg(F.sum("length").alias("row")).select("bucket", "row", F.lit(length + 1).cast("long").alias("length"), *blank)
    dealt = rows.unionByName(totals).repartition("bucket").sortWithinPartitions("bucket", F.desc("length"), "row")
    order = dealt.columns

    def run(batches):
        sequences = base = None
        for batch in batches:
            at = {c: batch.column(order.index(c)) for c in order}
            out = []
            narrow = zip(*(at[c].to_pylist() for c in ("bucket", "row", "length", "start", "doc_tokens", "ids_crc32")), strict=True)
            for i, (number, row, n, start, all_n, whole_crc) in enumerate(narrow):
                if n > length:
                    sequences, base = Sequences(row, length, break_even), number << 32
                    continue
                ids = None
                for sequence, offset, size in sequences.place(n):
                    if whole_crc is None:
                        if ids is None:
                            data = at["ids"][i].as_py()
                            ids, begin = np.frombuffer(data, dtype=f"<u{len(data) // n}"), 0
                        value, begin = crc(ids[begin : begin + size]), begin + size
                    else:
                        value = whole_crc
                    out.append((i, start, size, value, all_n, base + sequence, offset, sequences.cost(size) / break_even))
                    start += size
            if out:
                take, *columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [at[id_col].take(pa.array(take, pa.int64())), *(pa.array(x, pa.int64()) for x in columns[:-1]), pa.array(columns[-1], pa.float64())], names)

    fields = [dealt.schema[id_col], *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
              T.StructField("cost", T.DoubleType())]
    names = [f.name for f in fields]
    return dealt.mapInArrow(run, T.StructType(fields))
