"""Quality classifier: hashed word and character n-gram vectors, averaged, with a softmax.

Features of a text are its words, its word pairs, and the runs of 3 to 5 bytes inside each
word (a run may take in the blank on either side), each hashed into one of 2**BITS rows. The
model is a vector per row and one per class; a text's vector is the mean of its features' and
its class follows a softmax. A word that equals the one before it makes the same pair feature
whichever word it is. Numpy's stochastic gradient descent learns from a bounded sample, at most
TRAIN_ROWS rows of each class. A mean of vectors times the class vectors is the mean
of the products, so scoring looks up one number per feature and reads whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLANKS, as_bytes, column, free_name, mixed, span_hashes, word_bounds

BITS = 18
DIM = 8
GRAMS = (3, 4, 5)
TRAIN_ROWS = 1000  # of each class
STEPS = 10_000  # of gradient descent, one text each
RATE = 0.5
PIECE = 1 << 19  # bytes whose features are computed at once
TO_SPACE = bytes(32 if i in BLANKS else i for i in range(256))
SAME_PAIR = np.uint64(0x5A4D)
NO_LABELS = np.zeros(0, dtype=np.int32)


def _slots(h: np.ndarray) -> np.ndarray:
    return (mixed(h) >> np.uint64(64 - BITS)).astype(np.int32)


def _pieces(text: bytes):
    """Parts of a text that overlap by one word, so that each pair is in one of them."""
    at = 0
    while len(text) - at > PIECE:
        cut = text.rfind(b" ", at + 1, at + PIECE)
        if cut < 0:
            cut = text.find(b" ", at + PIECE)
        back = text.rfind(b" ", at + 1, cut) if cut > 0 else -1
        if back < 0:
            break
        yield text[at:cut], at > 0
        at = back
    yield text[at:], at > 0


def _features(text: bytes, repeat: bool) -> np.ndarray:
    """Slots of all features; with repeat, all but those of the first word alone."""
    data = np.frombuffer(b" " + text + b" ", dtype=np.uint8)
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.zeros(0, dtype=np.int32)
    words = span_hashes(data, starts, ends)
    pairs = words[:-1] * np.uint64(3) + words[1:] * np.uint64(7)
    pairs[words[:-1] == words[1:]] = SAME_PAIR
    found = [words[1:] if repeat else words, pairs]
    begin = starts[1] - 1 if repeat and len(starts) > 1 else len(data) if repeat else 0
    data = data[begin:]
    blanks = np.cumsum(np.concatenate([[0], data == 32]), dtype=np.int32)
    h = data.astype(np.uint64) + np.uint64(1)
    for n in range(2, max(GRAMS) + 1):
        if len(data) < n:
            break
        h = h[:-1] * np.uint64(0x100000001B3) + data[n - 1 :]
        if n in GRAMS:
            inside = blanks[n - 1 : len(data)] == blanks[1 : len(data) - n + 2]
            found.append(h[inside] + np.uint64(n << 56))
    return _slots(np.concatenate(found))


def features(text: bytes) -> list[np.ndarray]:
    """Slots of the features of a whole text, in parts of bounded size."""
    return [_features(piece, repeat) for piece, repeat in _pieces(text.translate(TO_SPACE))]


@dataclass(frozen=True)
class Model:
    """gain: what each slot adds to the log-odds of class 1, over the number of features."""

    gain: np.ndarray
    bias: float

    def score(self, text: bytes) -> float:
        total, n = 0.0, 0
        for slots in features(text):
            total += float(self.gain[slots].sum(dtype=np.float64))
            n += len(slots)
        return float(1.0 / (1.0 + np.exp(-np.clip(self.bias + (total / n if n else 0.0), -40, 40))))


def sample(labels: DataFrame, id_col: str, label_col: str, rows: int, learn_from: Column) -> DataFrame:
    """At most `rows` labelled ids of each class, those with the smallest hashes."""
    known = labels.select(column(id_col).alias("id"), column(label_col).alias("label")).where(learn_from)
    known = known.where("id is not null").distinct()
    order = F.xxhash64("id")
    return known.where("label = 0").orderBy(order, "id").limit(rows).union(
        known.where("label = 1").orderBy(order, "id").limit(rows))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", learn_from: Column | None = None, steps: int = STEPS, seed: int = 7) -> Model:
    """A model from at most `rows` rows of each class; learn_from may use columns id and label.

    The tasks turn texts into slots and counts, at most 2**BITS of each kind a row, and one of them
    learns from these; the model reaches the driver. Without labelled rows every text scores one half.
    """
    chosen = sample(labels, id_col, label_col, rows, F.lit(True) if learn_from is None else learn_from)
    texts = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    # At most 2 * rows ids: a side of proven size.
    texts = texts.join(F.broadcast(chosen), "id").select("id", F.col("label").cast("int").alias("label"), "text")

    def run(batches):
        for batch in batches:
            slots, counts = [], []
            for text in as_bytes(batch.column("text")):
                parts = features(text)
                slot, count = np.unique(np.concatenate(parts), return_counts=True)
                slots.append(slot)
                counts.append(count.astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("label"), pa.array(slots, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.float32()))], ["id", "label", "slots", "counts"])

    # One task learns from the sample, so that the driver, which stays busy for long, gets the model only.
    # Of equal ids and labels the slots fix the order, which a shuffle does not.
    found = texts.mapInArrow(run, "id string, label int, slots array<int>, counts array<float>")
    found = found.repartition(1).sortWithinPartitions("id", "label", "slots", "counts")

    def learn(batches):
        rows_, labels_ = [], []
        for batch in batches:
            labels_.append(batch.column("label").to_numpy())
            rows_ += zip(_lists(batch.column("slots")), _lists(batch.column("counts")), strict=True)
        model = fit(rows_, np.concatenate(labels_ or [np.zeros(0, np.int32)]), steps, seed)
        yield pa.RecordBatch.from_arrays([pa.array([model.gain.tobytes()], pa.binary()), pa.array([model.bias], pa.float64())], ["gain", "bias"])

    learnt = found.mapInArrow(learn, "gain binary, bias double").first()
    if learnt is None:  # Spark may leave out a task without rows
        return fit([], NO_LABELS, steps, seed)
    return Model(np.frombuffer(learnt["gain"], dtype=np.float32), learnt["bias"])


def _lists(lists: pa.ListArray) -> list[np.ndarray]:
    values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = STEPS, seed: int = 7) -> Model:
    """Stochastic gradient descent, one text at a time, with a falling rate; classes weigh alike."""
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((1 << BITS, DIM), dtype=np.float32) - 0.5) / DIM).astype(np.float32)
    classes, bias = np.zeros((2, DIM), dtype=np.float32), np.zeros(2, dtype=np.float32)
    n_class = np.bincount(labels, minlength=2)[:2]
    weight = len(labels) / 2 / np.maximum(n_class, 1)
    epochs = -(-steps // len(rows)) if len(rows) else 0
    for epoch in range(epochs):
        for k, i in enumerate(rng.permutation(len(rows))):
            slots, counts = rows[i]
            done = (epoch * len(rows) + k) / (epochs * len(rows))
            rate, label = RATE * (1 - done) * weight[labels[i]], labels[i]
            share = (counts / counts.sum())[:, None] if len(slots) else np.zeros((0, 1), np.float32)
            mean = (vectors[slots] * share).sum(axis=0)
            logits = classes @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1.0  # now the loss's slope along the logits
            slope = p @ classes
            classes -= (rate * p[:, None] * mean).astype(np.float32)
            bias -= (0.1 * rate * p).astype(np.float32)
            vectors[slots] -= (rate * len(slots) ** 0.5 * share * slope).astype(np.float32)
    return Model((vectors @ (classes[1] - classes[0])).astype(np.float32), float(bias[1] - bias[0]))


def with_score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with a column more, the probability of class 1. Null and blank texts get the prior's.

    out must not be a column of docs.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.gain, model.bias))  # 2**BITS numbers

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            scores = pa.array([own.score(t) for t in as_bytes(batch.column(at))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, out])

    at = docs.columns.index(text_col)
    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(out, T.DoubleType())]))


def accepted(docs: DataFrame, model: Model, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of docs, whole, whose text scores at least `least`."""
    score = free_name(docs, "score")
    return with_score(docs, model, text_col, score).where(F.col(score) >= least).drop(score)
