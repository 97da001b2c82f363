"""Grouping spelling variants: words one edit apart, by an index of variable-length grams.

1. Dictionary. Grams begin at two characters. One that occurs at more than one in MOST places of
   all words is frequent and gives way to its longer ones, up to LONGEST characters; so no list
   of a common gram stands where a longer one can. The dictionary is the frequent grams, of which
   there are at most MOST of each length, whatever the number of words.
2. Decomposition. From each place of a word the shortest gram that is not frequent is taken,
   unless the one before it covers it. Whether a gram ends follows from its own characters alone.
3. Affected grams. For each place of an edit, a word's bounds are the last gram that ends before
   it and the first one after it that no gram reaching the edit can cover. All grams outside
   these bounds are on the partner's lists too, counted from the start on the left and from the
   end on the right, because nothing they depend on has changed. Merging those lists is one
   equi-join on a digest of the grams outside: a candidate shares all of them, not merely one,
   so a common gram brings no pairs by itself. Words above 64 characters take places in blocks,
   at most 33 of them; grams are short enough beside the word that some always lie outside.
4. Verification. A candidate is near if the edit distance is 1.

Words meet those of their own length (a replaced character) and of one more (an inserted or
deleted one), each under digests of its own. A word's variants are at most as many as its edits,
so results grow with the words. Lists of a digest are joined by Spark, which can split them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Scratch, column

SHORTEST, LONGEST = 2, 5  # characters of a gram
MOST = 8192
BLOCKS = 32
END = "\x00"  # stands after each word, so that a gram at its end has an end of its own
REPLACED, SHORT, LONG = range(3)
RUNS = "[A-Za-zÀ-ÿ]+"
TEXTS = 1 << 22  # bytes of text whose words are counted at once


def word_counts(docs: DataFrame, min_length: int = 7, least: int = 2, id_col: str = "doc_id", text_col: str = "text",
                pattern: str = RUNS, damage_one_in: int | None = None) -> DataFrame:
    """(word, n): the runs of `pattern` in whole texts, A-Z lower-cased, of min_length characters, that occur `least` times.

    damage_one_in k: a run loses the character at h % length if k divides h, the unsigned crc32 of
    `<id>:<run>` in UTF-8 (a null id is written as nothing). Null texts have no words; bytes that
    are no UTF-8 count as U+FFFD. Repeated rows count each. An empty table gives no rows.
    """
    text = column(text_col).cast("string").cast("binary")
    narrow = docs.select(column(id_col).cast("string").alias("id"), text.alias("text"))

    def run(batches):
        find = re.compile(pattern).findall
        for batch in batches:
            counts, held = Counter(), 0
            for number, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = value.as_py() or b""
                own = Counter(w for w in find(data.translate(LOWER).decode(errors="replace")) if len(w) >= min_length)
                held += len(data)
                if damage_one_in:
                    own = _damaged(own, zlib.crc32(f"{'' if number is None else number}:".encode()), damage_one_in, min_length)
                counts.update(own)
                if held >= TEXTS:
                    yield _counted(counts)
                    counts, held = Counter(), 0
            yield _counted(counts)

    return narrow.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _damaged(words: Counter, begun: int, one_in: int, min_length: int) -> Counter:
    out = Counter()
    for word, n in words.items():
        h = zlib.crc32(word.encode(), begun)
        if h % one_in == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < min_length:
                continue
        out[word] += n
    return out


def _counted(counts: Counter, name: str = "word") -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], [name, "n"])


def frequent_grams(words: DataFrame, most: int = MOST, longest: int = LONGEST) -> set[str]:
    """The grams shorter than `longest` that occur at more than one in `most` places of all words.

    Length by length: a gram is counted only if what it begins with is frequent.
    """
    places = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    found: set[str] = set()
    begins: set[str] | None = None
    for size in range(SHORTEST, longest):
        counts = _grams(words, size, begins).groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > places // most)
        begins = {r["gram"] for r in counts.collect() if not r["gram"].endswith(END)}
        found |= begins
        if not begins:
            break
    return found


def _grams(words: DataFrame, size: int, begins: set[str] | None) -> DataFrame:
    """(gram, n): grams of one size that begin so, counted in parts."""

    def run(batches):
        for batch in batches:
            counts, held = Counter(), 0
            for word in batch.column(0).to_pylist():
                padded = word + END
                grams = [padded[p : p + size] for p in range(len(padded) - size + 1)]
                counts.update(grams if begins is None else [g for g in grams if g[:-1] in begins])
                held += len(padded)
                if held >= TEXTS:
                    yield _counted(counts, "gram")
                    counts, held = Counter(), 0
            yield _counted(counts, "gram")

    return words.select("word").mapInArrow(run, "gram string, n long")


def decompose(word: str, cap: int, frequent: set[str]) -> list[tuple[int, int]]:
    """First and last places of a word's grams, none of which covers another."""
    padded, spans, covered = word + END, [], -1
    for p in range(len(padded) - SHORTEST + 1):
        end, top = p + SHORTEST, min(p + cap, len(padded))
        while end < top and padded[p:end] in frequent:
            end += 1
        if end - 1 > covered:
            covered = end - 1
            spans.append((p, covered))
    return spans


def outside(word: str, kind: int, frequent: set[str], longest: int = LONGEST) -> set[tuple[int, int]]:
    """For each place of an edit, how far the grams before it reach and where those after it begin.

    The kinds are an edit that replaces a character, one that inserts into the shorter word of
    two, and the same seen from the longer word, where it deletes.
    """
    n = len(word)
    shared = n - (kind == LONG)  # the length of the shorter word decides what both do
    cap = max(SHORTEST, min(longest, shared // 2))
    spans = decompose(word, cap, frequent)
    places = n + (kind == SHORT)
    step, gap = max(1, shared // BLOCKS), int(kind != SHORT)
    found, left, right = set(), 0, 0
    for low in range(0, places, step):
        high = min(low + step, places) - 1
        while left < len(spans) and spans[left][1] < low:
            left += 1
        while right < len(spans) and (spans[right][0] < high + gap or spans[right][1] < high + gap + cap - 1):
            right += 1
        found.add((spans[left - 1][1] + 1 if left else 0, spans[right][0] if right < len(spans) else n))
    return found


def digests(word: str, kind: int, frequent: set[str], longest: int = LONGEST) -> list[tuple[int, int, int]]:
    """For each of a word's bounds: a digest of the grams outside, the characters they cover at the start, and at the end."""
    seed = 2 * (len(word) - (kind == LONG)) + (kind != REPLACED)
    return [(xxhash.xxh64_intdigest(f"{word[:a]}{END}{word[b:]}".encode(), seed), a, len(word) - b)
            for a, b in outside(word, kind, frequent, longest)]


LIST = ["digest", "word", "n", "head", "tail"]


def _lists(words: DataFrame, kind: int, frequent: set[str], longest: int, min_length: int) -> DataFrame:
    """(digest, word, n, head, tail), a row for each digest of a word."""

    def run(batches):
        for batch in batches:
            found, take, held = [], [], 0
            for i, word in enumerate(batch.column(0).to_pylist()):
                if kind != LONG or len(word) > min_length:
                    own = digests(word, kind, frequent, longest)
                    found += own
                    take += [i] * len(own)
                    held += len(word) * len(own)
                if held >= TEXTS:
                    yield listed(batch, found, take)
                    found, take, held = [], [], 0
            if found:
                yield listed(batch, found, take)

    def listed(batch, found, take):
        digest, head, tail = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(digest, dtype=np.uint64).view(np.int64)), *(batch.column(c).take(pa.array(take, pa.int64())) for c in (0, 1)),
             pa.array(head, pa.int32()), pa.array(tail, pa.int32())], LIST)

    return words.mapInArrow(run, "digest long, word string, n long, head int, tail int")


def _one_edit() -> Column:
    """Equal heads and tails don't change an edit distance: it is that of what lies between."""
    between = lambda word: F.substr(word, F.col("head") + 1, F.length(word) - F.col("head") - F.col("tail"))
    return ((F.col("head") == F.col("near_head")) & (F.col("tail") == F.col("near_tail"))
            & (F.left("word", F.col("head")) == F.left("near", F.col("head"))) & (F.right("word", F.col("tail")) == F.right("near", F.col("tail")))
            & (F.levenshtein(between(F.col("word")), between(F.col("near")), 1) == 1))


def near_pairs(words: DataFrame, scratch: Scratch, min_length: int = 1, longest: int = LONGEST, most: int = MOST) -> DataFrame:
    """(word, n, near, near_n), both ways, of words whose edit distance is 1."""
    frequent = frequent_grams(words, most, longest)
    lists = lambda kind: _lists(words, kind, frequent, longest, min_length)
    names = ["digest", "near", "near_n", "near_head", "near_tail"]
    replaced, _ = scratch.save(lists(REPLACED), "replaced")
    same = replaced.join(replaced.toDF(*names), "digest").where((F.col("word") < F.col("near")) & _one_edit())
    longer = lists(SHORT).join(lists(LONG).toDF(*names), "digest").where(_one_edit())
    pairs = same.union(longer).select("word", "n", "near", "near_n").distinct()
    back = [F.col(c).alias(a) for c, a in (("near", "word"), ("near_n", "n"), ("word", "near"), ("n", "near_n"))]
    return pairs.select(F.inline(F.array(F.struct(*pairs.columns), F.struct(*back))))


def group_variants(words: DataFrame, ratio: int = 10, min_length: int = 1, longest: int = LONGEST, most: int = MOST) -> DataFrame:
    """(word, form, root, n, n_near, form_n), a row for each of `words` (word, n).

    form is the near word of largest n (ties: the smallest in code-point order) if that is at
    least `ratio` times the word's n, else null. root is the last form that is reached from word
    to form, the word itself if it has none. Words are distinct and not null, ratio is above 1,
    and no word is shorter than min_length. An empty table gives no rows.
    """
    scratch = Scratch(words.sparkSession, "spelling")
    words, words_at = scratch.save(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_pairs(words, scratch, min_length, longest, most).groupBy("word", "n").agg(best.alias("best"), F.count("*").alias("n_near"))
    close = -F.col("best.less") >= ratio * F.col("n")
    near = near.select("word", "n_near", F.when(close, F.col("best.form")).alias("form"), F.when(close, -F.col("best.less")).alias("form_n"))
    near, _ = scratch.save(near, "near")

    # Each round doubles the steps that a root has gone; n grows tenfold with a step, so few are needed.
    roots, at = scratch.save(near.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.toDF("root", "next")
        moved, moved_at = scratch.save(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        scratch.drop(at)
        roots, at = moved.select("word", "root"), moved_at
        if moved.where("moved").isEmpty():
            break
    out = words.join(near, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
