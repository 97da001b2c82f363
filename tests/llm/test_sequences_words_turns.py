"""Cost-balanced packing, spelling variants and conversation repair against brute force, and on edge cases."""

import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from brute import damage, repaired  # noqa: E402
from edge import LONG, clashing, edge_docs  # noqa: E402

from tablesync.llm import balanced, repair, spelling  # noqa: E402
from tablesync.llm.queries import QUERIES  # noqa: E402

ODD = ["it's we'll they've 'sample don't I'd 'm 're''s !'s 'l 'r '", "a'", "'s", "", "  ", "x1y2 99,5 '' 'twas", "ÉTÉ ĀĒ ß ſ İ",
       "<|endoftext|> x", "naïve—test “q” ‘s ’s", "日本 x", "a\x01b", "'ve'", "d'd'd", "l'été 'd1 'll'", "😀".encode("utf-16", "surrogatepass").decode("utf-16")]


# Packing


@pytest.fixture(scope="module")
def encode():
    return balanced.encoder(balanced.vocabulary_path())


def exact(encode, text):
    return encode.exact.encode(text, add_special_tokens=False).ids


def test_words_have_the_tokenizers_ids(spark, sf_dir, encode):
    texts = ODD + [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert [x.tolist() for x in encode(texts)] == [exact(encode, t) for t in texts]
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyzéüß'.,-0123 \nÀŒ", k=rnd.randrange(1, 40))) for _ in range(3000)]
    assert [x.tolist() for x in encode(words)] == [exact(encode, t) for t in words]


def check_packed(rows, ids, id_col="doc_id", length=4096):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r[id_col], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[doc])
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[doc][r["start"] : at], dtype="<u4").tobytes())
        assert at == len(ids[doc])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == length or (at < length and at & (at - 1) == 0)  # never padded


def test_packing_query(spark, sf_dir, encode):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check_packed(QUERIES["op11_cost_balanced_packing"](spark, sf_dir).collect(), {i: [*exact(encode, t), 2] for i, t in docs.items()})


def test_packing_edges(spark, encode):
    docs = clashing(edge_docs(spark))
    rows = balanced.pack(docs, bucket=4).collect()
    texts = [r["text"] or "" for r in docs.collect()]
    assert sum(r["length"] for r in rows) == sum(len(exact(encode, t)) + 1 for t in texts)
    assert sorted(r["doc_tokens"] for r in rows if r["start"] == 0) == sorted(len(exact(encode, t)) + 1 for t in texts)
    one_each = docs.where("doc_id < 7").collect()
    rows = balanced.pack(docs.where("doc_id < 7")).collect()
    check_packed(rows, {r["doc_id"]: [*exact(encode, r["text"] or ""), 2] for r in one_each})
    assert balanced.pack(docs.limit(0)).collect() == []
    bad = spark.sql("SELECT 1 AS doc_id, cast(X'61FF62' AS string) AS text")
    check_packed(balanced.pack(bad).collect(), {1: [*exact(encode, "a�b"), 2]})


def test_cheapest_sequence_with_room():
    rnd = random.Random(1)
    for total in (1, 7, 64, 1000, 64 * 9 + 37):
        sizes = []
        while sum(sizes) < total:
            sizes.append(min(rnd.randrange(1, 65), total - sum(sizes)))
        own = balanced.Sequences(total, 64, 100)
        rooms, costs = list(own.rooms), [0] * len(own.rooms)
        assert sum(rooms) == total
        for n in sorted(sizes, reverse=True):
            want, size = [], n
            while size:
                fits = [i for i, r in enumerate(rooms) if r >= size] or [i for i, r in enumerate(rooms) if r]
                best = min(fits, key=lambda i: (costs[i], i))
                part = min(size, rooms[best])
                want.append((best, part))
                rooms[best] -= part
                costs[best] += 100 * part + part * part
                size -= part
            assert [(i, part) for i, _, part in own.place(n)] == want
        assert not any(rooms)


def test_costs_are_alike(spark, sf_dir):
    rows = balanced.pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    costs, sizes = Counter(), Counter()
    for r in rows:
        costs[r["sequence_id"]] += r["cost"]
        sizes[r["sequence_id"]] += r["length"]
    single = 4096 + 4096**2 / balanced.BREAK_EVEN
    full = [costs[s] for s in sizes if sizes[s] == 4096]
    assert max(full) <= single and np.std(full) < 0.12 * np.mean(full)


# Spelling


def counted(docs, one_in=31, least=2):
    counts = Counter()
    for i, text in docs:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if one_in and h % one_in == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += len(word) >= 7
    return {w: n for w, n in counts.items() if n >= least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants(counts, ratio=10):
    """(word, form, root, n, n_near, form_n) by comparing words that agree after losing a letter."""
    met = {}
    for w in counts:
        for x in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            met.setdefault(x, []).append(w)
    near = {w: set() for w in counts}
    for group in met.values():
        for a in group:
            near[a].update(b for b in group if a != b and one_edit(a, b))
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return out


def rows_of(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_spelling_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(QUERIES["op12_spelling_variants"](spark, sf_dir)) == variants(counted(docs))


@pytest.mark.parametrize("alphabet, lengths, most", [("ab", (1, 12), 8192), ("abé", (7, 9), 16), ("aab", (60, 75), 4), ("abcdefgh", (2, 8), 1)])
def test_no_variant_is_missed(spark, alphabet, lengths, most):
    rnd = random.Random(len(alphabet) + most)
    counts = {}
    for _ in range(300):
        word = "".join(rnd.choices(alphabet, k=rnd.randint(*lengths)))
        for _ in range(rnd.randrange(3)):  # and words one edit away
            counts[word] = rnd.choice([1, 2, 9, 20, 300, 5000])
            k = rnd.randrange(len(word) + 1)
            word = word[:k] + rnd.choice(["", *alphabet]) + word[k + rnd.randrange(2) :] or "a"
        counts[word] = rnd.choice([1, 2, 9, 20, 300, 5000])
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.group_variants(words, most=most)) == variants(counts)


def test_partners_share_what_lies_outside_the_bounds():
    rnd = random.Random(2)
    frequent = {"ab", "ba", "aba", "bab", "abab", "aa"}
    for _ in range(3000):
        word = "".join(rnd.choices("abc", k=rnd.randrange(2, 90)))
        k = rnd.randrange(len(word))
        other = word[:k] + "c" + word[k + 1 :]
        assert word == other or set(spelling.digests(word, spelling.REPLACED, frequent)) & set(spelling.digests(other, spelling.REPLACED, frequent))
        shorter = word[:k] + word[k + 1 :]
        assert set(spelling.digests(word, spelling.LONG, frequent)) & set(spelling.digests(shorter, spelling.SHORT, frequent))


def test_spelling_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    own = [(11, "Étrangers ÉTRANGERS étrangers", "fr", "s", 1), (11, "Étrangers ÉTRANGERS étrangers", "fr", "s", 1), (None, "x" * 2000, "en", "s", 1),
           (12, "x" * 2000, "en", "s", 1), (13, "x" * 1999 + " " + "x" * 1999, "en", "s", 1)]
    docs = clashing(edge_docs(spark)).unionByName(clashing(spark.createDataFrame(own, schema)))
    found = rows_of(spelling.group_variants(spelling.word_counts(docs), min_length=7))
    assert found == variants(counted([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], one_in=None))
    assert {"Étrangers".lower(), "Étrangers", "x" * 2000} <= {r[0] for r in found}
    assert rows_of(spelling.group_variants(spelling.word_counts(docs.limit(0)))) == set()
    longest = spark.createDataFrame([("x" * 50_000, 5), ("x" * 49_999, 50)], "word string, n long")
    assert {(len(r[0]), r[4]) for r in rows_of(spelling.group_variants(longest))} == {(50_000, 1), (49_999, 1)}


# Conversations


def test_repair_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by_conv = {r[0]: [] for r in rows}
    for r in damage(rows):
        by_conv[r[0]].append(r)
    got = {r["conv_id"]: tuple(r[c] for c in repair.AUDIT) for r in QUERIES["op13_conversation_repair"](spark, sf_dir).collect()}
    assert got == {conv: repaired(own) for conv, own in by_conv.items()}


def test_search_finds_the_least_of_the_cheapest():
    rnd = random.Random(4)
    for _ in range(300):
        rows = [(1, i, rnd.choice(["user", "assistant", "system", "tool", ""]), rnd.choice(["", "a.", f"{i}", f"{i}.", f"{i}!"])) for i in range(rnd.randrange(9))]
        kinds, seen = [], set()
        for _, _, role, text in rows:
            fault = repair.BLANK if not text else repair.DUPLICATE if (role, text) in seen else repair.CLEAN if text[-1] in ".!" else repair.TRUNCATED
            kinds.append(4 * max("?sua".find(role[:1] or "?"), 0) + fault)
            seen.add((role, text))
        cost, edits, end = repair.search(kinds, repair.NONE, repair.ENDING)
        want = repaired(rows)
        assert (cost + repair.ENDING[end], edits + "I" * (repair.ENDING[end] // 3)) == want[5:7]


def test_long_and_odd_conversations(spark):
    rnd = random.Random(3)
    rows = [(9, i // 2 if i % 7 else None, rnd.choice(["user", "assistant", "system", "tool", "", None]),
             rnd.choice(["Hi.", "ok", "", " ", "What?", None, "a\n", "b.\x0b"]) + str(i) * (i % 3) if i % 5 else rnd.choice(["Hi.", None])) if i % 11 else (9, None, None, None)
            for i in range(1)]
    rows += [(9, i // 2 if i % 7 else None, rnd.choice(["user", "assistant", "system", "tool", "", None]), rnd.choice([None, "", "Hi.", f"{i}.", f"{i}?\n ", f"{i}"])) for i in range(400)]
    rows += [(8, i, rnd.choice(["user", "assistant"]), f"{i}.") for i in range(300)]
    rows += [(6, 5, "user", "one. " * 30_000)] * 2 + [(6, 6, "assistant", "日本."), (7, None, None, None), (None, 1, "user", "a."), (None, 3, "assistant", "b.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "'x' AS conv", "'x' AS seq", "'x' AS kind", "'x' AS span")
    got = {r["conv"]: tuple(r[c] for c in repair.AUDIT) for r in repair.audits(repair.repair(df)).collect()}
    plain = [(a, b, " " if c is None else c, " " if d is None else d) for a, b, c, d in rows]
    assert got == {conv: repaired([r for r in plain if r[0] == conv]) for conv in {r[0] for r in rows}}
    assert repair.repair(df.limit(0)).collect() == [] and repair.audits(repair.repair(df.limit(0))).collect() == []


def test_edits_give_the_repaired_rows(spark):
    rows = [(1, 0, "assistant", "No question."), (1, 1, "user", "Why?"), (1, 2, "user", "So what?"), (1, 3, "assistant", "So")]
    edits = repair.repair(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).orderBy("seq", "nth").collect()
    kept = [(r["edit"], r["role"], r["text"]) for r in edits]
    assert "".join(e for e, _, _ in kept) == repaired(rows)[6]
    assert [r for e, r, _ in kept if e != "D"] == ["user", "assistant"] * (sum(e != "D" for e, _, _ in kept) // 2)
