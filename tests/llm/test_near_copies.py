"""SimHash and substring dedup against brute force, and on edge cases."""

import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).parent))
from edge import LONG, SCHEMA, by_id, clashing, edge_docs  # noqa: E402

from tablesync.llm import passages, simhash  # noqa: E402
from tablesync.llm.common import Scratch, components  # noqa: E402
from tablesync.llm.queries import QUERIES  # noqa: E402


def print_of(text):
    """The fingerprint, bit by bit."""
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def grouped(links, nodes):
    """Smallest node of each node's component, by repeated search."""
    out = {}
    for start in sorted(nodes):
        todo = [start]
        while todo:
            node = todo.pop()
            if node not in out:
                out[node] = start
                todo += links.get(node, ())
    return out


def test_simhash_query_against_brute_force(spark, sf_dir):
    docs = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    prints = {i: print_of(t) for i, t in docs.items()}
    links = {i: [j for j in docs if (prints[i] ^ prints[j]).bit_count() <= 3] for i in docs}
    component = grouped(links, docs)
    rows = QUERIES["op6_simhash_near_dedup"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}"
        assert r["component_id"] == component[r["doc_id"]]


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 5])
def test_links_of_prints(spark, max_bits):
    rng = np.random.default_rng(max_bits)
    base = [int(x) for x in rng.integers(0, 1 << 62, 12)]
    prints = {b ^ sum(1 << int(k) for k in rng.choice(62, n, replace=False)) for b in base for n in range(7) for _ in range(6)}
    expected = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= max_bits}
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    found = {(min(r), max(r)) for r in simhash.linked_prints(df, max_bits).collect()}
    assert found == expected


def test_simhash_edges(spark):
    docs = clashing(edge_docs(spark))
    found = simhash.near_duplicates(docs)
    rows = {r["doc_id"]: r for r in found.collect() if r["doc_id"] is not None}
    assert found.count() == docs.count()
    assert {rows[i]["fingerprint"] for i in (1, 2, 3)} == {"0" * 16} and {rows[i]["component_id"] for i in (1, 2, 3)} == {1}
    assert rows[5]["component_id"] == rows[7]["component_id"] == 5 and rows[6]["component_id"] == rows[8]["component_id"] == 6
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert by_id(kept, "doc_id") == by_id(spark.createDataFrame([(1,), (4,), (5,), (6,), (9,), (None,)], "doc_id long"), "doc_id")
    assert simhash.near_duplicates(docs.limit(0)).collect() == [] == simhash.keep_one(docs.limit(0)).collect()


def test_components_of_awkward_shapes(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 40)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (5, 4), (2000, 2001), (2000, 2001)], "a long, b long")
    found = dict(components(edges, Scratch(spark, "test")).collect())
    assert found == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(40)}, 2000: 2000, 2001: 2000}
    assert components(edges.limit(0), Scratch(spark, "test")).collect() == []


def windows(words, n=50):
    return {tuple(words[i : i + n]): i for i in range(len(words) - n + 1)}


def test_passages_cover_all_exact_repeats(spark, sf_dir):
    docs = {i: (t or "").lower().split() for i, t in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    covered = {i: set() for i in docs}
    for r in QUERIES["op7_substring_dedup"](spark, sf_dir).collect():
        assert r["home_id"] < r["doc_id"] and r["end"] - r["start"] >= 50
        assert r["agree"] >= 0.8 * max(r["end"] - r["start"], r["home_end"] - r["home_start"])
        a, b = docs[r["doc_id"]][r["start"] : r["end"]], docs[r["home_id"]][r["home_start"] : r["home_end"]]
        assert len(set(a) & set(b)) >= 0.5 * len(set(a))
        covered[r["doc_id"]] |= set(range(r["start"], r["end"]))
    first, missed, n = {}, 0, 0
    for i in sorted(docs):
        for w, at in windows(docs[i]).items():
            if first.setdefault(w, i) < i:
                n += 1
                missed += not covered[i] >= set(range(at, at + 50))
    assert n > 100 and missed <= 0.005 * n


def text_of(rng, n, words=5000):
    return [f"w{rng.integers(words)}" for _ in range(n)]


def test_planted_passages(spark):
    rng = np.random.default_rng(5)
    shared, clean = text_of(rng, 60), [text_of(rng, 200) for _ in range(30)]
    fuzzy = [*shared[:25], "new", *shared[26:40], *shared[42:]]
    docs = [(i, " ".join(w)) for i, w in enumerate(clean)]
    docs += [(100 + i, " ".join([*text_of(rng, 40), *shared, *text_of(rng, 30)])) for i in range(5)]
    docs += [(200, " ".join([*text_of(rng, 25), *fuzzy])), (201, " ".join(shared[:40])), (202, " ".join(["same"] * 400)), (203, " ".join(["a b"] * 300))]
    rows = passages.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in rows} == {101, 102, 103, 104, 200}
    for r in rows:
        assert (r["home_id"], r["home_start"], r["home_end"]) == (100, 40, 100)
        assert (r["start"], r["end"], r["agree"]) == ((25, 83, 57) if r["doc_id"] == 200 else (40, 100, 60))


def test_passage_edges(spark):
    docs = clashing(edge_docs(spark))
    found = passages.shared_passages(docs)
    assert [(r["doc_id"], r["home_id"], r["start"], r["end"], r["agree"]) for r in found.collect()] == [(8, 6, 0, 60_000, 60_000)]
    cut = passages.cut_passages(docs, found, length_col="n_chars")
    assert cut.columns == docs.columns and cut.count() == docs.count()
    texts = by_id(cut.where("doc_id <> 8"), "doc_id", "text")
    assert texts == by_id(docs.where("doc_id <> 8"), "doc_id", "text")
    assert [tuple(r) for r in cut.where("doc_id = 8").select("text", "n_chars").collect()] == [("", 0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert passages.shared_passages(empty).collect() == [] == passages.cut_passages(empty, passages.shared_passages(empty)).collect()
    assert len(LONG.split()) == 60_000


def test_cutting_keeps_the_rest():
    text = "  a b  c\nd e f\n"
    assert passages.without_spans(text, [1, 2], [3, 4]) == "  a e f\n"
    assert passages.without_spans(text, [0], [6]) == "\n"
    assert passages.without_spans(text, [4], [99]) == "  a b  c\nd\n"


def covered_words(rows, doc):
    return {k for r in rows if r["doc_id"] == doc for k in range(r["start"], r["end"])}


def test_passages_that_repeat_themselves(spark):
    rng = np.random.default_rng(6)
    line = text_of(rng, 20)
    periodic = [["same"] * 400, ["a", "b"] * 300, ["one", "short", "line", "again"] * 60, line * 20]
    docs = [(10 * i + j, " ".join([*text_of(rng, 30 + 7 * j), *p, *text_of(rng, 30)])) for i, p in enumerate(periodic, 1) for j in (0, 1, 2)]
    rows = passages.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    for i, p in enumerate(periodic, 1):
        for j in (1, 2):
            assert covered_words(rows, 10 * i + j) >= set(range(30 + 7 * j, 30 + 7 * j + len(p)))
    assert {r["doc_id"] for r in rows} == {10 * i + j for i in range(1, 5) for j in (1, 2)}


def test_partner_follows_from_the_passage(spark):
    rng = np.random.default_rng(7)
    shared = text_of(rng, 60)
    around = lambda w: " ".join([*text_of(rng, 40), *w, *text_of(rng, 30)])
    docs = [(1, around(shared[17:42])), (2, around(shared[:20])), (100, around(shared)), (200, around(shared)), (300, around(shared[:50]))]
    rows = passages.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["home_id"], r["start"], r["end"], r["agree"]) for r in rows) == [
        (200, 100, 40, 100, 60), (300, 100, 40, 90, 50)]


def test_passages_miss_no_exact_repeat(spark, sf_dir):
    docs = {i: (t or "").lower().split() for i, t in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rng = np.random.default_rng(8)
    phrases = [text_of(rng, 30) for _ in range(40)]
    docs |= {10**6 + i: [w for j in rng.integers(40, size=12) for w in phrases[j]] for i in range(60)}
    covered = {i: set() for i in docs}
    for r in passages.shared_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")).collect():
        covered[r["doc_id"]] |= set(range(r["start"], r["end"]))
    first, n = {}, 0
    for i in sorted(docs):
        for at in range(len(docs[i]) - 49):
            if first.setdefault(tuple(docs[i][at : at + 50]), i) < i:
                n += 1
                assert covered[i] >= set(range(at, at + 50))
    assert n > 1000


def changed(rng, words, share, how):
    n, out = int(share * len(words)), list(words)
    for i in np.arange(n) * len(words) // n + 2 if how == "even" else rng.choice(len(words), n, replace=False):
        out[i] = f"new{rng.integers(10**9)}"
    return out


def test_texts_that_share_an_id_lose_nothing_of_their_own(spark):
    shared, other = (" ".join(f"{c}{i}" for i in range(70)) for c in "ab")
    docs = spark.createDataFrame([(1, shared), (2, shared + " tail"), (2, "z " + other), (2, None), (None, shared)], "doc_id long, text string")
    cut = passages.cut_passages(docs, passages.shared_passages(docs)).collect()
    assert sorted(map(str, (r["text"] for r in cut))) == sorted(map(str, [shared, " tail", "z " + other, None, shared]))


def test_every_text_of_a_shared_id_is_searched(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(70)) for x in "abc")
    rows = [(1, a), (2, b), (3, "x " + a), (3, "y " + b), (3, "y " + b), (3, c), (4, c), (4, a), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = passages.shared_passages(docs)
    assert sorted((r["doc_id"], r["home_id"], r["start"], r["end"]) for r in found.collect()) == [
        (3, 1, 1, 71), (3, 2, 1, 71), (4, 1, 0, 70), (4, 3, 0, 70)]
    cut = sorted((r["doc_id"], str(r["text"])) for r in passages.cut_passages(docs, found).collect())
    assert cut == sorted([(1, a), (2, b), (3, "x"), (3, "y"), (3, "y"), (3, c), (4, ""), (4, ""), (4, "None")])


def test_equal_texts_are_one_passage(spark):
    long, short = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("l", 90), ("s", 49)))
    rows = [(i, long if i % 2 else short) for i in range(10, 40)]
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["home_id"], r["start"], r["end"], r["agree"]) for r in found) == [
        (i, 11, 0, 90, 90) for i in range(13, 40, 2)]


def test_fuzzy_passages_are_found(spark):
    rng = np.random.default_rng(9)
    docs, kinds = [], {}
    for kind in [(n, share, how) for n in (60, 120, 200) for share in (0.1, 0.15, 0.19) for how in ("even", "random")]:
        for _ in range(20):
            shared, i = text_of(rng, kind[0], 50_000), len(docs)
            kinds[i + 1] = kind
            docs += [(i, " ".join([*text_of(rng, 40, 50_000), *shared])), (i + 1, " ".join([*text_of(rng, 30, 50_000), *changed(rng, shared, *kind[1:])]))]
    rows = passages.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = {r["doc_id"] for r in rows if r["home_id"] == r["doc_id"] - 1}
    for kind in set(kinds.values()):
        share = np.mean([i in found for i in kinds if kinds[i] == kind])
        assert share >= (0.9 if kind[0] > 60 or kind[1] < 0.15 else 0.6), kind


@pytest.mark.parametrize("inserted", [10, 13, 15, 20])
def test_passages_go_on_over_inserted_words(spark, inserted):
    rng = np.random.default_rng(inserted)
    docs = []
    for i in range(0, 20, 2):
        shared = text_of(rng, 80, 50_000)
        docs += [(i, " ".join(shared)), (i + 1, " ".join([*shared[:40], *text_of(rng, inserted, 50_000), *shared[40:]]))]
    rows = passages.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["start"], r["end"], r["agree"]) for r in rows) == [(i, 0, 80 + inserted, 80) for i in range(1, 20, 2)]


def test_passages_whose_seeds_smaller_ids_hold(spark):
    rng = np.random.default_rng(20)
    around = lambda *w: " ".join([*text_of(rng, 30, 50_000), *w, *text_of(rng, 9, 50_000)])
    shared = text_of(rng, 60, 50_000)
    changed_ = [f"new{i}" if i % 12 == 7 else w for i, w in enumerate(shared)]
    docs = [(i, around(*shared[6 * i : 6 * i + 8])) for i in range(10)] + [(100, around(*shared)), (200, around(*changed_))]
    rows = passages.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["home_id"], r["start"], r["end"], r["agree"]) for r in rows] == [(200, 100, 30, 90, 55)]


def test_passages_of_lines_that_very_many_documents_have(spark):
    rng = np.random.default_rng(21)
    around = lambda *w: " ".join([*text_of(rng, 30, 50_000), *w, *text_of(rng, 9, 50_000)])
    lines = [text_of(rng, 12, 50_000) for _ in range(8)]
    many = passages.RARE + 6
    docs = [(many * j + i, around(*line)) for j, line in enumerate(lines) for i in range(many)]
    docs += [(i, around(*(w for j, line in enumerate(lines) for w in [*line, f"new{i}-{j}"]))) for i in (1000, 2000)]
    rows = passages.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["home_id"], r["start"], r["end"], r["agree"]) for r in rows] == [(2000, 1000, 30, 133, 96)]


def test_a_stretch_has_no_row_for_each_that_has_it(spark):
    rng = np.random.default_rng(22)
    around = lambda *w: " ".join([*text_of(rng, 30, 50_000), *w, *text_of(rng, 9, 50_000)])
    shared = text_of(rng, 60, 50_000)
    docs = [(i, around(*shared[6 * i : 6 * i + 8])) for i in range(10)]
    docs += [(100 + k, around(*(f"new{k}-{i}" if i % 12 == 7 and k else w for i, w in enumerate(shared)))) for k in range(12)]
    rows = passages.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["start"], r["end"]) for r in rows) == [(100 + k, 30, 90) for k in range(1, 12)]


def test_widest_stretches(spark):
    rows = [(1, 1, 0, 60), (1, 2, 0, 60), (1, 3, 5, 60), (1, 4, 5, 70), (1, 5, 80, 140), (2, 1, 10, 60), (2, 1, 0, 60)]
    df = spark.createDataFrame(rows, "doc long, home long, start int, end int")
    kept = df.withColumn("widest", passages._widest(df, "start", "end")).where("widest").collect()
    assert sorted(tuple(r)[:4] for r in kept) == [(1, 1, 0, 60), (1, 4, 5, 70), (1, 5, 80, 140), (2, 1, 0, 60)]


@pytest.mark.parametrize("size", [1, 2, 3, 50])
def test_places_without_an_open_one_are_left_out(size):
    h = np.repeat(np.arange(9), [1, 2, 3, 1, 5, 2, 1, 4, 6])
    is_open = np.isin(np.arange(len(h)), np.flatnonzero(np.diff(h, prepend=-1))) & np.isin(h, [0, 2, 4, 7])
    batch = pa.RecordBatch.from_arrays([pa.array(h), pa.array(is_open)], ["h", "open"])
    kept = [x for b in passages._opened(batch.slice(i, size) for i in range(0, len(h), size)) for x in b.column("h").to_pylist()]
    assert kept == [x for x in h.tolist() if x in (0, 2, 4, 7)]


def test_places_are_open_beyond_what_is_covered(spark):
    found = [(1, at, 100 + at, at in (10, 30)) for at in (10, 20, 30, 200)] + [(2, at, 100 + at, True) for at in (10, 20, 30)]
    rows = passages._place_rows(spark.createDataFrame(found, "doc long, at int, h long, common boolean"),
                                spark.createDataFrame([(1, 5, 31), (1, 0, 29), (2, 0, 90)], "doc long, start int, end int")).collect()
    assert sorted((r["doc"], r["at"], r["gap"], r["nth"], r["open"]) for r in rows) == [
        (1, 10, 10, 0, False), (1, 10, 20, 0, True), (1, 20, 0, 0, True), (1, 20, 10, 0, True), (1, 200, 0, 0, True), (2, 10, 20, 0, False)]


def test_align_splits_only_where_the_rule_fails():
    rng = np.random.default_rng(10)
    parts = [rng.integers(1 << 32, size=n, dtype=np.uint32) for n in (100, 120)]
    for gap, spans in ((60, [(0, 100), (160, 280)]), (40, [(0, 260)])):
        doc = np.concatenate([parts[0], rng.integers(1 << 32, size=gap, dtype=np.uint32), parts[1]])
        at = np.array([5, 50, 90, 105 + gap, 150 + gap])
        found = passages.align(doc, np.concatenate(parts), at, np.where(at > 100, at - gap, at))
        assert [(s, e) for s, e, *_ in found] == spans


def test_ascending_matches_chain_as_others_do(monkeypatch):
    rng, n = np.random.default_rng(11), 0
    for _ in range(300):
        at, home_at = (np.cumsum(rng.choice([1, 2, 5, 30, 60, 90], size=rng.integers(8, 60))) for _ in range(2))
        at, home_at = (x[: min(len(at), len(home_at))] for x in (at, home_at))
        monkeypatch.setattr(passages, "FEW", 0)
        quick = sorted(x.tolist() for x in passages.chain(at, home_at))
        monkeypatch.setattr(passages, "FEW", 1 << 30)
        assert sorted(x.tolist() for x in passages.chain(at, home_at)) == quick
        n += len(quick) > 1
    assert n > 100


def test_bound_before_alignment_loses_no_passage(monkeypatch):
    rng = np.random.default_rng(11)
    most, none, some = passages._most, 0, 0
    for i in range(400):
        home = rng.integers(40, size=160, dtype=np.uint32) if i % 2 else rng.integers(1 << 32, size=160, dtype=np.uint32)
        doc = np.where(rng.random(160) < rng.choice([0.1, 0.2, 0.25, 0.5]), rng.integers(1 << 32, size=160, dtype=np.uint32), home)
        doc = np.concatenate([rng.integers(1 << 32, size=rng.integers(30), dtype=np.uint32), np.delete(doc, rng.integers(160, size=rng.integers(8)))])
        doc, home = doc[: rng.integers(50, 140)], home[rng.integers(20) :]
        pairs = [(a, b) for a in range(len(doc) - 2) for b in range(len(home) - 2) if (doc[a : a + 3] == home[b : b + 3]).all()]
        if not pairs:
            continue
        at, home_at = np.array(sorted(pairs)).T
        for links in passages.chain(at, home_at):
            links = np.sort(rng.choice(links, min(len(links), rng.integers(2, 9)), replace=False))
            monkeypatch.setattr(passages, "_most", lambda *a: 1 << 30)
            whole = passages.align(doc, home, at[links], home_at[links])
            monkeypatch.setattr(passages, "_most", most)
            assert passages.align(doc, home, at[links], home_at[links]) == whole
            bound = most(doc, home, at[links], home_at[links], passages.K)
            assert all(bound >= agree for *_, agree in whole)
            some, none = some + bool(whole), none + (bound < 40)
    assert some > 100 and none > 100


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_rows_without_a_partner_are_left_out(size):
    docs, homes = [1, 1, 1, 2, 2, 3, 4, 4, 4, 4, 5], [0, 0, 1, 1, 1, 1, 2, 3, 3, 3, 3]
    table = pa.table({"doc": docs, "home": homes, "at": list(range(11))})
    left = [x for b in passages._recurring(table.to_batches(max_chunksize=size), ["doc", "home"]) for x in b.column("at").to_pylist()]
    assert left == [0, 1, 3, 4, 7, 8, 9]
    assert list(passages._recurring([], ["doc"])) == []


def test_groups_chain_at_once_as_one_by_one():
    rng, rows = np.random.default_rng(12), []
    for doc in range(400):
        size = rng.integers(2, 14)
        at = np.cumsum(rng.choice([0, 1, 3, 20, 60, 70, 90, 400], size=size))
        home_at = np.cumsum(rng.choice([1, 3, 20, 60, 70, 90], size=size))
        rows += [(doc, doc % 3, int(a), int(b)) for a, b in zip(at, home_at if doc % 4 else rng.permutation(home_at), strict=True)]
    rows = np.array(sorted(set(rows)))
    found = [tuple(r.values()) for b in passages._chained(rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3]) for r in b.to_pylist()]
    alone = []
    for doc in range(400):
        _, home, at, home_at = rows[rows[:, 0] == doc].T
        for links in passages.chain(at, home_at):
            for s in passages._split(at[links], home_at[links]):
                a, b = at[links][s], home_at[links][s]
                alone.append((doc, home[0], a[0], b[0], a[-1], b[-1], np.stack([a, b]).astype("<i4").tobytes()))
    assert sorted(found) == sorted(alone) and len(alone) > 400


def test_only_chains_that_may_be_passages_are_sent_to_alignment(spark):
    rng = np.random.default_rng(13)
    docs, found = {}, []
    for i in range(0, 240, 2):
        home = text_of(rng, int(rng.integers(150, 2600)), 50_000)
        first, n = int(rng.integers(len(home) - 100)), int(rng.choice([6, 12, 45, 60, 90]))
        doc = [*text_of(rng, int(rng.integers(1100)), 50_000), *changed(rng, home[first : first + n], 0.1, "random"), *text_of(rng, 70, 50_000)]
        docs[i], docs[i + 1] = home, doc
        seen = {tuple(home[b : b + 3]): b for b in range(len(home) - 2)}
        met = [(a, seen[tuple(doc[a : a + 3])]) for a in range(len(doc) - 2) if tuple(doc[a : a + 3]) in seen]
        met = met[:: int(rng.integers(1, 9))]
        if len(met) > 1:
            at, home_at = np.array(met).T
            found.append((i + 1, i, *(int(x) for x in (at[0], home_at[0], at[-1], home_at[-1])), np.stack([at, home_at]).astype("<i4").tobytes()))
    texts = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc long, text string")
    chains = spark.createDataFrame(found, passages.CHAIN)
    sent = passages.promising(texts, chains, 40)
    whole, left = (sorted(map(tuple, passages._aligned(texts, x, 50, 0.8).collect())) for x in (chains, sent))
    short = sum(len(r[6]) <= 8 * passages.FEW and r[4] - r[2] < 20 for r in found)
    assert left == whole and len(whole) > 20
    assert short > 10 and sent.count() <= len(found) - short


def test_saved_tables_leave_no_shuffle_files(spark, tmp_path):
    import time

    from tablesync.llm.common import Scratch

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    made = lambda: {b.name() for b in (lambda x: [x.apply(i) for i in range(x.size())])(disk.getAllBlocks().toSeq()) if b.isShuffle()}
    before, scratch = made(), Scratch(spark, "test")
    saved, path = scratch.save(spark.range(1000).repartition("id"), "rows")
    until = time.time() + 20
    while (left := made() - before) and time.time() < until:
        time.sleep(0.1)
    assert not left and saved.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    scratch.drop(path)


def test_exact_passages_hash_each_text_once(spark, monkeypatch):
    words = [" ".join(f"w{(i * 7 + j) % 211}" for j in range(90)) for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(words)), "doc long, text string")
    read = {name: spark.sparkContext.accumulator(0) for name in ("_least_rows", "_window_rows")}
    for name, seen in read.items():
        def counted(docs, *sizes, hashes=getattr(passages, name), seen=seen):
            def count(batches):
                for batch in batches:
                    seen.add(batch.num_rows)
                    yield batch

            return hashes(docs.select("doc", "text", *docs.columns[2:]).mapInArrow(count, docs.schema), *sizes)

        monkeypatch.setattr(passages, name, counted)
    found = passages.exact_passages(docs, Scratch(spark, "once"))
    assert {(r["doc"], r["home"]) for r in found.collect()} >= {(1, 0), (2, 1)}
    assert {name: seen.value for name, seen in read.items()} == {"_least_rows": 6, "_window_rows": 6}


def test_both_matches_of_a_pair_are_one_row(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(rng.integers(10, 14)), int(rng.integers(0, 4)), *(int(x) for x in rng.integers(0, 400, 2)), *(int(x) for x in rng.integers(1, 60, 2)))
             for _ in range(400)]
    pairs.append((99, 98, 5, 6, 20, 20))  # the only row of its documents
    single = [(99, 1, 5, 6), *((10, 3, i, i) for i in range(0, 40, 4))]
    apart = [(d, h, *x) for d, h, a, b, gap, home_gap in pairs for x in ((a, b), (a + gap, b + home_gap))]
    together = [(d, h, gap << 32 | a, home_gap << 32 | b) for d, h, a, b, gap, home_gap in pairs]
    whole, packed = (sorted(map(tuple, passages.chains(spark.createDataFrame(x + single, "doc long, home long, at long, home_at long")).collect()))
                     for x in (apart, together))
    assert whole == packed and {(r[0], r[1]) for r in packed} >= {(99, 98), (10, 3)} and 99 not in {r[0] for r in packed if r[1] == 1}


def test_words_of_chains_are_found_without_sending_texts(spark):
    text = " ".join(f"w{i}" for i in range(300))
    texts = spark.createDataFrame([(1, text), (2, f"x {text}"), (3, "other " * 60)], "doc long, text string")
    anchors = np.array([[11, 21, 31], [10, 20, 30]], dtype="<i4").tobytes()
    found = spark.createDataFrame([(2, 1, 11, 10, 31, 30, bytearray(anchors))], passages.CHAIN)
    for bounded in ({}, {"bounded": True}):
        aligned = passages._aligned(texts, found, 50, 0.8, **bounded)
        assert [tuple(r) for r in aligned.collect()] == [(2, 1, 1, 98, 0, 97, 97)]
        assert ("LeftSemi" in aligned._jdf.queryExecution().optimizedPlan().toString()) == bool(bounded)
