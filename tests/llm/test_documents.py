"""Sketches, quality scores, packing and mixing against brute force, and on edge cases."""

import hashlib
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from edge import LONG, SCHEMA, by_id, clashing, edge_docs  # noqa: E402

from tablesync.llm import mixing, packing, quality, sketches  # noqa: E402
from tablesync.llm.queries import ORACLE_SQL, QUERIES, WEIGHTS  # noqa: E402


def docs_of(spark, sf_dir):
    return dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())


def shingles(text):
    words = text.lower().split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprint_query(spark, sf_dir):
    docs = {i: t or "" for i, t in docs_of(spark, sf_dir).items()}
    order = sorted(docs, reverse=True)
    rows = {r["doc_id"]: r for r in QUERIES["op2_document_fingerprints"](spark, sf_dir).collect()}
    assert set(rows) == set(docs)
    off, by_text = [], {}
    for i, j in zip(order, [*order[1:], order[0]], strict=True):
        r, text = rows[i], docs[i]
        n = len(text) // 3
        changed = text[: len(text) - n] + docs[j][:n]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        off += [r["near_edited"] - likeness(text, changed), r["near_next"] - likeness(text, docs[j])]
        assert abs(r["n_shingles"] - len(shingles(text))) <= 0.5 * len(shingles(text))
    assert max(map(abs, off)) < 0.2 and np.mean(np.abs(off)) < 0.02


def test_fingerprint_edges(spark):
    docs = clashing(edge_docs(spark))
    rows = sketches.compare_with_next(docs).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in docs.collect())
    got = {r["doc_id"]: r for r in rows}
    assert got[1]["n_chars"] == 0 and got[1]["fingerprint"] == got[2]["fingerprint"] == got[3]["fingerprint"] == ""
    assert got[2]["near_next"] == 1.0 and got[6]["fingerprint"] == got[8]["fingerprint"] and got[6]["n_chars"] == len(LONG)
    assert 40_000 < got[6]["n_shingles"] < 80_000
    assert sketches.compare_with_next(docs.limit(0)).collect() == []
    one = sketches.compare_with_next(spark.createDataFrame([(1, "a b c d e f g h i")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"a b c d e f a b c").hexdigest()


def test_sketch_of_parts_merges(spark):
    rng = np.random.default_rng(1)
    hashes = [rng.integers(0, 1 << 48, n).astype(np.uint64) for n in (500, 40, 900, 0)]
    parts = [np.unique(h)[: sketches.K] for h in hashes]
    whole = np.unique(np.concatenate(hashes))[: sketches.K]
    rows = [("a", sketches.to_text(p)) for p in parts] + [(None, sketches.to_text(parts[1])), ("empty", "")]
    found = dict(sketches.merged(spark.createDataFrame(rows, "source string, fingerprint string"), "source").collect())
    assert found == {"a": sketches.to_text(whole), None: sketches.to_text(parts[1]), "empty": ""}
    assert (sketches.from_text(found["a"]) == whole).all()
    assert abs(sketches.distinct_shingles(whole) / 1440 - 1) < 0.3
    assert sketches.containment(parts[1], sketches.merge(parts[1], parts[0])) > 0.5 and sketches.resemblance(parts[3], parts[3]) == 1.0
    with_it = sketches.with_sketch(clashing(edge_docs(spark)), out="fingerprint")
    assert with_it.count() == 12 and with_it.where("doc_id is null and text is null").first()["fingerprint"] == ""


def test_quality_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smaller tables label a dozen rows of the rarer class
    rows = {r["doc_id"]: r for r in QUERIES["op3_quality_classifier"](spark, sf_dir).collect()}
    docs = docs_of(spark, sf_dir)
    assert set(rows) == set(docs)
    right = []
    for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect():
        got = rows[r["doc_id"]]
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert got["predicted"] == int(got["score"] >= 0.3) and 0 <= got["score"] <= 1
        if got["held_out"]:
            right.append(got["predicted"] == r["quality"])
    assert len(right) > 5 and np.mean(right) > 0.9


def test_quality_edges(spark):
    rng = np.random.default_rng(3)
    good, bad = (["river", "stone", "light", "water", "green"], ["buy!!", "now$$", "free%%", "click##"])
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad, 30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(99, None), (None, 1), (51, 7)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    edge = clashing(edge_docs(spark)).drop("score")
    scored = quality.with_score(edge, model)
    assert scored.columns == [*edge.columns, "score"] and scored.where("score is null or score < 0 or score > 1").count() == 0
    scores = dict(quality.with_score(docs, model).select("doc_id", "score").collect())
    assert all((scores[i] > 0.5) == bool(i % 2) for i in range(60))
    assert {r["score"] for r in scored.where("doc_id in (1, 2, 3)").collect()} == {model.score(b"")}
    kept = quality.accepted(docs, model)
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(60) if i % 2]
    clash = quality.accepted(clashing(edge_docs(spark)), model, least=0.0)
    assert clash.columns == clashing(edge_docs(spark)).columns and clash.count() == 12
    nothing = quality.train(docs, labels.limit(0))
    assert nothing.score(b"any text") == 0.5 and quality.with_score(docs.limit(0), nothing).collect() == []


def test_the_sample_is_learnt_from_in_a_task(spark, monkeypatch):
    rng = np.random.default_rng(4)
    docs = [(i, " ".join(rng.choice(["river", "stone", "buy!!", "now$$"], 30))) for i in range(20)]
    slots = {str(i): np.unique(np.concatenate(quality.features(t.encode())), return_counts=True) for i, t in docs}
    order = sorted(slots)
    expected = quality.fit([(slots[i][0], slots[i][1].astype(np.float32)) for i in order], np.array([int(i) % 2 for i in order]), steps=200)
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")

    def here(*args):
        raise AssertionError("on the driver")

    monkeypatch.setattr(type(docs), "toArrow", here)
    model = quality.train(docs, labels, steps=200)
    assert (model.gain == expected.gain).all() and model.bias == expected.bias


def test_long_texts_have_all_their_features():
    text = (" ".join(f"w{i % 977}x" for i in range(200_000))).encode()
    parts = quality.features(text)
    small = quality._features(text, False)
    assert len(parts) > 1 and Counter(np.concatenate(parts).tolist()) == Counter(small.tolist())


def test_packing_query(spark, sf_dir):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(packing.vocabulary_paths()[0])
    docs = docs_of(spark, sf_dir)
    rows = QUERIES["op5_best_fit_packing"](spark, sf_dir).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(docs)
    for i, own in pieces.items():
        ids = np.array([*encode.encode(docs[i] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and len(own) == -(-len(ids) // 2048)
        at = 0
        for k, r in enumerate(own):
            assert r["start"] == at and (r["length"] == 2048 or k == 0)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    check_sequences(rows)
    assert sum(r["length"] for r in rows) / 2048 / len({r["sequence_id"] for r in rows}) > 0.9


def check_sequences(rows, length=2048):
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(0 < end <= length for end in ends.values())


def test_packing_edges(spark):
    docs = clashing(edge_docs(spark))
    rows = packing.pack(docs, length=64).collect()
    check_sequences(rows, 64)
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(r["doc_id"] for r in docs.collect())
    assert [r["length"] for r in rows if r["doc_id"] == 1] == [1]
    assert packing.pack(docs.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["plain text, 12 3's!\n\n x", "<|endoftext|> inside", "日本語 текст   nbsp line", "a\u0085b c  ", "naïve – “quoted” café", "\x00\x01 \x0b\x0c\x1c\x1d", "é ʰ ª º ² ½ ₀"])
def test_fast_encoding_agrees(text):
    from tokenizers import Tokenizer

    encode = packing.Encoder(*packing.vocabulary_paths())
    expected = Tokenizer.from_file(packing.vocabulary_paths()[0]).encode(text, add_special_tokens=False).ids
    assert encode(text).tolist() == expected


def test_fast_encoding_of_every_plain_character():
    encode = packing.Encoder(*packing.vocabulary_paths())
    plain = [chr(i) for i in range(0x2100) if packing.Encoder.plain.fullmatch(chr(i))]
    assert len(plain) > 500
    rng = np.random.default_rng(0)
    for _ in range(300):
        text = "".join(rng.choice(plain, 40))
        assert encode(text).tolist() == encode.exact.encode(text, add_special_tokens=False).ids


def test_best_fit_rules():
    bins = packing.Bins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    assert [bins.place(n) for n in (6, 7, 8, 4)] == [(2, 0), (3, 0), (4, 0), (2, 6)]  # 3, the fullest, closed for 4


def test_mixing_agrees_with_sql(spark, sf_dir):
    rows = QUERIES["op1_mix_sources"](spark, sf_dir)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = con.sql(ORACLE_SQL["op1_mix_sources"])
    assert sorted(map(tuple, rows.select(*expected.columns).collect())) == sorted(expected.fetchall())


def test_mixing_deviates_by_less_than_a_block(spark):
    weights, sizes = {"a": 5, "b": 2, "c": 1}, {"a": 4000, "b": 1600, "c": 800, "d": 800}
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame([(k, s) for k, (_, s) in enumerate(rows)], "doc_id long, source string")
    mixed = mixing.mix(docs, weights, rest=1, block=4).collect()
    assert sorted(r["mix_position"] for r in mixed) == list(range(len(rows)))
    shares = {"a": 5, "b": 2, "c": 1, "d": 1}
    had = Counter()
    for t, r in enumerate(sorted(mixed, key=lambda r: r["mix_position"])):
        if t % 4 == 0 and t < 7000:
            assert all(abs(had[s] / 4 - shares[s] / 9 * (t // 4)) < 1 for s in shares)
        had[r["source"]] += 1
        assert r["mix_release"] <= r["mix_slot"] < r["mix_deadline"]


def test_mixing_edges(spark):
    docs = clashing(edge_docs(spark))
    mixed = mixing.mix(docs, WEIGHTS)
    assert mixed.columns[: len(docs.columns)] == docs.columns and mixed.columns[-1] == "mix_position_"
    assert sorted(r["mix_position_"] for r in mixed.collect()) == list(range(12))
    ordered = mixing.in_mixed_order(docs, WEIGHTS)
    assert ordered.columns == docs.columns and by_id(ordered, "doc_id", "text") == by_id(docs, "doc_id", "text")
    assert mixing.mix(spark.createDataFrame([], SCHEMA), WEIGHTS).collect() == []
    with_null = mixing.mix(docs, {None: 3, "src0": 2}, rest=5, block=1).where("source is null").collect()
    assert len({r["mix_block"] for r in with_null}) == len(with_null) == 3
    for wrong in ({"a": 0}, {"a": 1.5}, {"a": 20_001}):
        with pytest.raises(ValueError):
            mixing.mix(docs, wrong)


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text UNION ALL SELECT 2L, 'a b c'")
    rows = {r["doc_id"]: r for r in sketches.compare_with_next(docs).collect()}
    assert rows[1]["n_chars"] == 3 and rows[2]["edited_sha256"] == hashlib.sha256("a b a".encode()).hexdigest()
    assert {r["doc_id"]: r["length"] for r in packing.pack(docs).collect()}[1] >= 3
