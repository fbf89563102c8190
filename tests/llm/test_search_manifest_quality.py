"""Ranked search, Merkle manifest and quality classifier against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazrank.llm import lexical, merkle, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, node string, pos long, tree string"


def make_rows():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(300)]
    weights = [1 / (k + 1) for k in range(300)]
    rows = []
    for k in range(400):
        words = rng.choices(vocabulary, weights, k=rng.choice([0, 3, 10, 40, 200]))
        rows.append((k, " ".join(w.upper() if rng.random() < 0.1 else w + rng.choice(["", "", ".", "\n"]) for w in words), rng.choice(["en", "de", None]), "s"))
    rows += [(500, rows[7][1], "en", "s")] * 3 + [(7, rows[9][1], "en", "s"), (None, rows[11][1], None, None), (None, None, "fr", None)]
    rows += [(501, None, "en", "s"), (502, "", "zz", "s"), (503, " .,;\x7f\x00 ", "en", "s"), (504, "Straße w1 ÄÖ w1 日本語w2 w299", "de", "s"), (505, "w3 " * 30000 + "w250", "en", "s"), (506, "a" * 5000, "en", "s")]
    return [(d, t, lang, s, None if t is None else len(t), "x", "y", 1, "z") for d, t, lang, s in rows]


ROWS = make_rows()
QUERIES = [(0, "w0 w1 w2 w250 w299"), (1, "w3 w3 W3"), (2, "nothing here"), (3, None), (4, ""), (5, "w7 w100 w120 Straße 日本語w2"), (5, "w9"), (None, "w4 w5"),
           (6, " ".join(f"w{k}" for k in range(0, 300, 7)))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- ranked search -----------------------------------------------------------
def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")]


def best_of(rows, query, k=10):
    """Scores by their definition; ids without order among equal rows."""
    held = [(d, terms(t)) for d, t, *_ in rows]
    n_docs, n_terms = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = {t: sum(t in set(x) for _, x in held) for t in set(terms(query))}
    out = []
    for d, words in held:
        m = 25 + (75 * len(words) * n_docs) // max(n_terms, 1)
        score = 0
        for t in terms(query):
            tf = words.count(t) if df[t] else 0
            if tf:
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        if score > 0:
            out.append((-score, d is None, d or 0))
    return [(None if none else d, -s) for s, none, d in sorted(out)[:k]]


@pytest.mark.parametrize("docs_a_segment, window, block", [(8192, 2048, 64), (60, 16, 4)])
def test_search_is_the_definition(spark, docs, monkeypatch, docs_a_segment, window, block):
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", docs_a_segment)
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "QUERIES", 3)  # several blocks of queries
    # constants of this process are not those of the workers: one segment and its queries here
    index = lexical.build_index(docs)
    queries = spark.createDataFrame(QUERIES, "item_id long, text string")
    got = {}
    for r in lexical.search(index, queries).collect():
        got.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    for item, text in QUERIES:
        want = best_of(ROWS, text)
        if item == 5:
            continue  # two texts of one id
        assert [(d, s) for _, d, s in sorted(got.get(item, []))] == want, item
        assert [k for k, _, _ in sorted(got.get(item, []))] == list(range(1, len(want) + 1))
    five = sorted((d, s) for _, d, s in got[5])
    assert five == sorted(best_of(ROWS, QUERIES[5][1]) + best_of(ROWS, QUERIES[6][1]))


def segment_lists(rows, n_docs, n_terms):
    seg = lexical.Segment()
    for d, t, *_ in rows:
        seg.add(d, t)
    found = list(zip(*(seg.rows(0).column(c).to_pylist() for c in ("term", "df", "head", "sky", "data"))))
    m_of = lexical.norms(n_docs, n_terms)
    m = m_of(np.frombuffer(found[0][2], "<u4").astype(np.int64))
    return {r[0]: lexical.Postings(*r[1:], m_of, m) for r in found[1:]}, len(m)


def test_block_maxima_reject_before_decompression_and_lose_nothing(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 4)
    rng = random.Random(2)
    rows = [(k, " ".join(["common"] * rng.randint(1, 3) + ["filler"] * rng.randint(0, 60) + (["rare"] * rng.randint(1, 4) if k % 37 == 0 else []))) for k in range(1500)]
    size = sum(len(t.split()) for _, t in rows)
    lists, n = segment_lists(rows, len(rows), size)
    weight = {b"common": 3, b"rare": 5000}
    seen = {}
    got = lexical.top_of([(w, lists[t]) for t, w in weight.items()], n, 10, 64, seen)
    whole, _ = segment_lists(rows, len(rows), size)
    scores = np.zeros(n, np.int64)
    for t, w in weight.items():
        whole[t].load(np.arange(len(whole[t].last)))
        scores[whole[t].docs] += w * whole[t].impact
    order = np.lexsort((np.arange(n), -scores))[:10]
    assert got == [(int(d), int(scores[d])) for d in order]
    assert seen["rejected"] > 0 and not lists[b"common"].there.all()


def test_block_maxima_are_exact_for_any_statistics(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 8)
    rng = random.Random(3)
    rows = [(k, " ".join(["x"] * rng.randint(1, 9) + ["y"] * rng.randint(0, 90))) for k in range(300)]
    for stats in ((300, 9000), (10 ** 9, 10 ** 12), (7, 10 ** 6)):
        lists, _ = segment_lists(rows, *stats)
        p = lists[b"x"]
        p.load(np.arange(len(p.last)))
        assert [int(p.impact[a:b].max()) for a, b in zip(p.at, p.at[1:])] == p.most.tolist()


def test_variable_length_values_round_trip():
    v = np.array([0, 1, 127, 128, 16383, 16384, 2 ** 21, 2 ** 28 - 1, 2 ** 32 - 1, 5])
    raw, size = lexical.encode(v)
    assert size.tolist() == [1, 1, 1, 2, 2, 3, 4, 4, 5, 1] and lexical.decode(raw).tolist() == v.tolist()


def test_terms_are_cut_anywhere_but_inside(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 16)
    text = "Ab1 cé-日本 " * 50 + "x" * 100 + " END"
    assert [t.decode() for part in lexical.terms_of(text) for t in part] == terms(text)


def test_large_norms_are_whole_numbers():
    length = np.array([10, 4_000_000_000], dtype=np.int64)
    assert lexical.norms(10 ** 11, 10 ** 13)(length).tolist() == [25 + 75 * int(x) * 10 ** 11 // 10 ** 13 for x in length]


def test_search_of_empty_tables(spark, docs, empty):
    queries = spark.createDataFrame(QUERIES, "item_id long, text string")
    assert lexical.search(lexical.build_index(empty), queries).count() == 0
    assert lexical.search(lexical.build_index(docs), queries.limit(0)).count() == 0


# --- Merkle manifest ------------------------------------------------------------
def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, add=0):
    value = {"doc_id": r[0], "source": r[3], "lang": r[2], "n_chars": None if r[4] is None else r[4] + add, "text": r[1]}
    return sha(*("-" if value[c] is None else f"{len(str(value[c]).encode())}:{value[c]}" for c in ("doc_id", "source", "lang", "n_chars", "text")))


def climb(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][k:k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def brute_manifest(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = climb([leaf(r) for r in by_lang[lang]])
    upper = climb([trees[lang][-1][0] for lang in order])
    out = []
    for place, lang in enumerate(order):
        for k, r in enumerate(by_lang[lang]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node, proof, at = leaf(r, int(tampered)), [], k
            for level in trees[lang][:-1]:
                pair = level[at & ~1:(at | 1) + 1]
                proof += [x for j, x in enumerate(pair) if j != at & 1]
                node = sha(*[node if j == at & 1 else x for j, x in enumerate(pair)])
                at >>= 1
            at = place
            for level in upper[:-1]:
                pair = level[at & ~1:(at | 1) + 1]
                proof += [x for j, x in enumerate(pair) if j != at & 1]
                node = sha(*[node if j == at & 1 else x for j, x in enumerate(pair)])
                at >>= 1
            out.append((r[0], leaf(r), trees[lang][-1][0], upper[-1][0], sha(*proof), node, node == upper[-1][0]))
    return out


def key(t):
    return tuple((x is not None, x) for x in t)


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_manifest_is_the_definition(docs, bits):
    d = docs
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    rows = d.select("doc_id", "lang", merkle.leaf_of().alias("leaf"),
                    F.when(hit, merkle.leaf_of({"n_chars": F.col("n_chars") + 1})).otherwise(merkle.leaf_of()).alias("changed"))
    trees, proofs = merkle.manifest(rows, bits)
    want = brute_manifest(ROWS)
    assert sorted((tuple(r) for r in proofs.collect()), key=key) == sorted(want, key=key)
    assert not all(r[-1] for r in want)
    got = {r.lang: (r.n, r.subroot, r.root) for r in trees.collect()}
    assert {k: v[0] for k, v in got.items()} == {lang: sum(r[2] == lang for r in ROWS) for lang in {r[2] for r in ROWS}}
    assert {v[1] for v in got.values()} == {r[2] for r in want} and {v[2] for v in got.values()} == {want[0][3]}


def test_manifest_of_one_row_and_of_none(spark, empty):
    one = spark.createDataFrame([(None, None, "ab", "cd")], "doc_id long, lang string, leaf string, changed string")
    _, proofs = merkle.manifest(one)
    assert [tuple(r) for r in proofs.collect()] == [(None, "ab", "ab", "ab", sha(), "cd", False)]
    trees, proofs = merkle.manifest(one.limit(0))
    assert trees.count() == 0 and proofs.count() == 0


def test_manifest_splits_a_hot_language_and_equal_rows(spark):
    """A third of all rows are one row, and all are of one language."""
    rows = spark.range(600).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("doc_id"), F.lit("en").alias("lang"))
    rows = rows.withColumn("leaf", F.sha2(F.col("doc_id").cast("string"), 256)).withColumn("changed", F.col("leaf"))
    trees, proofs = merkle.manifest(rows, 4)
    assert trees.first().n == 600 and proofs.filter("verified").count() == 600
    assert proofs.filter("doc_id = 5").count() == 201


# --- quality ----------------------------------------------------------------------
def labelled(n=300, seed=4):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(rng.choice(["the", "an", "re", "on"]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 300))]
        low = k % 4 == 0
        if low:  # junk in one part of the text only
            a = rng.randrange(len(words))
            words[a:a + 40] = [w.upper() + "!!" for w in words[a:a + 40]] or ["X!!"]
        rows.append((k, " ".join(words), "en", "s", 0, "taken", "y", 1, "z"))
        labels.append((k, 0 if low else 1, 0))
    return rows, labels


def test_quality_learns_from_bags_and_keeps_columns(spark, empty):
    rows, labels = labelled()
    rows += [(None, None, None, None, None, None, None, None, None), (901, "", "en", "s", 0, "x", "y", 1, "z"), (902, rows[3][1], "en", "s", 0, "x", "y", 1, "z"), (902, rows[3][1], "en", "s", 0, "x", "y", 1, "z")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    known = spark.createDataFrame(labels + [(None, 1, 0), (5000, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, known)
    out = quality.score_column(docs, model)
    assert out.columns == docs.columns + ["_score", "passages", "top_passage", "top_weight"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r["_score"] <= 1 and 0 <= r.top_passage < r.passages and 0 < r.top_weight <= 1 for r in got)
    truth = {d: q for d, q, _ in labels}
    held = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 60 and np.mean([(r["_score"] >= 0.5) == truth[r.doc_id] for r in held]) > 0.95
    assert len({r["_score"] for r in got if r.doc_id == 902}) == 1
    assert quality.score_column(empty, model).count() == 0
    none = quality.fit(docs, known.filter("quality = 1"))
    assert {r["_score"] for r in quality.score_column(docs, none).collect()} == {0.0}


def test_quality_never_learns_from_held_out_rows(spark):
    rows, labels = labelled(120)
    docs = spark.createDataFrame(rows, SCHEMA)
    held = lambda d: zlib.crc32(str(d).encode()) % 3 == 1
    one = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    two = quality.fit(docs, spark.createDataFrame([(d, 1 - q if held(d) else q, t) for d, q, t in labels], "doc_id long, quality int, toxic int"))
    assert all(np.array_equal(one.p[k], two.p[k]) for k in one.p) and np.array_equal(one.emb, two.emb)


def plain_logit(model, ids):
    """One document by loops."""
    p, h = model.p, []
    for a in range(0, len(ids), quality.PASSAGE):
        part = ids[a:a + quality.PASSAGE]
        x = np.zeros(quality.DIM + 1)
        for k, (w, s) in enumerate(part):
            x[:quality.DIM] += model.emb[w] + model.emb[s]
            x[quality.DIM] += a + k > 0 and w == ids[a + k - 1][0]
        h.append(np.tanh(x / len(part) @ p["W"] + p["b"]))
    s = [sum(p["w"] * np.tanh(v @ p["V"]) / (1 + np.exp(-(v @ p["U"])))) for v in h]
    a = np.exp(s) / sum(np.exp(s))
    return sum(w * v for w, v in zip(a, h)) @ p["c"] + p["d"][0]


def test_attention_is_the_definition_and_gradients_are_right():
    rng = np.random.default_rng(1)
    model = quality.AttentionModel()
    texts = [rng.integers(0, 40, (n, 2)).astype(np.int32) for n in (1, 64, 65, 300)]
    x, count = model.means(texts)
    f = model.forward(x, count)
    assert count.tolist() == [1, 1, 2, 5]
    assert np.allclose(f["logit"], [plain_logit(model, t) for t in texts])
    d = np.array([0.3, -0.2, 0.5, 1.0])
    grads, dx = model.gradients(f, count, d)
    for name, value in [*model.p.items(), ("x", x)]:
        for at in list(np.ndindex(value.shape))[:: max(1, value.size // 7)]:
            before = value[at]
            sides = []
            for e in (1e-6, -1e-6):
                value[at] = before + e
                sides.append(d @ model.forward(x, count)["logit"])
            value[at] = before
            assert abs((sides[0] - sides[1]) / 2e-6 - (dx if name == "x" else grads[name])[at]) < 1e-5, (name, at)


def test_long_texts_are_encoded_in_parts(monkeypatch):
    model = quality.AttentionModel()
    texts = [quality.buckets(" ".join(f"w{k % 50}" for k in range(n))) for n in (3, 1000, 70, 5000)]
    whole = model.means(texts)
    monkeypatch.setattr(quality, "PART", quality.PASSAGE * 4)
    parts = model.means(texts)
    assert np.allclose(whole[0], parts[0]) and (whole[1] == parts[1]).all()
    monkeypatch.setattr(quality, "PIECE", 10)
    assert np.array_equal(quality.buckets(" ".join(f"w{k % 50}" for k in range(70))), texts[2])


def test_shapes():
    assert [quality.shape(w) for w in (b"THE!!", b"in***", b"The", "éa,".encode(), b"a1b22")] == [b"A!", b"a*", b"Aa", b"a,", b"a0a0"]
