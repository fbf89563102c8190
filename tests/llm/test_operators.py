"""Every corpus operator against a brute-force version on a small fixture that
holds nulls, empty and long texts, copies, near copies and repeated rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazrank.llm import exact_dedup, fingerprints, mixing, packing, pii, simhash, suffix_dedup, token_files, toxicity, url_rules
from hazrank.llm.tokens import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, fingerprint string"


def make_rows():
    rng = random.Random(3)
    syllables = ["the", "an", "re", "ti", "on", "ing", "ed", "ou", "wh", "le", "ß", "é"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() + rng.choice(["", "", "", ".", ",", ".\n"]) for _ in range(n))
    passage, line = text(60), text(9)
    rows = []
    for k in range(90):
        t = text(rng.randint(1, 120))
        if k % 9 == 0:
            t = t + " " + passage + " " + text(12)
        if k % 11 == 0:
            t = "\n".join([line] * 12) + t
        rows.append([k, t, "en", f"s{k % 4}" if k % 3 else "hot"])
    rows += [[100 + k, rows[5][1].upper() if k % 2 else rows[5][1], "en", "hot"] for k in range(12)]  # copies
    rows += [[120 + k, rows[9][1] + f" tail{k}", "de", "hot"] for k in range(10)]  # near copies
    rows += [[140, None, None, None], [141, "", "en", None], [142, "   ", "en", "s1"], [143, "a" * 3000, "en", "s1"], [144, text(4000), "fr", "s2"],
             [145, "Straße Ünï \u0001 x  y\t z", "de", "Z"], [146, rows[7][1], "en", "s2"], [146, rows[7][1], "en", "s2"],
             [147, "call +1 (523) 555-7040 10.0.0.1 or a.b@mail.example.com, 4539 1488 0343 6467", "en", "s3"]]
    return [(d, t, lang, src, len(t or ""), 7, "x", "y") for d, t, lang, src in rows]


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_mix_meets_targets(docs, empty):
    got = mixing.mix(docs, slot_rows=10).collect()
    assert len(got) == len(ROWS)
    total, size = sum(words(r[1]) for r in ROWS), collections.Counter()
    for r in ROWS:
        size[r[3]] += words(r[1])
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + ([None] if None in size else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:  # share, stop at the cap, share the excess again
        left = 1.5 * total - sum(target.values())
        over = {s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 2 * size[s]}
        if not over:
            target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
            break
        target |= {s: 2.0 * size[s] for s in over}
        open_ -= over
    source = {(r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()): r[3] for r in ROWS}
    taken = collections.Counter()
    for r in got:
        s = source[r.doc_id, r.text_key]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s]) and 0 <= r.taken <= 2 * r.size
        assert r.taken == sum(p.words for p in r.passes) and all(0 <= p.position <= 1 for p in r.passes)
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(3), slot_rows=10).collect()))
    assert mixing.mix(empty).count() == 0


def test_mix_positions_follow_schedule(spark):
    knots = ((0.0, 3.0), (0.5, 2.0), (1.0, 1.0))
    d = spark.range(1, 1000).select((F.col("id") / 1000).alias("u"))
    for r in d.select("u", mixing.time_of(F.col("u"), knots).alias("t")).collect():
        area = (3 + (3 - 2 * r.t)) / 2 * r.t  # both halves have slope -2
        assert area / mixing.integral(knots) == pytest.approx(r.u, abs=1e-9)


def test_mixed_documents_keep_columns_and_texts(docs, empty):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    texts = collections.Counter(r.text for r in out.collect())
    assert set(texts) <= {r[1] for r in ROWS}
    assert mixing.mixed_documents(empty).count() == 0


def test_exact_dedup(docs, empty):
    groups = collections.defaultdict(list)
    for r in ROWS:
        groups[exact_dedup.normal(r[1])].append(r[0])
    got = exact_dedup.exact_dedup(docs, shard_rows=20).collect()
    want = sorted((d, max(g), len(g), d == max(g), hashlib.sha256(t).hexdigest()) for t, g in groups.items() for d in g)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in got) == want
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(max(g) for g in groups.values())
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.deduplicated(empty).count() == 0


def test_cuckoo_index_inserts_deletes_and_resizes():
    index = exact_dedup.CuckooIndex(8)
    keys = [hashlib.sha256(str(k).encode()).digest() for k in range(3000)]
    for k, d in enumerate(keys):
        index.insert(d, k, k)
    assert index.resizes > 0 and index.live == 3000
    assert all(index.get(d, k) == k for k, d in enumerate(keys))
    assert all(index.delete(d, k) == k for k, d in enumerate(keys) if k % 2)
    assert [index.get(d, k) for k, d in enumerate(keys)] == [None if k % 2 else k for k in range(3000)]
    assert index.get(keys[0], 1) is None and index.delete(keys[1], 1) is None


def check_pieces(rows, window):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = collections.Counter(struct.pack(f"<{len(i)}I", *i) for i in (t.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in ROWS))
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding < window
    got = collections.Counter()
    for d, pieces in by_doc.items():
        starts = collections.defaultdict(list)
        for p in pieces:
            starts[p.start].append(bytes(p.ids))
        while starts:  # repeated rows give the same pieces again
            at, raw = 0, b""
            while at in starts:
                part = starts[at].pop()
                if not starts[at]:
                    del starts[at]
                raw, at = raw + part, at + len(part) // 4
            got[raw] += 1
    assert got == want


@pytest.mark.parametrize("window", [64, 1024])
def test_packing(docs, window):
    unique = docs.dropDuplicates(["doc_id"])
    rows = packing.pack(unique, window=window, slot_rows=5).collect()
    global ROWS
    kept, ROWS = ROWS, list({r[0]: r for r in ROWS}.values())
    try:
        check_pieces(rows, window)
    finally:
        ROWS = kept


def test_packing_repeated_rows_and_empty(docs, empty):
    rows = packing.pack(docs.filter("doc_id = 146")).collect()
    assert sorted((r.doc_id, r.start) for r in rows) == sorted([(146, r) for r in {x.start for x in rows}] * 2)
    assert packing.pack(empty).count() == 0


def test_repeat_counts_solve_the_histogram():
    histogram = np.zeros(33, dtype=np.int64)
    histogram[[10, 12, 20, 22, 5]] = [300, 100, 100, 150, 150]
    combos = packing.combinations(32)
    assert (combos.sum(axis=1) == 32).all() and len({tuple(c) for c in combos}) == len(combos)
    x = packing.repeat_counts(histogram, combos, 500)
    made = np.zeros(33)
    for k in range(3):
        made += np.bincount(combos[:, k], weights=x, minlength=33)
    assert (x >= 0).all() and np.abs(made[1:] - histogram[1:]).sum() < 0.35 * histogram.sum()


def test_golay_keys_meet_at_two_bits():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 4000, dtype=np.int64).view(np.uint64)
    b = a.copy()
    for _ in range(2):
        b ^= np.uint64(1) << rng.integers(0, 64, len(a)).astype(np.uint64)
    ka, ra = simhash.fuzzy_keys(a)
    kb, rb = simhash.fuzzy_keys(b)
    mine = set(zip(ka.tolist(), ra.tolist()))
    assert {r for k, r in zip(kb.tolist(), rb.tolist()) if (k, r) in mine} == set(range(4000))
    errors = simhash.nearest_errors(simhash.parities())
    assert sorted(collections.Counter((errors >= 0).sum(axis=1).tolist()).items()) == [(1, 277), (6, 1771)]


def brute_components(prints):
    parent = {d: d for d, _ in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, p in prints:
        for e, q in prints:
            if bin((p ^ q) & (2**64 - 1)).count("1") <= 2:
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: find(d) for d, _ in prints}


@pytest.mark.parametrize("most", [64, 1])
def test_simhash(docs, empty, most):
    got = simhash.near_dedup(docs, most=most).collect()
    prints = {(r[0], simhash.fingerprint(r[1])) for r in ROWS}
    assert {(r.doc_id, r["print"] & (2**64 - 1)) for r in got} == prints and len(got) == len(ROWS)
    want = brute_components(sorted(prints))
    assert all(r.component_id == want[r.doc_id] for r in got)
    assert simhash.near_dedup(empty).count() == 0


def test_simhash_fingerprint_bits():
    import xxhash
    assert simhash.fingerprint(None) == 0 and simhash.fingerprint(" \t") == 0
    assert simhash.fingerprint("A b") == xxhash.xxh64_intdigest(b"a b", 42)
    shingles = [b"a b c", b"b c a", b"c a b", b"a b c"]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    assert simhash.fingerprint("a B c a b c") == sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > 4)


def test_simhash_chain_and_one_of_each(spark, docs):
    # a chain of prints two bits apart is one component
    chain = spark.createDataFrame([((1 << (2 * k)) - 1,) for k in range(25)], "print long")
    from hazrank.llm.common import components
    for most in (64, 1):
        root = components(simhash.links(chain, most))
        assert root.count() == 24 and [r.root for r in root.select("root").distinct().collect()] == [0]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    want = brute_components(sorted({(r[0], simhash.fingerprint(r[1])) for r in ROWS}))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_url_rules(spark):
    rng = random.Random(5)
    urls = [f"https://{'spam-farm' if k % 5 == 0 else 'site' + str(k % 7)}.example.net/x/{k}" for k in range(400)]
    pages = spark.createDataFrame([(k, u, "h", "extra") for k, u in enumerate(urls)] + [
        (1000, None, "h", "e"), (1001, "no scheme", "h", "e"), (1002, "http://A.EXAMPLE.org/es/1?x#y", "h", "e"), (1003, "http://example.org/en/12", "h", "e"),
        (1004, "http://example.org/en/2", "h", "e"), (1005, "http://x.com/de/1", "h", "e"), (1006, "http://x.com/fr/1", "h", "e"), (1007, "http://xorg/", "h", "e"),
        (1008, "http://a.org?x", "h", "e"), (1008, "http://a.org?x", "h", "e")], "page_id long, url string, html string, host string")
    labels = spark.createDataFrame([(k, 0 if k % 5 == 0 and rng.random() < 0.95 else 1, 0) for k in range(400)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_rules.judge(pages, labels).collect()}
    for k, u in enumerate(urls):
        assert got[k].verdict == ("block" if "spam-farm" in u else "allow") and got[k].rule is None
        assert got[k].host == u.split("/")[2] and got[k].path == f"/x/{k}"
    want = {1000: ("", "", None, "allow"), 1001: ("", "", None, "allow"), 1002: ("a.example.org", "/es/1", "example.org/es/", "block"),
            1003: ("example.org", "/en/12", "example.org/en/1", "block"), 1004: ("example.org", "/en/2", "org/", "allow"),
            1005: ("x.com", "/de/1", "com/de/", "block"), 1006: ("x.com", "/fr/1", "com/fr/", "allow"), 1007: ("xorg", "/", None, "allow"),
            1008: ("a.org", "", None, "allow")}
    assert {k: (got[k].host, got[k].path, got[k].rule, got[k].verdict) for k in want} == want
    assert url_rules.judge(pages, labels).count() == pages.count()
    assert url_rules.judge(pages.limit(0), labels.limit(0)).count() == 0
    assert {r.verdict for r in url_rules.judge(pages.filter("page_id < 5"), labels.limit(0)).collect()} == {"allow"}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def test_email_scan_is_the_pattern():
    rng = random.Random(2)
    for _ in range(3000):
        t = "".join(rng.choice("a.@-b %é") for _ in range(rng.randint(0, 25)))
        assert pii.emails(t) == [m.span() for m in EMAIL.finditer(t)], t


def test_pii_base_and_model(docs, empty, spark):
    model = pii.fit(docs)
    got = {r.doc_id: r for r in pii.find_spans(docs, model).collect()}
    r = got[147]
    t = dict((x[0], x[1]) for x in ROWS)[147]
    found = {k: t[int(a):int(z)] for k, a, z in (s.split(":") for s in r.base.split(","))}
    assert found["email"] == "a.b@mail.example.com" and found["card"] == "4539 1488 0343 6467" and found["ip"] == "10.0.0.1"
    for d, x in got.items():
        assert set(x.base.split(",")) <= set(x.spans.split(",")) or not x.base
        assert x.n_email + x.n_ip + x.n_card + x.n_phone == len([s for s in x.base.split(",") if s])
    assert got[140].spans == "" and pii.find_spans(empty, model).count() == 0
    # held-out generated data: the tagger finds most of it by itself
    rng = np.random.default_rng(99)
    hit = 0
    for k in range(80):
        kind = pii.KINDS[k % 4]
        data = pii.generated(kind, rng)
        s = f"the on re {data} ing the"
        spans = pii.reconcile([(0, *model.decode([s[:pii.WINDOW]])[0])])
        hit += any(a < 10 + len(data) and z > 10 and kk == kind for kk, a, z, _ in spans)
    assert hit >= 56


def test_pii_takes_whole_long_addresses():
    for name in ("firstname-middlename-lastname", "first7name-middlename-lastname", "x" * 300):
        for host in ("example.com", "a-host-of-quite-a-long-name.department.example.com"):
            lead = "the and of " * 5
            text = f"{lead}{name} @ {host}. the and of"
            a, b = len(lead), len(lead) + len(name) + 3 + len(host)
            seen = {p for start, s in pii.windows_of(text) for p in range(start, start + len(s))}
            assert set(range(a, b)) <= seen
            starts = [start for start, _ in pii.windows_of(text)]
            assert starts == sorted(set(starts))
            mid = text.index(" @ ")
            assert pii.added_spans([], [("email", mid - 4, mid + 9, 0.99)], text) == [("email", a, b)]
            assert pii.added_spans([("ip", a, a + 8)], [("email", mid - 4, mid + 9, 0.99)], text) == [("email", a + 8, b)]
    plain = "the and of " * 5 + "name @ example.com the and of"
    assert [start for start, _ in pii.windows_of(plain)] == [plain.index("@") - pii.MARGIN]


def test_pii_gradient_is_right():
    rng = np.random.default_rng(4)
    model = pii.Tagger()
    x = rng.integers(1, pii.SYMBOLS, (3, pii.WINDOW))
    x[1, 40:] = 0
    tags = rng.integers(0, 3, (3, pii.WINDOW))

    def loss():
        em = model.emissions(x)
        log_z, _, _ = model.marginals(em, (x > 0).T)
        total = 0.0
        for b in range(3):
            n = int((x[b] > 0).sum())
            score = model.w["first"][tags[b, 0]] + sum(em[t, b, tags[b, t]] for t in range(n))
            total += log_z[b] - score - sum(model.w["trans"][tags[b, t - 1], tags[b, t]] for t in range(1, n))
        return total

    grads = model._gradients(x, tags)
    for name, at in (("out", (3, 1)), ("trans", (1, 2)), ("lstm_f", (5, 7)), ("lstm_b", (20, 30)), ("emb", (int(x[0, 3]), 2)), ("first", (1,))):
        w = model.w[name]
        old = w[at]
        w[at] = old + 1e-5
        up = loss()
        w[at] = old - 1e-5
        down = loss()
        w[at] = old
        assert grads[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-4), name


def test_fingerprints(docs, empty):
    unique = {r[0]: r[1] or "" for r in ROWS}
    got = {r.doc_id: r for r in fingerprints.edits_and_neighbours(docs.dropDuplicates(["doc_id"])).collect()}
    ids = sorted(unique, reverse=True)
    for d, n in zip(ids, ids[1:] + ids[:1]):
        e = fingerprints.edited(unique[d], unique[n])
        r = got[d]
        assert r.n_chars == len(unique[d]) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert r.fingerprint == fingerprints.fingerprints([fingerprints.pieces(unique[d].encode())])[0].text()
        assert r.edited_fingerprint == fingerprints.fingerprints([fingerprints.pieces(e.encode())])[0].text()
        assert 0 <= r.near_edited <= 1 and (r.near_next == 1.0) == (r.fingerprint == got[n].fingerprint)
    assert fingerprints.edits_and_neighbours(docs).count() == len(ROWS)
    assert fingerprints.edits_and_neighbours(empty).count() == 0


def test_fingerprint_is_a_multiset_hash():
    parts = [f"line {k}.\n".encode() for k in range(300)] + [b"line 5.\n"] * 3
    f = fingerprints.fingerprints
    whole = f([parts])[0]
    assert f([parts[::-1]])[0] == whole and f([parts], step=50)[0] == whole
    assert f([parts[:100]])[0] + f([parts[100:]])[0] == whole
    assert f([parts[:-1]])[0].insert(parts[-1]) == whole and whole.delete(parts[0]) == f([parts[1:]])[0]
    assert not f([parts[1:]])[0] == whole and fingerprints.Fingerprint.parse(whole.text()) == whole
    half = f([parts[:150] + [f"other {k}".encode() for k in range(153)]])[0]
    assert abs(whole.likeness(half) - 0.5) < 0.25 and whole.likeness(f([[b"z%d" % k for k in range(300)]])[0]) < 0.35
    assert b"".join(fingerprints.pieces(b"a. b! c\nd? e")) == b"a. b! c\nd? e"


def test_likeness_of_a_line_repeated_40000_times():
    line = [b"\n"]
    half, other = line * 20_000, [b"line %d\n" % k for k in range(2000)]
    whole, edited = fingerprints.fingerprints([line * 40_000, half + other])
    assert abs(whole.likeness(edited) - 2 * 2 / 5) < 0.05  # 2ab / (a2 + b2) of 2 and 1
    assert abs(fingerprints.Fingerprint.parse(whole.text()).likeness(edited) - 4 / 5) < 0.05


def test_pieces_differ_in_every_number_unless_128_bits_are_equal(monkeypatch):
    import xxhash
    monkeypatch.setattr(xxhash, "xxh3_64_intdigest", lambda p: 7)
    for digest in (xxhash.xxh3_128_digest, lambda p: hashlib.sha256(p).digest()[:8] + bytes(8), lambda p: bytes(8) + hashlib.sha256(p).digest()[:8]):
        monkeypatch.setattr(xxhash, "xxh3_128_digest", digest)
        a, b = fingerprints.fingerprints([[b"one\n"], [b"another\n"]])
        assert (a.uniform != b.uniform).all() and 30 < (a.signs != b.signs).sum() < 98


def test_token_files_round_trip(spark, docs, empty):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    path = token_files.write_token_files(docs, block_ids=500)
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    ids = {r[0]: t.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in ROWS}
    at = 0
    for r, d in zip(got, sorted(r[0] for r in ROWS)):
        assert (r.doc_id, r.start) == (d, at) and np.frombuffer(r.ids, "<u4").tolist() == ids[d]
        at += len(ids[d])
    assert len(got) == len(ROWS)
    assert token_files.read_token_files(spark, token_files.write_token_files(empty)).count() == 0


def test_values_round_trip():
    rng = np.random.default_rng(8)
    for n in (0, 1, 3, 4, 1001):
        v = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = token_files.encode_values(v)
        assert len(control) == -(-n // 4) and (token_files.decode_values(control, data, n) == v).all()
    ids, counts, ranks = token_files.read_block(token_files.write_block([None, 5], [2, 1], np.array([7, 70000, 3])))
    assert ids == [None, 5] and counts.tolist() == [2, 1] and ranks.tolist() == [7, 70000, 3]


def brute_repeats(length):
    raw = [(r[0], (r[1] or "").encode()) for r in ROWS]
    seen = collections.Counter(t[i:i + length] for _, t in raw for i in range(len(t) - length + 1))
    out = []
    for d, t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"shard_contexts": 20, "hot": 2}])
def test_suffix_dedup(docs, empty, options):
    got = suffix_dedup.suffix_dedup(docs, **options)
    assert sorted(tuple(r) for r in got.collect()) == brute_repeats(200)
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_suffix_array_and_prefixes():
    rng = random.Random(6)
    raw = bytes(rng.choice(b"abc") for _ in range(300)) + b"ab" * 60 + bytes(50)
    text = np.frombuffer(raw, dtype=np.uint8)
    order, word = suffix_dedup.suffix_array(text)
    assert order.tolist() == sorted(range(len(raw)), key=lambda k: raw[k:] + b"") or all(
        raw[a:] <= raw[b:] or raw[b:].strip(b"\0") == b"" for a, b in zip(order, order[1:]))
    shared = suffix_dedup.common_prefixes(order, word, np.array([0]), np.array([300]))
    for a, b in zip(order, order[1:]):
        if b < 300:
            n = 0
            while n < 200 and a + n < len(raw) and b + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            assert shared[b] == n


def test_toxicity_learns_and_scores_all(spark, empty):
    rng = random.Random(9)
    plain = ["the", "and", "of", "ring", "ther", "ation", "house", "lorem", "with"]
    rows, labels = [], []
    for k in range(900):
        bad = k % 6 == 0
        t = [rng.choice(plain) + rng.choice(["", "", "s", "ing"]) for _ in range(rng.randint(5, 60))]
        if bad:
            t[rng.randrange(len(t))] = rng.choice(["idiot", "scumbag", "vequin" + rng.choice("abcdef")])
        rows.append((k, " ".join(t), "en", "s"))
        if k % 3 != 1:
            labels.append((k, 1, int(bad)))
    rows += [(2000, None, None, None), (2001, "", "en", "s"), (2002, "the idiot " * 30_000, "en", "s"), (2002, "the idiot " * 30_000, "en", "s"), (None, "the and of", "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, known)
    out = toxicity.score_column(docs.select("doc_id", "text"), model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id is not None and r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum((r.score >= 0.5) == (r.doc_id % 6 == 0) for r in held)
    assert right / len(held) > 0.95
    assert all(r.score >= 0.5 for r in out if r.doc_id == 2002) and all(r.score < 0.5 for r in out if r.doc_id in (2000, 2001, None))
    kept = toxicity.clean(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if r.score < 0.5}
    none = toxicity.fit(docs, known.limit(0))
    assert {r.score for r in toxicity.score_column(docs.select("doc_id", "text"), none).collect()} == {0.0}
    assert toxicity.clean(empty, model).count() == 0


def test_toxicity_thresholds_rest_on_all_calibration_rows(spark, monkeypatch):
    rng = random.Random(4)
    plain = ["the", "and", "of", "ring", "ther", "ation", "house", "lorem", "with"]
    rows = []
    for k in range(1200):
        t = [rng.choice(plain) for _ in range(rng.randint(5, 40))]
        if rng.random() < (0.8 if k % 10 == 0 else 0.1):  # a word that clean texts have, too
            t[0] = "idiot"
        rows.append((k, " ".join(t), int(k % 10 == 0)))
    tuned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 1]
    long = next(r for r in tuned if r[2] == 0)
    rows[long[0]] = (long[0], "the house " * (toxicity.MOST_CHARS // 8), 0)
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    seen, calibrate = [], toxicity.Classifier.calibrate
    monkeypatch.setattr(toxicity.Classifier, "calibrate", lambda self, c: (seen.append((c[:, 2].sum(), c[:, 3].sum())), calibrate(self, c)))
    for caps in ({}, {"most_positive": 40, "most_negative": 40}):
        model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), **caps)
        score = model.scores([toxicity.buckets(toxicity.words_of(rows[k][1])) for k, _, _ in tuned])
        y = np.array([r[2] for r in tuned])
        f1 = lambda on: 2 * (y * on).sum() / (y.sum() + on.sum())
        assert f1(score >= 0.5) > max(f1(score >= s) for s in score) - 0.01
    assert seen == [(len(tuned), sum(r[2] for r in tuned))] * 2


def test_long_texts_pool_in_parts():
    model = toxicity.Classifier()
    ids = np.random.default_rng(0).integers(0, toxicity.BUCKETS, (1000, 2)).astype(np.int32)
    assert model.logits([ids], step=100)[0] == pytest.approx(model.logits([ids])[0], abs=1e-4)


def test_tokens_are_the_library_s():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from hazrank.llm.tokens import encoded
    texts = [r[1] or "" for r in ROWS] + ["", " ", "  a  b ", "a \n b", "\n", "a\n\nb", "x  .y", "it's we're I'LL don't", "e ́a", "a<|endoftext|> b", "日本 語。",
                                           "a\tb \tc", "ΣΑΣ. Σας", "..a.. 12ab 3.14!!", "a\x1cb \x1c c", "\nabc def", "x \ny", "a\x01b c", "q\r\nw e", "K Å"]
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        t = Tokenizer.from_file(vocabulary(name))
        for text, ids in zip(texts, encoded(pa.array(texts), name, spaced, 9)):
            assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids + [9], repr(text)


# --- hot keys -----------------------------------------------------------------------
def test_mix_spreads_ids_that_many_rows_share(spark):
    """A third of all rows have one id, a third none: the running sums still
    lay every source's words end to end, in parts of bounded size."""
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"w{k} " * (k % 5 + 1 - k % 2), "s" if k % 2 else "hot") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(docs, slot_rows=20).collect()
    assert len(got) == 900
    for source in ("s", "hot"):
        size = sum(words(t) for _, t, src in rows if src == source)
        mine = [r for r in got if r.source_size == size]
        assert sum(r["size"] for r in mine) == size and sum(r.taken for r in mine) == round(mine[0].target)
        assert all(r.taken <= 2 * r["size"] for r in mine)
    plan = mixing.mix(docs, slot_rows=20)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [sum(size" in line]
    assert windows and all("part" in line for line in windows)


def test_url_verdicts_where_one_token_set_holds_a_third(spark):
    urls = [f"https://same.example.net/a/{k}" if k % 3 == 0 else f"https://h{k}.example.net/p{k}x" for k in range(300)] + ["https://spam.biz/ads/x"] * 60
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(k, 0 if "spam" in u else 1, 0) for k, u in enumerate(urls) if k % 2 == 0], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_rules.judge(pages, labels, rules=(), min_support=0.05).collect()}
    assert len(got) == len(urls)
    assert all(got[k].verdict == ("block" if "spam" in u else "allow") for k, u in enumerate(urls))


def brute_rules(urls, labels, min_support, min_confidence):
    """Every combination of the tokens of labelled urls, counted one by one."""
    import itertools
    known = [(frozenset(t), labels[p]) for p, t in urls.items() if p in labels and t]
    n, base, rules = len(known), sum(b for _, b in known) / len(known), []
    for combo in {frozenset(c) for t, _ in known for k in (1, 2, 3) for c in itertools.combinations(sorted(t), k)}:
        have = [b for t, b in known if combo <= t]
        bad = sum(have)
        if bad / n < min_support or bad / len(have) < min_confidence:
            continue
        p, m, z = bad / len(have), len(have), url_rules.SURE
        if (p + z * z / (2 * m) - z * (p * (1 - p) / m + z * z / (4 * m * m)) ** 0.5) / (1 + z * z / m) > base:
            rules.append(combo)
    return [r for r in rules if not any(o < r for o in rules)]


def test_url_rules_are_those_of_brute_force(spark):
    rng = random.Random(8)
    urls = [f"https://{rng.choice(['a', 'b', 'c'])}.{rng.choice(['org', 'net'])}/{rng.choice(['x', 'y'])}/{rng.choice(['q', 'r', 's'])}" for _ in range(400)]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    bad = {k: int(("//a." in u and "/x/" in u and rng.random() < 0.9) or rng.random() < 0.05) for k, u in enumerate(urls) if k % 4}
    labels = spark.createDataFrame([(k, 1 - b, 0) for k, b in bad.items()], "doc_id long, quality int, toxic int")
    parsed = url_rules.parsed(pages)
    tokens = {r.page_id: r.tokens for r in parsed.collect()}
    want = brute_rules(tokens, bad, 0.02, 0.5)
    got = url_rules.mine(parsed, labels, 0.02, 0.5).collect()
    small = {frozenset(r.tokens) for r in got if len(r.tokens) <= 3}
    assert small == set(want) and len(want) > 0
    verdict = {r.page_id: r.mined for r in url_rules.judge(pages, labels, (), 0.02, 0.5).collect()}
    assert all(verdict[k] == any(r <= set(t) for r in want) for k, t in tokens.items())


def test_ranges_of_repeated_and_null_ids(spark):
    """A third of all rows have one id, some none: every range is one task's,
    and both operators still see all rows in order."""
    rng = random.Random(4)
    rows = [(5 if k % 3 == 0 else None if k % 10 == 0 else k, f"text {rng.random()} " * (1 + k % 7)) for k in range(240)] + [(1000, "long words " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got = sorted(token_files.read_token_files(spark, token_files.write_token_files(docs, block_ids=300)).collect(), key=lambda r: r.start)
    want = collections.Counter((d, tuple(t.encode(x, add_special_tokens=False).ids + [2])) for d, x in rows)
    assert collections.Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += len(r.ids) // 4
    prints = fingerprints.edits_and_neighbours(docs).collect()
    assert len(prints) == len(rows)
