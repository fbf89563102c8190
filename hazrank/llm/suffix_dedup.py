"""Suffix-array dedup: bytes covered by a 200-byte string that also starts
somewhere else.

Which text goes where.  Every window of ``LENGTH`` bytes has a smallest
rolling hash among its 32-byte grams (its anchor); equal windows have equal
anchors, so only windows whose anchor occurs again are looked at.  A stretch
of windows with one anchor travels as a context (the stretch and the last
window's bytes) to the shard of its anchor, so that equal windows meet.

In a shard, the contexts laid end to end get a suffix array by
Larsson-Sadakane refinement in numpy: suffixes are grouped by their first
eight bytes, and groups that are not single yet are sorted again by the group
at twice the depth.  Kasai's walk then gives the common prefixes (all contexts
in step, eight bytes at a time), and neighbours that share ``LENGTH`` bytes
are repeats.

An anchor with more than ``HOT`` occurrences is spread over several shards.
Each such shard lists its distinct windows by digest; the sorted lists are
merged by binary search, bucket by bucket, and a window that two shards know
is a repeat as well.

Exact copies are told by their SHA-256: all windows of a text that occurs
twice are repeats.

Defined cases: a null text is empty; a text below ``LENGTH`` bytes keeps all;
repeated rows are copies of one another; a null doc_id is kept; no choice among
equal passages is made, as all of them go; a very long text is cut into windows,
never at a prefix; columns beyond doc_id and text are not read; an empty table
gives no row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazrank.llm.common import documents, hot_join, map_arrow, ship_package, staged

LENGTH = 200
GRAM = 32
#: Contexts in a shard, about; occurrences above which an anchor is spread.
SHARD_CONTEXTS = 10_000
HOT = 4000
#: Windows of spread anchors in a merge bucket, about.
BUCKET_ROWS = 100_000
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        p = np.full(max(n, 1 << 16), np.uint64(base))
        p[0] = 1
        known = _POWERS[base] = np.multiply.accumulate(p)
    return known[:n]


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of windows with one anchor: hash, first window, windows.
    Equal windows lie in different stretches of one hash."""
    n = len(raw)
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide = length - gram + 1
    x = np.frombuffer(raw, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * _powers(pow(_BASE, -1, 1 << 64), n), dtype=np.uint64)])
    h = (total[gram:] - total[:-gram]) * _powers(_BASE, n - gram + 1)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    # sliding minimum: running minima of blocks from both sides
    m = len(h)
    padded = np.full(-(-m // wide) * wide, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:m] = h
    block = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(back[:m - wide + 1], ahead[wide - 1:m])
    # a window's anchor is the last of its smallest grams: it changes with the
    # smallest value, and when that value comes in again on the right
    first = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (h[wide:m] == low[1:])]))
    return low[first], first, np.diff(np.append(first, len(low)))


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the eight bytes from every place as a big-endian
    number."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    word = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k:k + n].astype(np.uint64)
    order = np.argsort(word, kind="stable").astype(np.int32)
    key = word[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    place = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int32)
    rank[order] = place
    size = np.diff(np.append(np.flatnonzero(new), n))
    open_ = np.flatnonzero(np.repeat(size > 1, size))
    h = 8
    while len(open_):
        at = order[open_]
        # past the end the shorter suffix comes first
        ahead = np.where(at < n - h, rank[np.minimum(at, n - 1 - h) + h] if h < n else 0, -1 - at).astype(np.int64)
        key = rank[at].astype(np.int64) * (2 * n + 1) + ahead + n
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[open_] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        rank[at] = open_[group]
        size = np.diff(np.append(np.flatnonzero(new), len(at)))
        open_ = open_[np.repeat(size > 1, size)]
        h *= 2
    return order, word


def common_prefixes(order: np.ndarray, word: np.ndarray, starts: np.ndarray, lengths: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Per place the bytes, up to ``most``, that its suffix shares with the
    suffix before it in ``order``.

    Kasai's walk: a suffix shares at least one byte less than the suffix one
    place to its left did.  The contexts are walked in step.
    """
    n = len(order)
    before = np.empty(n, dtype=np.int32)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    out = np.zeros(n, dtype=np.int16)
    rows = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[rows], lengths[rows]
    h = np.zeros(len(starts), dtype=np.int64)
    for step in range(int(lengths[0]) if len(lengths) else 0):
        live = int(np.searchsorted(-lengths, -step, side="left"))
        p = starts[:live] + step
        q = before[p].astype(np.int64)
        h = np.maximum(h[:live] - 1, 0)
        h[q < 0] = 0
        todo = np.flatnonzero((q >= 0) & (h < most))
        while len(todo):
            a, b = p[todo] + h[todo], q[todo] + h[todo]
            inside = (a < n) & (b < n)
            todo, a, b = todo[inside], a[inside], b[inside]
            differ = word[a] ^ word[b]
            same = np.full(len(todo), 8)
            at = np.flatnonzero(differ)
            # leading zero bytes of the difference; without neighbouring one
            # bits the conversion can't round up to the next power
            top = (differ[at] & ~(differ[at] >> np.uint64(1))).astype(np.float64)
            same[at] = (64 - np.frexp(top)[1]) // 8
            h[todo] += np.minimum(same, np.minimum(n - a, n - b))
            todo = todo[(same == 8) & (h[todo] < most)]
        h = np.minimum(h, most)
        out[p] = h
    return out


def repeats(contexts: list[bytes], owned: np.ndarray, times: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every owned window of the contexts: context, offset, number of equal
    owned windows (a context counts as often as its text has it), and class."""
    # a number after each context: no two suffixes stay equal past their context
    text = np.frombuffer(b"".join(c + k.to_bytes(8, "big") for k, c in enumerate(contexts)), dtype=np.uint8)
    lengths = np.array([len(c) for c in contexts], dtype=np.int64)
    starts = np.cumsum(lengths + 8) - lengths - 8
    order, word = suffix_array(text)
    shared = common_prefixes(order, word, starts, lengths, length)
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(shared[order] < length)
    which = np.repeat(np.arange(len(contexts)), owned)
    offset = np.arange(owned.sum()) - np.repeat(np.cumsum(owned) - owned, owned)
    mine = group[starts[which] + offset]
    count = np.bincount(mine, weights=times[which])
    return which, offset, count[mine], mine


def _signatures(length: int, gram: int):
    def run(batches):
        seen: set[bytes] = set()
        for b in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
            digests = [hashlib.sha256(t).digest() for t in texts]
            packed = []
            for t, d in zip(texts, digests):
                if d in seen or len(t) < length:
                    packed.append(None)
                    continue
                seen.add(d)
                packed.append(anchors(t, length, gram)[0].astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())],
                                             ["doc_id", "n_bytes", "digest", "anchors"])
    return run


def _short(digest: bytes) -> int:
    """Eight bytes of a digest, for joins whose false matches do no harm."""
    return int.from_bytes(digest[:8], "little", signed=True)


def _exploded(batches):
    for b in batches:
        digests, packed = b.column(0).to_pylist(), b.column(1).to_pylist()
        for k in range(0, len(digests), 500):
            hashes = [np.frombuffer(x, "<i8") for x in packed[k:k + 500]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(hashes)), pa.array(np.repeat([_short(d) for d in digests[k:k + 500]], [len(h) for h in hashes]), pa.int64()),
                 pa.array(np.concatenate([np.arange(len(h)) for h in hashes]), pa.int32())], ["hash", "doc", "i"])


def _texts(length: int):
    def run(batches):
        seen: set[bytes] = set()
        for b in batches:
            rows = []
            for t in b.column(0).to_pylist():
                raw = (t or "").encode("utf-8", "surrogatepass")
                d = hashlib.sha256(raw).digest()
                if len(raw) >= length and d not in seen:
                    seen.add(d)
                    rows.append((_short(d), d, raw))
            if rows:
                c = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.binary()), pa.array(c[2], pa.binary())], ["doc", "digest", "raw"])
    return run


def _contexts(length: int, gram: int):
    def run(batches):
        for b in batches:
            rows = []
            for digest, raw, marks in zip(*(c.to_pylist() for c in b.columns)):
                hashes, first, own = anchors(raw, length, gram)
                hashes = hashes.view(np.int64)
                same: dict[bytes, list[int]] = {}
                for m in sorted(marks, key=lambda m: m["i"]):
                    i = m["i"]
                    if i >= len(first):  # a mark of another text of the same eight bytes
                        continue
                    a, n = int(first[i]), int(own[i])
                    context = raw[a:a + n + length - 1]
                    if context in same:
                        same[context].append(a)
                    else:
                        same[context] = [a]
                        rows.append((int(hashes[i]), m["n"], digest[:16], same[context], n, context))
                if len(rows) >= 5000:
                    yield _context_batch(rows)
                    rows = []
            if rows:
                yield _context_batch(rows)
    return run


def _context_batch(rows):
    c = list(zip(*rows))
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, kinds)], ["hash", "n", "id", "firsts", "own", "raw"])


def _shard(length: int, hot: int):
    def run(t: pa.Table) -> pa.Table:
        shard = t.column("shard")[0].as_py()
        ids, firsts = t.column("id").to_pylist(), t.column("firsts").to_pylist()
        # a text that several tasks hold comes several times
        pick = sorted({(x, f[0]): k for k, (x, f) in enumerate(zip(ids, firsts))}.values())
        # equal contexts of several texts are sorted once and count together
        raws, n_all = t.column("raw").to_pylist(), t.column("n").to_pylist()
        own_all = t.column("own").to_pylist()
        members: dict[bytes, list[int]] = {}
        for k in pick:
            members.setdefault(raws[k], []).append(k)
        raw, groups = list(members), list(members.values())
        own, n = (np.array([v[g[0]] for g in groups], dtype=np.int64) for v in (own_all, n_all))
        times = np.array([sum(len(firsts[k]) for k in g) for g in groups])
        which, offset, count, group = repeats(raw, own, times, length)
        twice = count > 1
        # runs of neighbouring repeats in one context
        new = twice & ~np.concatenate([[False], twice[:-1] & (which[1:] == which[:-1])])
        last = twice & ~np.concatenate([twice[1:] & (which[1:] == which[:-1]), [False]])
        out = {"id": [], "a": [], "b": [], "window": [], "shard": []}
        for w, a, z in zip(which[new].tolist(), offset[new].tolist(), offset[last].tolist()):
            for k in groups[w]:
                for f in firsts[k]:
                    out["id"].append(ids[k])
                    out["a"].append(f + a)
                    out["b"].append(f + z)
        out["window"], out["shard"] = [None] * len(out["id"]), [shard] * len(out["id"])
        spread = np.flatnonzero(n[which] > hot)
        if len(spread):
            _, one = np.unique(group[spread], return_index=True)
            for k in spread[one]:
                w = which[k]
                out["id"].append(ids[groups[w][0]])
                out["a"].append(int(firsts[groups[w][0]][0] + offset[k]))
                out["b"].append(int(count[k]))
                out["window"].append(hashlib.blake2b(raw[w][offset[k]:offset[k] + length], digest_size=16).digest())
                out["shard"].append(shard)
        return pa.table({"id": pa.array(out["id"], pa.binary()), "a": pa.array(out["a"], pa.int64()), "b": pa.array(out["b"], pa.int64()),
                         "window": pa.array(out["window"], pa.binary()), "shard": pa.array(out["shard"], pa.int64())})
    return run


def _merge(t: pa.Table) -> pa.Table:
    """Windows that are single in their shard and known to another: the
    shards' sorted lists are searched in one another."""
    window = np.array(t.column("window").to_pylist(), dtype="S16").view("V16").view([("x", ">u8"), ("y", ">u8")])
    shard = t.column("shard").to_numpy()
    order = np.argsort(window, order=("x", "y"), kind="stable")
    window, shard = window[order], shard[order]
    lists = {s: window[shard == s] for s in np.unique(shard)}
    everyone = window
    found = np.zeros(len(order), dtype=bool)
    for s, own in lists.items():
        # places of this shard's windows in the merged list; more than one place: another shard's too
        several = np.searchsorted(everyone, own, side="right") - np.searchsorted(everyone, own, side="left") > 1
        found[shard == s] = several
    single = np.array(t.column("b").to_numpy())[order] == 1
    pick = order[found & single]
    got = t.take(pa.array(pick))
    return pa.table({"id": got.column("id"), "a": got.column("a"), "b": got.column("a")})


def repeated_windows(texts_with_marks: DataFrame, length: int, gram: int, shard_contexts: int, hot: int) -> DataFrame:
    """(``id``, ``a``, ``b``): runs of first bytes of repeated windows."""
    spark = texts_with_marks.sparkSession
    ship_package(spark)
    contexts = map_arrow(texts_with_marks.select("digest", "raw", "marks"), _contexts(length, gram),
                         "hash long, n long, id binary, firsts array<long>, own int, raw binary")
    total = texts_with_marks.agg(F.sum(F.size("marks"))).first()[0] or 0
    shards = max(1, -(-total // shard_contexts))
    salt = F.when(F.col("n") > hot, F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / hot))).otherwise(F.lit(0))
    dealt = contexts.withColumn("shard", F.pmod(F.xxhash64("hash", salt), F.lit(shards)))
    found = staged(dealt.groupBy("shard").applyInArrow(_shard(length, hot), "id binary, a long, b long, window binary, shard long"))
    runs = found.filter("window is null").select("id", "a", "b")
    spread = found.filter("window is not null")
    rows = spread.count()
    if rows:
        bucket = F.pmod(F.xxhash64("window"), F.lit(max(1, rows // BUCKET_ROWS)))
        runs = runs.unionByName(spread.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(_merge, "id binary, a long, b long"))
    return runs


def _removed(length: int):
    def run(batches):
        for b in batches:
            rows = []
            for digest, raw, runs in zip(*(c.to_pylist() for c in b.columns)):
                spans: list[list[int]] = []
                for r in sorted((r["a"], r["b"] + length) for r in runs):
                    if spans and r[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r[1])
                    else:
                        spans.append(list(r))
                kept, at = [], 0
                for a, z in spans:
                    kept.append(raw[at:a])
                    at = z
                kept = b"".join([*kept, raw[at:]])
                rows.append((digest, len(raw) - len(kept), len(spans), kept))
            c = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, [pa.binary(), pa.int64(), pa.int64(), pa.binary()])], ["digest", "n_removed", "n_spans", "kept"])
    return run


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_contexts: int = SHARD_CONTEXTS, hot: int = HOT,
                 with_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256``; with ``with_text`` also ``kept``, the bytes that remain of
    texts that lose a part (null: all or none remain)."""
    sigs = staged(map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _signatures(length, gram), "doc_id long, n_bytes long, digest binary, anchors binary"))
    copies = sigs.groupBy("digest").agg(F.count("*").alias("n"))
    spots = map_arrow(sigs.filter("anchors is not null").select("digest", "anchors"), _exploded, "hash long, doc long, i int")
    # a table of its own, so that a hot anchor's side of the join can be split
    again = staged(spots.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1"))
    marks = spots.join(again, "hash").groupBy("doc").agg(F.collect_set(F.struct("i", "n")).alias("marks"))
    texts = map_arrow(docs.select("text"), _texts(length), "doc long, digest binary, raw binary")
    marked = staged(texts.join(marks, "doc").select("digest", "raw", "marks"), "zstd")

    runs = repeated_windows(marked, length, gram, shard_contexts, hot)
    runs = runs.groupBy("id").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    partly = marked.select("digest", "raw", F.substring("digest", 1, 16).alias("id")).join(runs, "id").select("digest", "raw", "runs")
    partly = map_arrow(partly, _removed(length), "digest binary, n_removed long, n_spans long, kept binary")
    kept = [F.first("kept").alias("kept")] if with_text else []
    partly = staged(partly.withColumn("kept_sha256", F.sha2("kept", 256)).groupBy("digest").agg(
        F.first("n_removed").alias("n_removed"), F.first("n_spans").alias("n_spans"), F.first("kept_sha256").alias("kept_sha256"), *kept))

    known = copies.join(partly, "digest", "left").withColumn("m", F.col("n"))
    d = hot_join(sigs.select("doc_id", "n_bytes", "digest"), staged(known), "digest", "m")
    whole = (F.col("n") > 1) & (F.col("n_bytes") >= length)
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return d.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, empty).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
        *(["kept"] if with_text else []))


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: what repeats of 200 bytes leave of every document."""
    return suffix_dedup(documents(spark, sf_dir))
