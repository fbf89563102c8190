"""SimHash near-dedup with Golay-code fuzzy hashing.

A document's fingerprint has 64 bits: bit b is set if it is set in more than
half of the XXH64 hashes of its word shingles.  Documents are linked when
their fingerprints differ in at most two bits.

Distinct fingerprints are cut into three segments of 22, 21 and 21 bits.  Two
errors spread over three segments leave one segment exact, and every other
segment with at most two errors.  A segment, filled up to 23 bits and extended
by a parity bit, lies at distance 0, 2 or 4 from the extended Golay code: near
one codeword, or equally near to six.  Two words that differ in at most two
bits share at least one of their nearest codewords.  So the exact segment
together with each nearest codeword index of the next segment are keys -- one
to six for each of the three choices -- and linked fingerprints meet under at
least one key.  Candidates of a key are joined and verified by counting bits.

A key with more than ``MOST`` fingerprints is not paired: its fingerprints go
another exact way.  Two words differ in at most two bits if and only if some
word is within one bit of both, so each fingerprint names its 65 neighbours,
and all that name the same one are linked to the smallest of them.

Defined cases: a null or empty text has fingerprint zero; fewer words than a
shingle are one shingle; repeated rows share a fingerprint; a null doc_id never
is a component's name unless all are null; documents of one component tie, and
the smallest doc_id names it; a very long text is hashed whole; columns beyond
doc_id and text are carried along in one struct, so their names cannot clash; an
empty table gives no row.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazrank.llm.common import components, documents, hot_join, keep_rows, map_arrow, staged, text_key

SHINGLE = 3
SEED = 42
BITS = 2
#: Segments of the fingerprint: (first bit, bits).
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of a key that are paired; above, the neighbours' way.
MOST = 64
GENERATOR = 0xC75
_SET = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    import xxhash
    # bytes.lower and bytes.split know ASCII alone: A-Z, and the six blanks
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, seed)]
    else:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(size + 1) - 1
        starts = ends - size
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    column = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(column[:, k], minlength=256) @ _SET for k in range(8)])
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > len(hashes)))


def parities() -> np.ndarray:
    """The eleven check bits of each twelve-bit message."""
    out = np.zeros(4096, dtype=np.int64)
    for m in range(4096):
        r = m << 11
        for k in range(22, 10, -1):
            if r >> k & 1:
                r ^= GENERATOR << (k - 11)
        out[m] = r
    return out


def nearest_errors(check: np.ndarray) -> np.ndarray:
    """Per syndrome the error patterns (23 bits) to the nearest codewords of
    the extended code, -1 where there are fewer than six."""
    found: list[list[int]] = [[] for _ in range(2048)]
    for weight in (0, 2, 4):
        new: dict[int, list[int]] = {}
        for bits in itertools.combinations(range(24), weight):
            e = sum(1 << b for b in bits if b < 23)
            s = int(check[e >> 11]) ^ (e & 2047)
            if not found[s]:
                new.setdefault(s, []).append(e)
        for s, patterns in new.items():
            found[s] = patterns
    return np.array([p + [-1] * (6 - len(p)) for p in found], dtype=np.int64)


def codeword_indices(words: np.ndarray, check: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """Per 23-bit word the messages of its nearest codewords (n x 6, -1)."""
    e = errors[check[words >> 11] ^ (words & 2047)]
    return np.where(e < 0, -1, (words[:, None] ^ e) >> 11)


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) pairs: which segment is exact, its bits, and one codeword
    index of the segment after it."""
    check = parities()
    errors = nearest_errors(check)
    parts = [((prints >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    keys, rows = [], []
    for k in range(len(parts)):
        near = codeword_indices(parts[(k + 1) % len(parts)], check, errors)
        row, col = np.nonzero(near >= 0)
        keys.append((np.int64(k) << 34) | (parts[k][row] << 12) | near[row, col])
        rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def _fingerprints(shingle: int, seed: int):
    def run(batches):
        for b in batches:
            prints = np.array([fingerprint(t, shingle, seed) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64))], ["doc_id", "print"])
    return run


def _keys(batches):
    for b in batches:
        prints = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        keys, rows = fuzzy_keys(prints)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[rows].view(np.int64))], ["key", "print"])


def links(prints: DataFrame, most: int = MOST, bits: int = BITS) -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints that join the same
    ones as all links of at most ``bits`` bits do."""
    keys = map_arrow(prints.select("print"), _keys, "key long, print long")
    several = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = staged(keys.join(several, "key"))
    few = met.filter(F.col("n") <= most)
    pairs = few.select("key", F.col("print").alias("a")).join(few.select("key", F.col("print").alias("b")), "key")
    pairs = pairs.filter("a < b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits).select("a", "b")
    many = met.filter(F.col("n") > most).select("print").distinct()
    near = F.expr("concat(array(print), transform(sequence(0, 63), k -> print ^ shiftleft(1L, k)))")
    named = many.select("print", F.explode(near).alias("word"))
    first = named.groupBy("word").agg(F.min("print").alias("low"), F.count("*").alias("n")).filter("n > 1").select("word", "low")
    stars = named.join(first, "word").filter("print <> low").select(F.col("low").alias("a"), F.col("print").alias("b"))
    return pairs.union(stars).distinct()


def simhash(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): ``doc_id, print`` of every row, and per distinct
    fingerprint ``print, component_id, n``: the smallest doc_id that links
    reach, and the rows that share the fingerprint."""
    rows = staged(map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _fingerprints(shingle, seed), "doc_id long, print long"))
    prints = staged(rows.groupBy("print").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")))
    root = components(links(prints, most))
    known = prints.join(root, prints["print"] == root["node"], "left").select("print", "low", "n", F.coalesce("root", "print").alias("root"))
    # smallest id of each component; a component of one fingerprint is its own
    low = known.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("parts"))
    classes = hot_join(known, low, "root", "parts").select("print", "component_id", "n")
    return rows, staged(classes)


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, most: int = MOST) -> DataFrame:
    """One row per document: ``doc_id, print, component_id``."""
    rows, classes = simhash(docs, shingle, seed, most)
    return hot_join(rows, classes, "print", "n")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id, and
    of rows that share it the text of smallest SHA-256."""
    near = near_dedup(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    ids = docs.select("doc_id", text_key(F.col("text")).alias("text_key"))
    ids = ids.join(near.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    keys = ids.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    keys = keys.groupBy("doc_id").agg(F.min(F.struct("text_key", "n")).alias("first")).select("doc_id", "first.text_key", "first.n")
    return keep_rows(docs, staged(keys))


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document's fingerprint and component."""
    return near_dedup(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
