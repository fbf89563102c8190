"""Document fingerprints: a homomorphic multiset hash.

A text is the multiset of its paragraphs: pieces that end at a line break or
at a sentence's end, blanks and marks included.  Each piece is hashed to 128 bits
and these to a wide vector, both halves going into every number, and a text's fingerprint is the sum of its pieces' vectors,
number by number modulo a power of two:

* one count, modulo 2^32;
* ``UNIFORM`` numbers modulo 2^64, for equality;
* ``SIGNS`` numbers of plus or minus one modulo 2^32, for likeness.

So the order of the pieces does not matter, and a piece is inserted or deleted
by adding or subtracting its vector (``insert``, ``delete``); fingerprints of
parts add up to the whole's.  The differences of two fingerprints' sign sums
estimate how many pieces differ, which gives a likeness from 0 to 1.

Defined cases: a null text is empty, its fingerprint zero; equal fingerprints
have likeness 1; repeated rows get equal fingerprints; rows of equal doc_id
follow one another by text, null ids come last; a table of one row is its own
neighbour; a very long text is fingerprinted whole; columns beyond doc_id and
text are not read; an empty table gives no row.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazrank.llm.common import documents, map_arrow, shuffle_partitions

UNIFORM = 6
SIGNS = 128
_GOLDEN = 0x9E3779B97F4A7C15
_EMPTY = hashlib.sha256(b"").hexdigest()


def pieces(text: bytes) -> list[bytes]:
    """Parts that end in a line break or in ``. `` ``! `` ``? ``."""
    for mark in (b". ", b"! ", b"? "):
        text = text.replace(mark, mark + b"\xff")  # \xff is in no UTF-8 text
    out = text.replace(b"\n", b"\n\xff").split(b"\xff")
    return out if out[-1] else out[:-1]


def _mixed(h: np.ndarray, lane: int) -> np.ndarray:
    """An independent 64-bit number of each hash (n x 2), per lane: the first
    half is scrambled, the second put over it, and all scrambled again."""
    shift = np.uint64((_GOLDEN * (lane + 1)) & 0xFFFFFFFFFFFFFFFF)
    return _scrambled((_scrambled(h[:, 0] + shift) ^ h[:, 1]) + shift)


def _scrambled(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Fingerprint:
    """The three sums; immutable values that add and subtract."""

    __slots__ = ("count", "uniform", "signs")

    def __init__(self, count=0, uniform=None, signs=None):
        self.count = int(count) & 0xFFFFFFFF
        self.uniform = np.zeros(UNIFORM, np.uint64) if uniform is None else uniform
        self.signs = np.zeros(SIGNS, np.uint32) if signs is None else signs

    def __add__(self, other: "Fingerprint") -> "Fingerprint":
        return Fingerprint(self.count + other.count, self.uniform + other.uniform, self.signs + other.signs)

    def __sub__(self, other: "Fingerprint") -> "Fingerprint":
        return Fingerprint(self.count - other.count, self.uniform - other.uniform, self.signs - other.signs)

    def insert(self, piece: bytes) -> "Fingerprint":
        return self + fingerprints([[piece]])[0]

    def delete(self, piece: bytes) -> "Fingerprint":
        return self - fingerprints([[piece]])[0]

    def __eq__(self, other) -> bool:
        return self.count == other.count and bool((self.uniform == other.uniform).all() and (self.signs == other.signs).all())

    def likeness(self, other: "Fingerprint") -> float:
        """Twice the shared pieces over all pieces, estimated."""
        if self == other:
            return 1.0
        a, b = self.signs.view(np.int32).astype(np.float64), other.signs.view(np.int32).astype(np.float64)
        whole = float(a @ a + b @ b)
        return min(1.0, max(0.0, 2 * float(a @ b) / whole)) if whole else 0.0

    def text(self) -> str:
        raw = np.uint32(self.count).astype("<u4").tobytes() + self.uniform.astype("<u8").tobytes() + self.signs.astype("<u4").tobytes()
        return base64.b64encode(raw).decode()

    @classmethod
    def parse(cls, text: str) -> "Fingerprint":
        raw = base64.b64decode(text)
        return cls(np.frombuffer(raw, "<u4", 1)[0], np.frombuffer(raw, "<u8", UNIFORM, 4).copy(), np.frombuffer(raw, "<u4", SIGNS, 4 + 8 * UNIFORM).copy())


def fingerprints(texts: list[list[bytes]], step: int = 200_000) -> list[Fingerprint]:
    """Fingerprints of texts given as pieces; ``step`` bounds the pieces whose
    vectors are held at a time."""
    import xxhash
    out: list[Fingerprint] = []
    k = 0
    while k < len(texts):
        group, size = [], 0
        while k < len(texts) and (not group or size + len(texts[k]) <= step):
            group.append(texts[k])
            size += len(texts[k])
            k += 1
        if size > step:  # one very long text: the sum of its parts
            parts = [group[0][a:a + step] for a in range(0, size, step)]
            out.append(sum((fingerprints([p], step)[0] for p in parts), Fingerprint()))
            continue
        h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(p) for g in group for p in g), dtype=">u8").astype(np.uint64).reshape(-1, 2)
        counts = np.array([len(g) for g in group], dtype=np.int64)
        full = np.flatnonzero(counts)
        uniform = np.zeros((len(group), UNIFORM), np.uint64)
        signs = np.zeros((len(group), SIGNS), np.uint32)
        if size:
            at = (np.cumsum(counts) - counts)[full]
            for lane in range(UNIFORM):
                uniform[full, lane] = np.add.reduceat(_mixed(h, lane), at)
            raw = np.stack([_mixed(h, UNIFORM + j) for j in range(SIGNS // 64)], axis=1)
            bits = np.unpackbits(raw.view(np.uint8).reshape(size, SIGNS // 8), axis=1)
            ones = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
            signs[full] = (2 * ones - counts[full][:, None]).astype(np.uint32)
        out += [Fingerprint(c, u, s) for c, u, s in zip(counts, uniform, signs)]
    return out


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def fingerprint_column(docs: DataFrame, name: str = "fingerprint") -> DataFrame:
    """``doc_id`` and the fingerprint of each whole text."""
    def run(batches):
        for b in batches:
            prints = fingerprints([pieces(_utf8(t or "")) for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([p.text() for p in prints])], ["doc_id", name])
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, f"doc_id long, {name} string")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the
    text that follows."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_COLUMNS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def _compare(rows: list[tuple], step: int = 256):
    """rows: (doc_id, text, next text)."""
    for k in range(0, len(rows), step):
        part = rows[k:k + step]
        edits = [edited(t, n) for _, t, n in part]
        # neighbours share texts: each distinct object is hashed once
        texts = {id(t): t for _, t, n in part for t in (t, n)}
        own = dict(zip(texts, fingerprints([pieces(_utf8(t)) for t in texts.values()])))
        for (d, t, n), e, p in zip(part, edits, fingerprints([pieces(_utf8(e)) for e in edits])):
            a = own[id(t)]
            yield (d, len(t), hashlib.sha256(_utf8(e)).hexdigest(), a.text(), p.text(), a.likeness(p), a.likeness(own[id(n)]))


def edits_and_neighbours(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the
    next document by descending id.

    Documents are dealt by ranges of ids and sorted in each range.  The first
    row of a range also goes, as a guest, to the range before it, so that
    every row meets its follower with one shuffle of the texts; the ranges'
    number is that of the shuffle partitions.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = shuffle_partitions(spark)
    found = d.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts) if parts > 1 else []
    bounds = sorted({int(x) for x in found})
    below = F.size(F.filter(F.array(*[F.lit(x) for x in bounds]), lambda x: x > F.col("doc_id"))) if bounds else F.lit(0)
    part = F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(below).cast("int")
    # first row of each range: its largest id and, of several, the smallest text
    tops = {r["part"]: r["top"] for r in d.select("doc_id", part.alias("part")).groupBy("part").agg(F.max("doc_id").alias("top")).collect()}
    filled = sorted(tops)
    goes = {b: a for a, b in zip(filled, filled[1:])}
    goes[filled[0] if filled else 0] = filled[-1] if filled else 0
    entry = F.create_map(*[F.lit(x) for b, a in goes.items() for x in (b, a)])
    first = F.create_map(*[x for b in goes for x in (F.lit(b), F.lit(tops.get(b)).cast("long"))])
    home = d.withColumn("part", part)
    home = home.withColumn("to", F.explode(F.when(
        F.col("doc_id").eqNullSafe(first[F.col("part")]),
        F.array(F.struct(F.col("part").alias("at"), F.lit(0).alias("guest")), F.struct(entry[F.col("part")].alias("at"), F.lit(1).alias("guest"))))
        .otherwise(F.array(F.struct(F.col("part").alias("at"), F.lit(0).alias("guest"))))))
    dealt = home.select(F.col("to.at").alias("at"), F.col("to.guest").alias("guest"), "doc_id", "text").repartitionById(parts, F.col("at"))
    dealt = dealt.sortWithinPartitions("at", "guest", F.col("doc_id").desc_nulls_last(), "text")

    def run(batches):
        now, last, waiting = None, None, []

        def out():
            c = list(zip(*_compare(waiting)))
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, (_, k) in zip(c, _COLUMNS)], [n for n, _ in _COLUMNS])

        for b in batches:
            for at, guest, doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
                if at != now:
                    now, last = at, None
                if last is not None:
                    waiting.append((*last, text))
                last = None if guest else (doc_id, text)
                if len(waiting) >= 2000:
                    yield out()
                    waiting = []
        if waiting:
            yield out()

    return map_arrow(dealt, run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op7_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Contract query: fingerprints and likenesses of every document."""
    return edits_and_neighbours(documents(spark, sf_dir))
