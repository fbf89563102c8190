"""Exact dedup with a cuckoo-filter index.

Texts are equal when identical after lower-casing A-Z.  Every row's whole text
is hashed to SHA-256; each task folds its own copies together (digest, largest
id, number of rows), so a group that holds a third of all rows sends one row
per task.  Digests are dealt to shards by their first bits, and each shard
runs one ``CuckooIndex``: a cuckoo filter over the live digests, and the
buckets of stored keys behind it.  A filter miss proves a digest new, and it
is inserted.  A hit is verified against the keys stored in that bucket -- the
whole digest and the text's length -- and then either supersedes the live
entry (the old one is deleted, the row with the larger id inserted) or is
counted to it.  An insertion that finds no place doubles the filter and refills
it from the stored keys.  The number of shards follows the number of rows, so
a shard's index has a bounded size.

Defined cases: a null text is empty; empty texts equal one another; a null
doc_id is smaller than any other; repeated rows are copies, of which one stays;
rows of one id and normalised text tie, and the text of smallest SHA-256 stays;
a very long text is hashed whole; columns beyond doc_id and text are carried
along in one struct, so their names cannot clash; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazrank.llm.common import documents, hot_join, keep_rows, map_arrow, ship_package, staged

#: Digests per shard, about.
SHARD_ROWS = 50_000
SLOTS = 4
KICKS = 500


class CuckooIndex:
    """A cuckoo filter (16-bit tags, four slots a bucket) over live keys, and
    the stored keys themselves by bucket.

    ``tags[b]`` holds the filter; ``stored[b]`` the (digest, length, value) of
    the keys whose tag lies in bucket ``b``.  Only a filter hit looks into
    ``stored``.
    """

    def __init__(self, expected: int = 1024):
        self.buckets = 1 << max(4, int(np.ceil(np.log2(max(1, expected) / (SLOTS * 0.9)))))
        self._clear()
        self.resizes = 0
        self.live = 0

    def _clear(self):
        self.tags = [[] for _ in range(self.buckets)]
        self.stored = [[] for _ in range(self.buckets)]

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[10:18], "little") & (self.buckets - 1)
        return tag, first, self._other(first, tag)

    def _other(self, bucket: int, tag: int) -> int:
        return (bucket ^ (tag * 0x5BD1E995)) & (self.buckets - 1)

    def _find(self, digest: bytes, length: int):
        tag, i, j = self._place(digest)
        for b in (i, j) if i != j else (i,):
            if tag in self.tags[b]:
                for k, (d, n, _) in enumerate(self.stored[b]):
                    if d == digest and n == length:
                        return b, k
        return None

    def get(self, digest: bytes, length: int):
        """The value stored with a live key, or None."""
        at = self._find(digest, length)
        return None if at is None else self.stored[at[0]][at[1]][2]

    def delete(self, digest: bytes, length: int):
        """Take a live key out of filter and store; its value, or None."""
        at = self._find(digest, length)
        if at is None:
            return None
        b, k = at
        del self.tags[b][k]
        self.live -= 1
        return self.stored[b].pop(k)[2]

    def insert(self, digest: bytes, length: int, value) -> None:
        if not self._insert((digest, length, value)):
            self._resize()
        self.live += 1

    def _insert(self, key) -> bool:
        """Place a key, kicking others to their second bucket.  False when it
        ran out of kicks; the key left over then waits in ``self.spare``."""
        tag, i, j = self._place(key[0])
        for b in (i, j):
            if len(self.tags[b]) < SLOTS:
                self.tags[b].append(tag)
                self.stored[b].append(key)
                return True
        b = i
        for kick in range(KICKS):
            slot = kick % SLOTS
            tag, self.tags[b][slot] = self.tags[b][slot], tag
            key, self.stored[b][slot] = self.stored[b][slot], key
            b = self._other(b, tag)
            if len(self.tags[b]) < SLOTS:
                self.tags[b].append(tag)
                self.stored[b].append(key)
                return True
        self.spare = key
        return False

    def _resize(self) -> None:
        """Double the filter and fill it again from the stored keys."""
        keys = [k for bucket in self.stored for k in bucket] + [self.spare]
        while True:
            self.buckets *= 2
            self.resizes += 1
            self._clear()
            if all(self._insert(k) for k in keys):
                return

    def keys(self):
        return [k for bucket in self.stored for k in bucket]


def normal(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased (``bytes.lower`` changes ASCII only)."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def _digests(batches):
    """Per row: its id, digest and length."""
    for b in batches:
        texts = [normal(t) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array([len(t) for t in texts], pa.int64())],
            ["doc_id", "digest", "length"])


def _index_shard(t: pa.Table) -> pa.Table:
    """Run a shard's pre-counted digests through its index."""
    index = CuckooIndex(t.num_rows)
    for digest, length, top, n in zip(*(t.column(c).to_pylist() for c in ("digest", "length", "top", "n"))):
        live = index.get(digest, length)
        if live is None:
            index.insert(digest, length, (top, n))
        else:
            index.delete(digest, length)
            ids = [x for x in (live[0], top) if x is not None]
            index.insert(digest, length, (max(ids, default=None), live[1] + n))
    keys = index.keys()
    return pa.table({"digest": pa.array([k[0] for k in keys], pa.binary()), "keep_id": pa.array([k[2][0] for k in keys], pa.int64()),
                     "group_size": pa.array([k[2][1] for k in keys], pa.int64())})


def groups(docs: DataFrame, shard_rows: int = SHARD_ROWS, text_keys: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): ``doc_id, digest, length`` of every row (and the text's
    own ``text_key``, if asked for), and ``digest, keep_id, group_size`` of
    every class of equal texts.  Texts are read once."""
    schema = "doc_id long, digest binary, length long" + (", text_key string" if text_keys else "")
    rows = staged(map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _both_keys if text_keys else _digests, schema))
    shards = max(1, rows.count() // shard_rows)
    # Partial counts of each task: the largest id and the number of rows of
    # its copies.  The task's number keeps them apart until the index, which
    # folds them together.
    part = rows.groupBy("digest", "length", F.spark_partition_id().alias("task")).agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards))
    ship_package(docs.sparkSession)
    found = part.withColumn("shard", shard).groupBy("shard").applyInArrow(_index_shard, "digest binary, keep_id long, group_size long")
    return rows, staged(found)


def exact_dedup(docs: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, digest``."""
    rows, found = groups(docs, shard_rows)
    out = hot_join(rows.select("doc_id", "digest"), found.withColumn("n", F.col("group_size")), "digest", "n")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class of equal texts, that of the largest
    doc_id.  Of rows that share id and normalised text, the text of smallest
    SHA-256 stays."""
    rows, found = groups(docs, text_keys=True)
    keyed = hot_join(rows, found.withColumn("n", F.col("group_size")), "digest", "n").filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    keys = keyed.groupBy("digest", "doc_id").agg(F.min("text_key").alias("text_key"), F.count("*").alias("n"))
    return keep_rows(docs, staged(keys.select("doc_id", "text_key", "n")))


def _both_keys(batches):
    """As ``_digests``, with the digest of the text as it is."""
    for b in batches:
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([hashlib.sha256(t.lower()).digest() for t in raw], pa.binary()), pa.array([len(t) for t in raw], pa.int64()),
             pa.array([hashlib.sha256(t).hexdigest() for t in raw], pa.string())],
            ["doc_id", "digest", "length", "text_key"])


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document with its class of equal texts."""
    d = exact_dedup(documents(spark, sf_dir))
    return d.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d
"""
