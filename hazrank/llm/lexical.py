"""Ranked lexical search with Block-Max MaxScore.

Every task cuts the documents of its input into segments (at most
``SEGMENT_DOCS`` documents, about ``SEGMENT_TERMS`` terms) and inverts each in
numpy; texts are never shuffled.  A row of the index is a term's list in a
segment: blocks of ``BLOCK`` postings, each with its last document, where its
bytes end, and its skyline -- the (tf, length) pairs that no other posting of
the block beats in both.  A posting's impact grows with tf and falls with the
length whatever the corpus statistics are, so the greatest impact over the
skyline is the exact block maximum for any statistics, and segments need not
be written again when documents are added.  The postings themselves are
variable-length bytes that only a decompressed block costs.

A search takes the queries in blocks of bounded size.  Terms' document
frequencies are summed over the index, the lists of the block's terms meet by
segment, and each segment runs every query: lists in the order of their global
bound (the greatest of their block maxima); the longest prefix of lists whose
bounds together stay at or below the heap's threshold is non-essential.
Documents come from the essential lists, in windows of consecutive documents;
against each non-essential list, greatest bound first, a candidate goes when
its score so far, the maximum of the block that would hold it and the bounds
of the lists left cannot pass the threshold, and only blocks that still have
candidates are decompressed.  The shards' heaps are merged by rank within the
query, first in each task, then over all.

Scores are integers (see ``search``), so results do not depend on the order
of work.

Defined cases: a null text or one without terms has no postings; a null doc_id
ranks after all others of its score; rows of one id, or repeated rows, are
documents each; equal scores go by ascending doc_id; a null query text has no
result; a query may repeat terms, repeats count; a very long text is split a
million bytes at a time and may fill a segment alone; columns beyond doc_id
and text are not read; empty tables give no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazrank.llm.common import documents, map_arrow, ship_package, staged, table

TOP = 10
BLOCK = 64
SEGMENT_DOCS = 8192
SEGMENT_TERMS = 2_000_000
#: Documents of a window of candidates.
WINDOW = 2048
#: Queries searched (and broadcast) at a time, and their distinct terms.
QUERIES = 1000
QUERY_TERMS = 500_000
PIECE = 1 << 20
#: Bytes of terms: ASCII letters and digits, A-Z lower-cased, and all of code
#: points beyond ASCII; every other byte ends a term.
_TERM = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256)).lower()

INDEX = "seg long, term binary, df int, docs long, terms long, head binary, sky binary, data binary"


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_TERM)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


class _Numbers(dict):
    """Numbers of terms in the order of their first use."""

    def __missing__(self, term):
        self[term] = n = len(self)
        return n


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-length bytes of unsigned values, seven bits each and the high
    bit on all but a value's last byte; and the number of bytes of each."""
    v = values.astype(np.uint64)
    size = 1 + sum((v >= np.uint64(1) << np.uint64(7 * k)).astype(np.int64) for k in range(1, 5))
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for k in range(5):
        there = size > k
        more = (size[there] > k + 1).astype(np.uint8) << 7
        out[ends[there] - size[there] + k] = ((v[there] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more
    return out, size


def decode(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)


class Segment:
    """Documents gathered for one segment of the index."""

    def __init__(self):
        self.numbers = _Numbers()
        self.ids: list = []
        self.words: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        parts = [np.fromiter(map(self.numbers.__getitem__, w), np.int64, len(w)) for w in terms_of(text)]
        self.ids.append(doc_id)
        self.words.append(np.concatenate(parts) if parts else np.zeros(0, np.int64))
        self.lengths.append(len(self.words[-1]))
        self.size += self.lengths[-1]

    def full(self) -> bool:
        return len(self.ids) >= SEGMENT_DOCS or self.size >= SEGMENT_TERMS

    def rows(self, seg: int) -> pa.RecordBatch:
        """The segment's rows of the index: its documents (under the empty
        term), then a list each for its terms."""
        n = len(self.ids)
        known = np.array([d is not None for d in self.ids], dtype=bool)
        ids = np.array([0 if d is None else d for d in self.ids], dtype=np.int64)
        order = np.lexsort((ids, ~known))  # ascending, null last
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        lengths = np.array(self.lengths, dtype=np.int64)
        keys = np.concatenate(self.words) * n + np.repeat(rank, lengths)
        keys.sort()
        first = np.flatnonzero(np.diff(keys, prepend=-1))  # of each posting
        tf = np.diff(first, append=len(keys))
        term, doc = np.divmod(keys[first], n)
        length = lengths[order]

        lists = np.flatnonzero(np.diff(term, prepend=-1))
        df = np.diff(lists, append=len(term))
        place = np.arange(len(term)) - np.repeat(lists, df)
        starts = np.flatnonzero(place % BLOCK == 0)  # of each block
        ends = np.append(starts[1:], len(term)) if len(starts) else starts
        before = np.concatenate([[0], doc[:-1]]) if len(doc) else doc
        before[starts] = 0
        data, size = encode(np.stack([doc - before, tf - 1], axis=1).reshape(-1))
        upto = np.concatenate([[0], np.cumsum(size.reshape(-1, 2).sum(axis=1))]).astype(np.int64)

        # skyline: by falling tf, a posting counts if shorter than all before it
        block = np.repeat(np.arange(len(starts)), ends - starts)
        by = np.lexsort((length[doc], -tf, block))
        low = np.minimum.accumulate(length[doc][by] + (len(starts) - block[by]) * (int(length.max(initial=0)) + 1)) if len(by) else by
        new = np.flatnonzero(np.diff(low, prepend=np.iinfo(np.int64).max))
        sky = np.stack([tf[by][new], length[doc][by][new]], axis=1).astype("<u4")
        sky_ends = np.cumsum(np.bincount(block[by][new], minlength=len(starts)))

        # per list: (last document, end of bytes, end of skyline) of its blocks
        of = np.flatnonzero(place[starts] == 0) if len(starts) else starts  # the first block of each list
        blocks = np.diff(of, append=len(starts))
        list_bytes = upto[lists]
        list_sky = np.concatenate([[0], sky_ends])[of] if len(of) else of
        head = np.stack([doc[ends - 1], upto[ends] - np.repeat(list_bytes, blocks), sky_ends - np.repeat(list_sky, blocks)], axis=1).astype("<u4") if len(of) else np.zeros((0, 3), "<u4")

        names = list(self.numbers)
        cut = lambda flat, at: _binary(flat, np.append(at, flat.nbytes))
        docs_row = np.concatenate([known[order].astype("<i8"), ids[order]]).tobytes()
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(lists) + 1, seg)), pa.array([b""] + [names[t] for t in term[lists]], pa.binary()),
            pa.array(np.append(0, df).astype(np.int32)), pa.array([int((lengths > 0).sum())] + [None] * len(lists), pa.int64()),
            pa.array([int(lengths.sum())] + [None] * len(lists), pa.int64()),
            _with_first(length.astype("<u4").tobytes(), cut(head, of * 12)),
            _with_first(b"", cut(sky, list_sky * 8)), _with_first(docs_row, cut(data, list_bytes))],
            ["seg", "term", "df", "docs", "terms", "head", "sky", "data"])


def _binary(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Consecutive bytes of ``flat``, cut at ``offsets``."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])


def _with_first(first: bytes, rest: pa.Array) -> pa.Array:
    return pa.concat_arrays([pa.array([first], pa.binary()), rest])


def build_index(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (all terms of all rows), staged."""
    def run(batches):
        from pyspark import TaskContext
        seg, held = TaskContext.get().partitionId() << 32, Segment()
        for b in batches:
            for d, t in zip(b.column(0), b.column(1)):
                held.add(d.as_py(), t.as_py())
                if held.full():
                    yield held.rows(seg)
                    seg, held = seg + 1, Segment()
        if held.ids:
            yield held.rows(seg)

    return staged(map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, INDEX), "zstd")


class Postings:
    """A term's list in a segment; blocks are decompressed when asked for."""

    def __init__(self, df: int, head: bytes, sky: bytes, data: bytes, m_of, m: np.ndarray):
        head = np.frombuffer(head, "<u4").reshape(-1, 3).astype(np.int64)
        self.last, self.ends = head[:, 0], head[:, 1]
        self.begins = np.concatenate([[0], self.ends[:-1]])
        sky = np.frombuffer(sky, "<u4").reshape(-1, 2).astype(np.int64)
        impact = impacts(sky[:, 0], m_of(sky[:, 1]))
        self.most = np.maximum.reduceat(impact, np.concatenate([[0], head[:-1, 2]]))
        self.bound = int(self.most.max())
        self.data, self.m = np.frombuffer(data, np.uint8), m
        self.at = np.minimum(np.arange(len(head) + 1) * BLOCK, df)
        # until a block is there, its places hold its last document
        self.docs = np.repeat(self.last, np.diff(self.at))
        self.impact = np.zeros(df, np.int64)
        self.there = np.zeros(len(head), bool)

    def load(self, blocks: np.ndarray) -> None:
        """Decompress those of ``blocks`` (ascending) that are not there yet."""
        blocks = blocks[~self.there[blocks]]
        if not len(blocks):
            return
        if len(blocks) == blocks[-1] - blocks[0] + 1:
            raw = self.data[self.begins[blocks[0]]:self.ends[blocks[-1]]]
        else:
            raw = np.concatenate([self.data[self.begins[k]:self.ends[k]] for k in blocks])
        values = decode(raw)
        count = self.at[blocks + 1] - self.at[blocks]
        start = np.cumsum(count) - count
        total = np.cumsum(values[0::2])
        docs = total - np.repeat(np.concatenate([[0], total[start[1:] - 1]]), count)
        place = np.repeat(self.at[blocks] - start, count) + np.arange(len(docs))
        self.docs[place] = docs
        self.impact[place] = impacts(values[1::2] + 1, self.m[docs])
        self.there[blocks] = True


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def norms(n_docs: int, n_terms: int):
    """A document's m by its length, in whole numbers of any size."""
    def m_of(length: np.ndarray) -> np.ndarray:
        if len(length) and 75 * int(length.max()) * n_docs < 1 << 62:
            return 25 + (75 * length * n_docs) // max(n_terms, 1)
        return np.array([25 + (75 * int(x) * n_docs) // max(n_terms, 1) for x in length], dtype=np.int64)
    return m_of


def top_of(weighted: list[tuple[int, Postings]], n: int, k: int = TOP, window: int = WINDOW, seen: dict | None = None) -> list[tuple[int, int]]:
    """The ``k`` best of documents 0 to ``n`` - 1 as (document, score), best
    first, equal scores by ascending document.  ``weighted``: a weight and a
    list for each distinct term.  ``seen`` counts candidates that block maxima
    rejected."""
    weighted = sorted(((w, p) for w, p in weighted if w > 0), key=lambda x: x[0] * x[1].bound)
    sums = np.cumsum([0] + [w * p.bound for w, p in weighted])  # of the lists before
    score, doc, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for a in range(0, n, window):
        b = min(a + window, n)
        cut = int(np.searchsorted(sums, least, side="right")) - 1  # lists before it are non-essential
        if cut == len(weighted):
            break
        acc = np.zeros(b - a, np.int64)
        for w, p in weighted[cut:]:
            lo, hi = np.searchsorted(p.last, (a, b - 1))
            p.load(np.arange(lo, min(hi + 1, len(p.last))))
            i, j = np.searchsorted(p.docs, (a, b))
            acc[p.docs[i:j] - a] += w * p.impact[i:j]
        found = np.flatnonzero(acc)
        acc = acc[found]
        found = found + a
        for j in range(cut - 1, -1, -1):
            w, p = weighted[j]
            block = np.searchsorted(p.last, found)
            inside = block < len(p.last)
            most = np.zeros(len(found), np.int64)
            most[inside] = w * p.most[block[inside]]
            alive = acc + most + sums[j] > least
            if seen is not None:
                seen["rejected"] = seen.get("rejected", 0) + int((~alive).sum())
            found, acc, block, inside = found[alive], acc[alive], block[alive], inside[alive]
            if not inside.any():
                continue
            p.load(np.unique(block[inside]))
            at = np.minimum(np.searchsorted(p.docs, found), len(p.docs) - 1)
            hit = p.docs[at] == found
            acc[hit] += w * p.impact[at[hit]]
        good = acc > least
        score, doc = np.concatenate([score, acc[good]]), np.concatenate([doc, found[good]])
        best = np.lexsort((doc, -score))[:k]
        score, doc = score[best], doc[best]
        if len(score) == k:
            least = int(score[-1])
    return list(zip(doc.tolist(), score.tolist()))


def _blocks_of(queries: DataFrame) -> Iterator[list[tuple]]:
    """The queries (id, {term: times}) in blocks of bounded size."""
    held, size = [], 0
    for r in queries.toLocalIterator():
        counts: dict[bytes, int] = {}
        for part in terms_of(r[1]):
            for t in part:
                counts[t] = counts.get(t, 0) + 1
        held.append((r[0], counts))
        size += len(counts)
        if len(held) >= QUERIES or size >= QUERY_TERMS:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(index: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of each of
    ``queries`` (``item_id, text``; rows of one id and text are one query).

    With N documents of L terms, a term of document frequency df weighs
    w = floor(1000 ln((2N + 2) / (2df + 1))); a document of n terms has
    m = 25 + (75 n N) div L; its score sums w (10^9 tf div (1000 tf + 8 m))
    over the query's terms.
    """
    spark = index.sparkSession
    ship_package(spark)
    stats = index.filter(F.length("term") == 0).agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = stats[0] or 0, stats[1] or 0
    schema = "query int, doc_id long, score long"
    out = []
    for block in _blocks_of(queries.select("item_id", "text").distinct()):
        # of bounded size: the distinct terms of a block of queries
        terms = F.broadcast(spark.createDataFrame([(bytearray(t),) for t in {t for _, c in block for t in c}], "term binary"))
        df = {bytes(r[0]): r[1] for r in index.join(terms, "term").groupBy("term").agg(F.sum(F.col("df").cast("long"))).collect()}
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
        shared = spark.sparkContext.broadcast([{t: n * weight[t] for t, n in c.items() if t in weight} for _, c in block])

        def run(part: pa.Table) -> pa.Table:
            m_of = norms(n_docs, n_terms)
            rows = list(zip(*(part.column(c).to_pylist() for c in ("term", "df", "head", "sky", "data"))))
            first = next(r for r in rows if r[0] == b"")
            m = m_of(np.frombuffer(first[2], "<u4").astype(np.int64))
            known, ids = np.frombuffer(first[4], "<i8").reshape(2, -1)
            lists = {r[0]: Postings(*r[1:], m_of, m) for r in rows if r[0]}
            found = []
            for q, weights in enumerate(shared.value):
                found += [(q, int(ids[d]) if known[d] else None, s) for d, s in top_of([(w, lists[t]) for t, w in weights.items() if t in lists], len(m), k)]
            return pa.table({c: pa.array(v, kind) for c, v, kind in zip(("query", "doc_id", "score"), zip(*found) if found else ((), (), ()), (pa.int32(), pa.int64(), pa.int64()))})

        lists = index.select("seg", "term", "df", "head", "sky", "data")
        wanted = lists.join(terms, "term", "left_semi").unionByName(lists.filter(F.length("term") == 0))
        heaps = staged(wanted.groupBy("seg").applyInArrow(run, schema))
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        merged = heaps.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        items = spark.createDataFrame([(q, x) for q, (x, _) in enumerate(block)], f"query int, item_id {queries.schema['item_id'].dataType.simpleString()}")
        out.append(merged.join(F.broadcast(items), "query").select("item_id", "rank", "doc_id", "score"))
    if not out:
        return spark.createDataFrame([], f"item_id {queries.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    while len(out) > 1:  # a tree of unions, not a chain
        it = iter(out)
        out = [a[0] if len(a) == 1 else a[0].unionByName(a[1]) for a in iter(lambda: list(islice(it, 2)), [])]
    return out[0]


def op11_search(spark, sf_dir: str) -> DataFrame:
    """Contract query: the ten best documents of each benchmark item."""
    return search(build_index(documents(spark, sf_dir)), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
stats AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf JOIN stats ON true WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
scores AS (
  SELECT a.item_id, t.doc_id, CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + (75 * l.n * s.docs) // s.terms)))) AS BIGINT) AS score
  FROM asked a JOIN weights w ON w.term = a.term JOIN tf t ON t.term = a.term JOIN lengths l ON l.doc_id = t.doc_id JOIN stats s ON true
  GROUP BY a.item_id, t.doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
