"""Packing documents into sequences by non-negative least squares.

Tokenized documents are cut into full windows and one rest each.  Only the
histogram of rest lengths -- at most ``window`` numbers, counted over all rests
-- reaches the driver.  There every way to fill a window with two or three
lengths is enumerated; multiplicative updates solve the non-negative least
squares for the repeat counts of the combinations; rounding keeps them within
the histogram, and what is left is packed greedily: exact fills first, then end
to end, a piece cut where a window is full.  Only the last of those sequences
is padded.

Rests of one length are interchangeable, so the plan speaks of their ranks: a
two-level count (slots of a length, then rows of a slot) ranks all rests, and
each task reads a rest's sequence and offset off the plan.  A length that a
third of all documents share is spread over many slots.

Defined cases: a null or empty text is the end id alone; a null doc_id is kept;
repeated rows are packed each; rests of one length are placed in the order of
their row numbers, so ties cannot arise; a very long text is full windows and
one rest; columns beyond doc_id and text are not read; an empty table gives no
piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazrank.llm.common import documents, map_arrow, staged

WINDOW = 1024
VOCABULARY = "byte_bpe_50k.json"
END = 0
#: Rests that share a slot of the ranking, about.
SLOT_ROWS = 20_000
#: Bytes of ids that leave a task at a time, about.
BATCH_BYTES = 8 << 20
PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary"


def combinations(window: int) -> np.ndarray:
    """All pairs and triples of lengths (ascending; a pair begins with 0) that
    fill ``window``."""
    rows = [np.stack([np.zeros(window // 2, dtype=np.int64), a := np.arange(1, window // 2 + 1), window - a], axis=1)]
    for first in range(1, window // 3 + 1):
        second = np.arange(first, (window - first) // 2 + 1)
        rows.append(np.stack([np.full(len(second), first), second, window - first - second], axis=1))
    return np.concatenate(rows)


def repeat_counts(histogram: np.ndarray, combos: np.ndarray, rounds: int = 200) -> np.ndarray:
    """x >= 0 that minimises |A x - histogram|^2, A's columns being the
    combinations: multiplicative updates, which keep x non-negative."""
    h = histogram.astype(np.float64)
    h[0] = 0
    gather = lambda v: v[combos[:, 0]] + v[combos[:, 1]] + v[combos[:, 2]]
    top = gather(h)
    x = np.minimum.reduce([np.where(combos[:, k] > 0, h[combos[:, k]], np.inf) for k in range(3)])
    for _ in range(rounds):
        made = np.zeros_like(h)
        for k in range(3):
            made += np.bincount(combos[:, k], weights=x, minlength=len(h))
        made[0] = 0
        x *= top / np.maximum(gather(made), 1e-300)
    return x


class Plan:
    """Where the rests of each length go, by rank.

    For length l the ranks below ``upto[l]`` follow ``runs[l]``: (first rank,
    first sequence, offset), one more rank being one more sequence.  Higher
    ranks lie end to end on the tape from position ``tape[l]``.
    """

    def __init__(self, histogram: np.ndarray, window: int = WINDOW):
        self.window = window
        left = histogram.astype(np.int64).copy()
        left[0] = 0
        combos = combinations(window)
        combos = combos[np.all((combos == 0) | (left[combos] > 0), axis=1)]
        used: list[tuple[tuple[int, ...], int]] = []

        def take(combo, most):
            # how often the lengths of this combination are there
            need = np.unique([c for c in combo if c], return_counts=True)
            n = min([most, *(int(left[c]) // int(k) for c, k in zip(*need))])
            if n > 0:
                for c, k in zip(*need):
                    left[c] -= n * int(k)
                used.append((tuple(int(c) for c in combo if c), n))

        if len(combos):
            x = repeat_counts(left, combos)
            for i in np.argsort(-x, kind="stable"):
                if (n := int(np.rint(x[i]))) < 1:
                    break
                take(combos[i], n)
            for combo in combos[np.all((combos == 0) | (left[combos] > 0), axis=1)][::-1]:
                take(combo, int(left.max()))
        runs: dict[int, list[tuple[int, int, int]]] = {}
        rank, self.sequences = np.zeros(len(left), dtype=np.int64), 0
        for combo, n in used:
            offset = 0
            for c in sorted(combo, reverse=True):
                runs.setdefault(c, []).append((int(rank[c]), self.sequences, offset))
                rank[c] += n
                offset += c
            self.sequences += n
        self.upto = rank
        self.runs = {c: np.array(v, dtype=np.int64) for c, v in runs.items()}
        lengths = np.arange(len(left))
        self.tape = np.concatenate([[0], np.cumsum(left * lengths)])[:-1]
        self.tape_tokens = int((left * lengths).sum())
        self.first_full = self.sequences + -(-self.tape_tokens // window)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each rest."""
        sequence, offset = np.empty_like(rank), np.empty_like(rank)
        for c in np.unique(length):
            at = np.flatnonzero(length == c)
            r = rank[at]
            if c in self.runs:
                runs = self.runs[c]
                k = np.maximum(np.searchsorted(runs[:, 0], r, side="right") - 1, 0)
                sequence[at], offset[at] = runs[k, 1] + r - runs[k, 0], runs[k, 2]
            on = at[r >= self.upto[c]]
            place = self.tape[c] + (rank[on] - self.upto[c]) * c
            sequence[on], offset[on] = self.sequences + place // self.window, place % self.window
        return sequence, offset


def tokenize(docs: DataFrame, name: str = VOCABULARY, end: int = END, window: int = WINDOW) -> DataFrame:
    """All documents' pieces, staged: full windows and one rest.  ``uid``
    tells pieces apart (rows may repeat)."""

    def pieces(batches):
        from pyspark import TaskContext

        from hazrank.llm.tokens import encoded
        uid = TaskContext.get().partitionId() << 40

        def out(doc_ids, texts):
            """The pieces of some documents: their ids in one buffer, cut by
            offsets."""
            n = np.fromiter(map(len, texts), np.int64, len(texts)) // 4
            count = -(-n // window)
            doc = np.repeat(np.arange(len(n)), count)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * window
            offsets = 4 * np.append(np.repeat(np.cumsum(n) - n, count) + start, n.sum())
            number = pa.array(uid + np.arange(len(doc)))
            return pa.RecordBatch.from_arrays(
                [number, doc_ids.take(pa.array(doc)), pa.array(start), pa.array(np.minimum(window, n[doc] - start)), pa.array(n[doc]),
                 _cut(pa.py_buffer(b"".join(texts)), offsets)], ["uid", "doc_id", "start", "length", "doc_tokens", "ids"])

        for b in batches:
            held, size, first = [], 0, 0
            for k, ids in enumerate(encoded(b.column(1), name, True, end)):
                held.append(ids)
                size += len(ids)
                if size >= BATCH_BYTES or k == b.num_rows - 1:
                    r = out(b.column(0).slice(first, len(held)), held)
                    yield r
                    uid += r.num_rows
                    held, size, first = [], 0, k + 1

    out = map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), pieces, "uid long, " + PIECE)
    return staged(out, "zstd")


def _cut(data: pa.Buffer, offsets: np.ndarray) -> pa.Array:
    """Consecutive bytes of a buffer, cut at offsets, none copied."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), data])


def pack(docs: DataFrame, name: str = VOCABULARY, end: int = END, window: int = WINDOW, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Every piece of every document in its place: ``doc_id, start, length,
    doc_tokens, ids, sequence_id, offset``; ids little-endian unsigned 32 bit.
    The sequences are the pieces of one sequence_id by offset."""
    pieces = tokenize(docs, name, end, window)
    rest = pieces.filter(F.col("length") < window)
    counts = {r["length"]: r["n"] for r in rest.groupBy("length").agg(F.count("*").alias("n")).collect()}
    histogram = np.zeros(window + 1, dtype=np.int64)
    for k, n in counts.items():
        histogram[k] = n
    plan = Plan(histogram, window)
    slots = max(1, int(histogram.sum()) // slot_rows)

    slot = F.pmod(F.xxhash64("uid"), F.lit(slots)).alias("slot")
    base = rest.select("length", slot).groupBy("length", "slot").agg(F.count("*").alias("n"))
    base = base.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("slot")) - F.col("n")).drop("n")
    ranked = rest.select("*", slot).join(base, ["length", "slot"])
    ranked = ranked.withColumn("rank", F.col("base") + F.row_number().over(Window.partitionBy("length", "slot").orderBy("uid")) - 1)

    def placed(batches):
        for b in batches:
            if not b.num_rows:
                continue
            doc_id, start, length, total, ids, rank = b.columns
            start, length, total, rank = (c.to_numpy() for c in (start, length, total, rank))
            sequence, offset = plan.place(length, rank)
            head = np.minimum(length, plan.window - offset)
            # a row, and after it the rest that lies in the next sequence
            parts = 1 + (head < length)
            row = np.repeat(np.arange(len(parts)), parts)
            rest = np.diff(row, prepend=-1) == 0
            before = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
            cuts = np.append(before[row] + np.where(rest, 4 * head[row], 0), before[-1])
            yield pa.RecordBatch.from_arrays(
                [doc_id.take(pa.array(row)), pa.array(start[row] + np.where(rest, head[row], 0)), pa.array(np.where(rest, (length - head)[row], head[row])),
                 pa.array(total[row]), _cut(ids.buffers()[2], cuts), pa.array(sequence[row] + rest), pa.array(np.where(rest, 0, offset[row]))],
                ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"])

    short = map_arrow(ranked.select("doc_id", "start", "length", "doc_tokens", "ids", "rank"), placed,
                      PIECE + ", sequence_id long, offset long")
    full = pieces.filter(F.col("length") == window).select(
        "doc_id", "start", "length", "doc_tokens", "ids", (F.col("uid") + plan.first_full).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return short.unionByName(full)


def op3_pack(spark, sf_dir: str) -> DataFrame:
    """Contract query: every piece with the checksum of its ids."""
    return pack(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
