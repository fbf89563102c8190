"""Quality classifier by attention-based multiple-instance learning, in numpy.

A document is a bag of passages, ``PASSAGE`` consecutive words each, of which
only the whole bears a label.  A word has two hashed embeddings, of itself
(lower-cased) and of its shape (runs of capitals, small letters, digits and
signs).  A passage is the mean of its words' embeddings, with the share of words
that repeat the one before, through a layer of hyperbolic tangents; gated
attention -- the product of a hyperbolic tangent and a sigmoid of the passage,
weighted and passed through a softmax over the document's passages -- says how
much each passage counts, and a logistic unit scores the weighted sum of the
passages.  Embeddings, encoder, attention and output are trained together from
the document labels (Adam; plain steps for the embeddings), the first embedding
dimension starting from smoothed log odds of the word or shape.

The training sample is bounded: at most ``MOST_LOW`` and ``MOST_HIGH``
labelled rows (smallest hash of the id) of at most ``MOST_CHARS`` code points,
so at most 320 MB reach the driver.  The output's intercept is then moved by
the shares of both kinds among all labelled rows that may be learned from, so
that 0.5 means an even chance in the real shares.  Scoring is a map over whole
texts.

Defined cases: a null or empty text is one passage without words and gets a
score as any other; a null doc_id counts as held out and is not learned from;
of rows of one id the least text is learned from, every row is scored;
repeated rows get the same score; ties cannot arise, as each row has a score
of its own; a very long text is encoded a part at a time, over all its
passages; other columns pass through unread, and a new column whose name is
taken gets an underscore in front; without labels of both kinds every score is
0; an empty table gives no row.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from hazrank.llm.common import documents, map_arrow, table

#: Bounds of the training sample.
MOST_LOW = 2000
MOST_HIGH = 2000
MOST_CHARS = 20_000
#: Words of a passage.
PASSAGE = 64
BUCKETS = 1 << 16
PAD = BUCKETS
DIM = 12
HIDDEN = 16
GATES = 8
EPOCHS = 8
BATCH = 32
RATE = 0.01
#: A word counts this many texts of the average kind beside its own.
PRIOR = 10.0
#: Words encoded at a time, a multiple of PASSAGE.
PART = PASSAGE * 4096
#: Words whose buckets a worker keeps; beyond that the table starts anew.
TABLE_WORDS = 100_000
PIECE = 1 << 20
_CLASS = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUN = re.compile(rb"(?s)(.)\1+")
_TABLE: dict[bytes, tuple[int, int]] = {}


def shape(word: bytes) -> bytes:
    """Capitals, small letters (and all beyond ASCII), digits and signs of a
    word, each run of one kind as a single one."""
    return _RUN.sub(rb"\1", word.translate(_CLASS))


def buckets(text: str | None) -> np.ndarray:
    """Two buckets for each word of a text (n x 2): the word's and its
    shape's.  A text without words is one pad."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    parts, at = [], 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        words = raw[at:end].split()
        if len(_TABLE) > TABLE_WORDS:
            _TABLE.clear()
        for w in set(words).difference(_TABLE):
            _TABLE[w] = (zlib.crc32(w.lower()) % BUCKETS, zlib.crc32(shape(w), 1) % BUCKETS)
        if words:
            parts.append(np.array(list(map(_TABLE.__getitem__, words)), dtype=np.int32))
        at = end
    return np.concatenate(parts) if parts else np.full((1, 2), PAD, dtype=np.int32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class AttentionModel:
    """Passage encoder, gated attention over passages, and logistic output."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.emb = np.zeros((BUCKETS + 1, DIM))
        self.emb[:BUCKETS] = rng.normal(0, 0.05, (BUCKETS, DIM))
        self.p = {"W": rng.normal(0, 0.3, (DIM + 1, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, GATES)),
                  "U": rng.normal(0, 0.3, (HIDDEN, GATES)), "w": rng.normal(0, 0.3, GATES), "c": rng.normal(0, 0.3, HIDDEN), "d": np.zeros(1)}
        self.trained = False

    def start_from(self, texts: list[np.ndarray], y: np.ndarray) -> None:
        """Log odds into the first dimension, which the first unit reads."""
        df = np.zeros((2, BUCKETS + 1))
        for t, label in zip(texts, y):
            df[int(label), np.unique(t)] += 1
        base = y.mean()
        self.emb[:BUCKETS, 0] = (np.log((df[1] + base * PRIOR) / (df[0] + (1 - base) * PRIOR)) - np.log(base / (1 - base)))[:BUCKETS]
        self.p["W"][0], self.p["W"][:, 0] = 0, 0
        self.p["W"][0, 0] = 1
        self.p["c"][0] = 2

    def means(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The mean embedding of every passage with its share of repeated
        words, and each text's number of passages.  At most PART words are
        looked up at a time."""
        out, count = [], np.array([-(-len(t) // PASSAGE) for t in texts], dtype=np.int64)
        held, size = [], 0

        def close():
            ids = np.concatenate(held)
            length = np.concatenate([np.minimum(PASSAGE, len(h) - np.arange(0, len(h), PASSAGE)) for h in held])
            x = np.empty((len(ids), DIM + 1))
            x[:, :DIM] = self.emb[ids[:, 0]]
            x[:, :DIM] += self.emb[ids[:, 1]]
            x[:, DIM] = np.concatenate([np.diff(h[:, 0], prepend=-1) == 0 for h in held])
            out.append(np.add.reduceat(x, np.cumsum(length) - length, axis=0) / length[:, None])

        for t in texts:
            for a in range(0, len(t), PART):
                part = t[a:a + PART]
                if held and size + len(part) > PART:
                    close()
                    held, size = [], 0
                held.append(part)
                size += len(part)
        if held:
            close()
        return np.concatenate(out) if out else np.zeros((0, DIM + 1)), count

    def forward(self, x: np.ndarray, count: np.ndarray) -> dict:
        """Logits of texts of ``count`` passages each, with all that leads to
        them."""
        p, starts = self.p, np.cumsum(count) - count
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
        s = (t * g) @ p["w"]
        e = np.exp(s - np.repeat(np.maximum.reduceat(s, starts), count))
        a = e / np.repeat(np.add.reduceat(e, starts), count)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "starts": starts, "logit": z @ p["c"] + p["d"][0]}

    def gradients(self, f: dict, count: np.ndarray, d: np.ndarray) -> tuple[dict, np.ndarray]:
        """Of parameters and of passage means, ``d`` being that of the logits."""
        p, h, t, g, a = self.p, f["h"], f["t"], f["g"], f["a"]
        dz = np.repeat(d, count)[:, None] * p["c"]
        da = (dz * h).sum(axis=1)
        ds = a * (da - np.repeat(np.add.reduceat(a * da, f["starts"]), count))
        dt = ds[:, None] * p["w"] * g * (1 - t * t)
        dg = ds[:, None] * p["w"] * t * g * (1 - g)
        dh = a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
        pre = dh * (1 - h * h)
        return {"W": f["x"].T @ pre, "b": pre.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ ds, "c": f["z"].T @ d, "d": np.array([d.sum()])}, pre @ p["W"].T

    def train(self, texts: list[np.ndarray], y: np.ndarray, seed: int = 11) -> None:
        self.start_from(texts, y)
        rng, steps = np.random.default_rng(seed), 0
        state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        for _ in range(EPOCHS):
            for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
                steps += 1
                held = [texts[i] for i in part]
                x, count = self.means(held)
                f = self.forward(x, count)
                grads, dx = self.gradients(f, count, (sigmoid(f["logit"]) - y[part]) / len(part))
                for k, v in grads.items():
                    v = v + 1e-3 * self.p[k] / len(part)
                    m, s = state[k]
                    m, s = 0.9 * m + 0.1 * v, 0.999 * s + 0.001 * v * v
                    state[k] = (m, s)
                    self.p[k] = self.p[k] - RATE * (m / (1 - 0.9 ** steps)) / (np.sqrt(s / (1 - 0.999 ** steps)) + 1e-8)
                ids = np.concatenate(held)
                length = np.concatenate([np.minimum(PASSAGE, len(t) - np.arange(0, len(t), PASSAGE)) for t in held])
                step = np.repeat(-RATE * 20 * dx[:, :DIM] / length[:, None], length, axis=0)
                for col in range(2):
                    np.add.at(self.emb, ids[:, col], step)
                self.emb[PAD] = 0
        self.trained = True

    def shift_to(self, sampled: float, real: float) -> None:
        """Move the intercept from the sample's share to the real share."""
        odds = lambda s: np.log(s / (1 - s))
        self.p["d"] = self.p["d"] + odds(real) - odds(sampled)

    def scores(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: score, number of passages, the passage of most attention
        (the first of equal ones) and its weight."""
        x, count = self.means(texts)
        if not len(texts):
            return np.zeros(0), count, count, np.zeros(0)
        f = self.forward(x, count)
        top = np.maximum.reduceat(f["a"], f["starts"])
        at = np.flatnonzero(f["a"] == np.repeat(top, count))
        text = np.repeat(np.arange(len(texts)), count)[at]
        first = at[np.flatnonzero(np.diff(text, prepend=-1))] - f["starts"]
        return (sigmoid(f["logit"]) if self.trained else np.zeros(len(texts))), count, first, top


def fold(doc_id: Column) -> Column:
    """crc32 of the id modulo 3; rows of remainder 1 are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(1))


def _sample_words(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([buckets(t.as_py()).tobytes() for t in b.column(1)], pa.binary())], ["quality", "ids"])


def fit(docs: DataFrame, labels: DataFrame, most_low: int = MOST_LOW, most_high: int = MOST_HIGH) -> AttentionModel:
    """Train on a bounded sample of the labelled rows that are not held out."""
    known = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    learning = known.filter(fold(F.col("doc_id")) != 1).withColumn("order", F.xxhash64("doc_id"))
    real = learning.agg(F.avg("quality")).first()[0]
    chosen = learning.filter("quality = 0").orderBy("order", "doc_id").limit(most_low).unionByName(
        learning.filter("quality = 1").orderBy("order", "doc_id").limit(most_high))
    rows = docs.select("doc_id", "text").filter(F.length("text") <= MOST_CHARS)
    # at most most_low + most_high rows of two numbers
    rows = rows.join(F.broadcast(chosen.select("doc_id", "quality")), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    got = map_arrow(rows.select(F.col("quality").cast("int"), "text"), _sample_words, "quality int, ids binary").collect()
    got.sort(key=lambda r: (r["quality"], zlib.crc32(r["ids"]), bytes(r["ids"])))
    texts = [np.frombuffer(r["ids"], dtype=np.int32).reshape(-1, 2) for r in got]
    y = np.array([r["quality"] for r in got], dtype=np.float64)
    model = AttentionModel()
    if len(y) and 0 < y.mean() < 1:
        model.train(texts, y)
        model.shift_to(y.mean(), real)
    return model


def score_column(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """``docs`` with ``score``, ``passages``, ``top_passage`` (the one of most
    attention, counted from 0) and ``top_weight``.  The model's size is fixed,
    so every task gets it by broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    names = ["score", "passages", "top_passage", "top_weight"]
    for k, name in enumerate(names):
        while name in docs.columns:
            name = "_" + name
        names[k] = name

    def run(batches):
        for b in batches:
            found, held, size = [], [], 0
            for t in b.column(at):
                held.append(buckets(t.as_py()))
                size += len(held[-1])
                if size >= PART:
                    found.append(shared.value.scores(held))
                    held, size = [], 0
            found.append(shared.value.scores(held))
            new = [pa.array(np.concatenate(c)) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, *names])

    kinds = (DoubleType(), LongType(), LongType(), DoubleType())
    return map_arrow(docs, run, StructType([*docs.schema.fields, *(StructField(n, k) for n, k in zip(names, kinds))]))


def op13_quality(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document's score."""
    docs = documents(spark, sf_dir)
    d = score_column(docs.select("doc_id", "text"), fit(docs, table(spark, sf_dir, "labels")))
    return d.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                    "passages", "top_passage", "top_weight")
