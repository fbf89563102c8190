"""Toxicity: a convolutional text classifier in numpy.

Every word is the sum of two hashed embeddings, of the word and of its first
four bytes.  Filters of widths one, two and three slide over the words, a
rectifier and a maximum over the whole text follow, and a logistic unit scores
the pooled features.  The first embedding dimension starts from smoothed log
odds of the word (or beginning) among the training texts, and one filter of
each width starts by reading it; everything is then trained by Adam, the
gradient passing through the maxima.

Thresholds are calibrated by language, the language being guessed from the
text by its function words (the ``lang`` column is never read): on all labelled
rows set aside for it, in their real shares, each language's threshold
maximises F1, and scores are shifted so that it lies at 0.5.

The weights are trained on a bounded sample: at most ``MOST_POSITIVE`` and
``MOST_NEGATIVE`` labelled rows (smallest hash of the id) of at most
``MOST_CHARS`` code points, so at most 432 MB reach the driver.  Calibration
and scoring are maps over all their rows and whole texts; of calibration, counts
per language and step of the logit (``STEPS`` a unit) reach the driver, so a
threshold lies between steps.

Defined cases: a null or empty text gets the score of a text without words; a
null doc_id counts as held out; repeated rows get the same score; among
thresholds of equal F1 the highest is taken; a very long text is pooled in
parts; other columns are carried along in one struct (``clean``) or as they are
(``score_column``, whose new column gets the name it is told); without labels of
both kinds every score is 0; an empty table gives no row.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from hazrank.llm.common import documents, map_arrow, table

#: Bounds of the training sample.
MOST_POSITIVE = 3000
MOST_NEGATIVE = 6000
MOST_CHARS = 12_000
#: Steps of a logit in which calibration rows are counted; those beyond FAR
#: are one step, so the counts are bounded.
STEPS = 1024
FAR = 32
BUCKETS = 1 << 17
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PAD = BUCKETS
#: Words whose buckets a worker keeps; beyond that the table starts anew.
TABLE_WORDS = 100_000
EPOCHS = 5
#: A word counts this many texts of the average kind beside its own.
PRIOR = 15.0
#: Function words by which a text's language is guessed.
FUNCTION_WORDS = {
    "en": "the and of to in that is for with this from are was you what which",
    "de": "der die das und ein eine nicht mit von ist sich den auf für im zu auch schein",
    "fr": "le les des une un est que qui dans pour et du au sur avec",
    "es": "el los las una un que es por para con y se del no",
}
_BLANK = bytes(range(256)).translate(bytes(32 if chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else c for c in range(256)))
_TABLE: dict[bytes, tuple[int, int]] = {}


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_BLANK).split()


def buckets(words: list[bytes]) -> np.ndarray:
    """Two buckets a word (n x 2): the word's, and its first four bytes'."""
    if len(_TABLE) > TABLE_WORDS:
        _TABLE.clear()
    for w in set(words).difference(_TABLE):
        _TABLE[w] = (zlib.crc32(w) % BUCKETS, zlib.crc32(b"\0" + w[:4]) % BUCKETS)
    return np.array(list(map(_TABLE.__getitem__, words)), dtype=np.int32).reshape(-1, 2)


def language_table() -> np.ndarray:
    """Per bucket the language whose function word it is, counted from 1."""
    out = np.zeros(BUCKETS + 1, dtype=np.int8)
    for k, words in enumerate(FUNCTION_WORDS.values()):
        for w in words.split():
            out[zlib.crc32(w.encode()) % BUCKETS] = k + 1
    return out


def layout(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' buckets in a row, with padding between them, and each
    text's first place.  A text has its words and one pad at least."""
    gap = np.full((max(WIDTHS), 2), PAD, dtype=np.int32)
    parts, starts, at = [], [], 0
    for t in texts:
        starts.append(at)
        parts += [t, gap]
        at += len(t) + len(gap)
    return np.concatenate(parts) if parts else np.zeros((0, 2), np.int32), np.array(starts, dtype=np.int64)


class Classifier:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.emb = np.zeros((BUCKETS + 1, DIM), dtype=np.float32)
        self.emb[:BUCKETS] = rng.normal(0, 0.05, (BUCKETS, DIM))
        self.conv = {w: rng.normal(0, 0.15, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, dtype=np.float32) for w in WIDTHS}
        self.out = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.out_bias = np.float32(0)
        self.shift = np.zeros(len(FUNCTION_WORDS) + 1)
        self.trained = False

    def start_from(self, texts: list[np.ndarray], y: np.ndarray) -> None:
        """Log odds into the first dimension; a filter of each width reads it."""
        df = np.zeros((2, BUCKETS))
        for t, label in zip(texts, y):
            df[int(label), np.unique(t)] += 1
        base = y.mean()
        odds = np.log((df[1] + base * PRIOR) / (df[0] + (1 - base) * PRIOR)) - np.log(base / (1 - base))
        self.emb[:BUCKETS, 0] = odds
        for k, w in enumerate(WIDTHS):
            self.conv[w][:, :, 0] = 0
            self.conv[w][:, 0, 0] = 1 / w
            self.out[k * FILTERS] = 1
        self.out_bias = np.float32(np.log(base / (1 - base)) - 2)

    def _maps(self, x: np.ndarray, w: int) -> np.ndarray:
        n = len(x) - max(WIDTHS) + 1
        return sum(x[j:j + n] @ self.conv[w][j] for j in range(w)) + self.bias[w]

    def logits(self, texts: list[np.ndarray], step: int = 400_000) -> np.ndarray:
        """One logit a text; ``step`` bounds the words held at a time (a
        longer text is pooled in overlapping parts)."""
        pooled = np.zeros((len(texts), len(WIDTHS) * FILTERS), dtype=np.float32)
        group, size = [], 0
        for k, t in enumerate(texts):
            if len(t) > step:
                for a in range(0, len(t), step):
                    part = self._pool([t[a:a + step + max(WIDTHS) - 1]])
                    pooled[k] = np.maximum(pooled[k], part[0])
                continue
            if group and size + len(t) > step:
                pooled[group] = self._pool([texts[g] for g in group])
                group, size = [], 0
            group.append(k)
            size += len(t)
        if group:
            pooled[group] = self._pool([texts[g] for g in group])
        return pooled @ self.out + self.out_bias

    def _pool(self, texts: list[np.ndarray]) -> np.ndarray:
        ids, starts = layout(texts)
        x = self.emb[ids[:, 0]] + self.emb[ids[:, 1]]
        return np.concatenate([np.maximum(np.maximum.reduceat(self._maps(x, w), starts, axis=0), 0) for w in WIDTHS], axis=1)

    def train(self, texts: list[np.ndarray], y: np.ndarray, seed: int = 11, batch: int = 64, rate: float = 0.004) -> None:
        self.start_from(texts, y)
        rng = np.random.default_rng(seed)
        weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) ** 0.5
        state: dict = {}
        steps = 0
        for _ in range(EPOCHS):
            for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // batch)):
                steps += 1
                self._step([texts[i] for i in part], y[part], weight[part], rate, state, steps)
        self.trained = True

    def _step(self, texts, y, weight, rate, state, t):
        ids, starts = layout(texts)
        x = self.emb[ids[:, 0]] + self.emb[ids[:, 1]]
        ends = np.append(starts[1:], len(ids) - max(WIDTHS) + 1)
        feats, where = [], []
        for w in WIDTHS:
            maps = self._maps(x, w)
            at = np.stack([a + maps[a:b].argmax(axis=0) for a, b in zip(starts, ends)])
            feats.append(np.maximum(maps[at, np.arange(FILTERS)], 0))
            where.append(at)
        f = np.concatenate(feats, axis=1)
        p = 1 / (1 + np.exp(-np.clip(f @ self.out + self.out_bias, -30, 30)))
        d = ((p - y) * weight / len(y)).astype(np.float32)
        df = d[:, None] * self.out * (f > 0)
        grads = {("out",): f.T @ d + 1e-4 * self.out, ("out_bias",): d.sum()}
        touched, dx = [], []
        for k, w in enumerate(WIDTHS):
            g, at = df[:, k * FILTERS:(k + 1) * FILTERS], where[k]
            gc = np.zeros_like(self.conv[w])
            for j in range(w):
                rows = x[at + j]
                gc[j] = np.einsum("bfd,bf->df", rows, g)
                dx.append((g[:, :, None] * self.conv[w][j].T[None]).reshape(-1, DIM))
                touched.append((at + j).reshape(-1))
            grads["conv", w], grads["bias", w] = gc, g.sum(axis=0)
        for key, g in grads.items():
            holder = getattr(self, key[0])
            value = holder[key[1]] if len(key) > 1 else holder
            m, v = state.get(key, (0, 0))
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            state[key] = (m, v)
            new = (value - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
            if len(key) > 1:
                holder[key[1]] = new
            else:
                setattr(self, key[0], new)
        place, grad = np.concatenate(touched), np.concatenate(dx)
        for col in range(2):
            np.add.at(self.emb, ids[place, col], -rate * 10 * grad)
        self.emb[PAD] = 0

    def languages(self, texts: list[np.ndarray]) -> np.ndarray:
        known = language_table()
        n = len(FUNCTION_WORDS)
        return np.array([c.argmax() + 1 if (c := np.bincount(known[t[:, 0]], minlength=n + 1)[1:]).any() else 0 for t in texts], dtype=np.int64)

    def calibrate(self, counts: np.ndarray) -> None:
        """Per guessed language the threshold of highest F1, halfway to the
        next lower logit; with fewer than ten rows of a kind, that of all.
        ``counts``: language, step, rows, toxic rows, least and greatest logit."""
        def best(c):
            c = c[np.argsort(-c[:, 1], kind="stable")]
            at = np.flatnonzero(np.diff(c[:, 1], prepend=np.inf))
            n, hit = (np.cumsum(np.add.reduceat(c[:, k], at)) for k in (2, 3))
            low, high = np.minimum.reduceat(c[:, 4], at), np.maximum.reduceat(c[:, 5], at)
            k = int(np.argmax(2 * hit / (n + hit[-1])))
            return float(low[k] + (high[k + 1] if k + 1 < len(at) else low[k])) / 2

        self.shift[:] = best(counts)
        for k in range(1, len(FUNCTION_WORDS) + 1):
            c = counts[counts[:, 0] == k]
            if min(c[:, 3].sum(), (c[:, 2] - c[:, 3]).sum()) >= 10:
                self.shift[k] = best(c)

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(texts))
        z = self.logits(texts) - self.shift[self.languages(texts)]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -500, 500)))


def fold(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def _sample_words(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([buckets(words_of(t)).tobytes() for t in b.column(2).to_pylist()], pa.binary())], ["toxic", "part", "ids"])


def calibration_counts(docs: DataFrame, known: DataFrame, model: Classifier) -> DataFrame:
    """All labelled rows whose crc32(doc_id) mod 5 is 1, whole texts, counted
    by guessed language and step of the logit.  Rows without a label go before
    they are scored.  Rows of one id count once."""
    known = known.filter("toxic in (0, 1)").select("doc_id", "toxic")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            lang, logit = [], []
            for k in range(0, len(texts), 512):
                ids = [buckets(words_of(t)) for t in texts[k:k + 512]]
                lang += shared.value.languages(ids).tolist()
                logit += shared.value.logits(ids).tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.int32()), pa.array(logit, pa.float64())], ["doc_id", "lang", "logit"])

    schema = StructType([docs.schema["doc_id"], StructField("lang", IntegerType()), StructField("logit", DoubleType())])
    part = docs.select("doc_id", "text").filter(fold(F.col("doc_id")) == 1)
    part = part.join(known.filter(fold(F.col("doc_id")) == 1).select("doc_id"), "doc_id", "left_semi")
    rows = map_arrow(part, run, schema).join(known, "doc_id")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max(F.struct("logit", "lang")).alias("top"))
    step = F.floor(F.greatest(F.lit(-FAR), F.least(F.lit(FAR), F.col("top.logit"))) * STEPS)
    return rows.groupBy(F.col("top.lang").alias("lang"), step.alias("step")).agg(
        F.count("*").alias("n"), F.sum("toxic").alias("toxic"), F.min("top.logit").alias("low"), F.max("top.logit").alias("high"))


def fit(docs: DataFrame, labels: DataFrame, most_positive: int = MOST_POSITIVE, most_negative: int = MOST_NEGATIVE) -> Classifier:
    """Train on a sample of the labelled rows whose crc32(doc_id) mod 5 is over
    1, and calibrate on all of those where it is 1."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    learning = known.filter(fold(F.col("doc_id")) > 1).withColumn("order", F.xxhash64("doc_id"))
    chosen = learning.filter("toxic = 1").orderBy("order", "doc_id").limit(most_positive).unionByName(
        learning.filter("toxic = 0").orderBy("order", "doc_id").limit(most_negative))
    rows = docs.select("doc_id", "text").filter(F.length("text") <= MOST_CHARS)
    # at most most_positive + most_negative rows of two numbers
    rows = rows.join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id").dropDuplicates(["doc_id"])
    rows = rows.select(F.col("toxic").cast("int"), fold(F.col("doc_id")).cast("int").alias("part"), "text", "doc_id")
    got = map_arrow(rows.select("toxic", "part", "text"), _sample_words, "toxic int, part int, ids binary").collect()
    got.sort(key=lambda r: (r["part"], r["toxic"], zlib.crc32(r["ids"]), bytes(r["ids"])))
    texts = [np.frombuffer(r["ids"], dtype=np.int32).reshape(-1, 2) for r in got]
    y = np.array([r["toxic"] for r in got], dtype=np.float64)
    model = Classifier()
    if len(y) and 0 < y.mean() < 1:
        model.train(texts, y)
        counts = np.array(calibration_counts(docs, known, model).collect(), dtype=np.float64).reshape(-1, 6)
        if not 0 < counts[:, 3].sum() < counts[:, 2].sum():  # not both kinds: the sample serves
            logit = model.logits(texts).astype(np.float64)
            counts = np.stack([model.languages(texts), logit, np.ones(len(y)), y, logit, logit], axis=1)
        model.calibrate(counts)
    return model


def score_column(docs: DataFrame, model: Classifier, name: str = "score") -> DataFrame:
    """``docs`` with the model's score, all other columns as they are.  The
    model's size is fixed, so every task gets it by broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            score = []
            for k in range(0, len(texts), 512):
                score += shared.value.scores([buckets(words_of(t)) for t in texts[k:k + 512]]).tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score, pa.float64())], [*b.schema.names, name])

    return map_arrow(docs, run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def clean(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` without the rows that the model calls toxic."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    kept = score_column(rows, model).filter("score < 0.5")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document's score."""
    docs = documents(spark, sf_dir)
    model = fit(docs, table(spark, sf_dir, "labels"))
    d = score_column(docs.select("doc_id", "text"), model)
    return d.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
