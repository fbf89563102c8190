"""Personal data: patterns, and a character model beside them.

The base finds e-mail addresses, IP addresses, card and phone numbers by
pattern and check.  The method adds spans: a character-level bidirectional
LSTM with CRF transitions, trained in numpy from labelled spans (windows of a
bounded sample of the corpus with its base spans, and words of the same windows
with generated data, in the patterns' spelling and in others, or with near
misses among them).

All four kinds hold a digit or an ``@``, so windows are laid wherever one
stands, over the whole text: ``WINDOW`` characters, half overlapping, around
an ``@`` over the whole name before and host after it.  Each
window is decoded by Viterbi; where windows overlap, a character takes its tag
from the window in which it stands farthest from an edge, and spans are read
off the reconciled tags, across windows.  An added span must be sure (least
marginal of its tags above its kind's gate, which lies above every wrong span of
held-out generated windows), pass its kind's check (parts, digits, Luhn) and
touch neither a base span nor another added one.  An added address that begins or ends
within a run of name or host characters takes in the whole run.

Defined cases: a null text is empty and has no span; a null doc_id is kept;
repeated rows give equal rows; where added spans overlap the first stays; a very
long text is scanned once for each pattern and decoded window by window; columns
beyond doc_id and text are not read; without any document with data the model
learns from generated data alone; an empty table gives no row.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazrank.llm.common import documents, map_arrow

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
WINDOW = 64
MARGIN = 20
#: Least marginal of an added span's tags; ``choose_gates`` raises it by kind.
LEAST = 0.5
#: Bounds of the training sample: documents, and windows taken of them.
SAMPLE_DOCS = 600
SAMPLE_WINDOWS = 700
#: Generated windows, at least; a third of them are near misses.
GENERATED = 1500
EMBED, HIDDEN = 12, 24
EPOCHS = 12
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
#: A run of digits is read once: a match begins where a run does, and what
#: cannot follow the whole run cannot follow a part of it.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
_HOST = re.compile(r"[A-Za-z0-9.-]*")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind: str, s: str) -> bool:
    """A kind's check."""
    digits = "".join(c for c in s if "0" <= c <= "9")
    if kind == "ip":
        parts = re.split(r"[^0-9]+", s.strip())
        return len(parts) == 4 and all(p and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return "@" in s and "." in s.partition("@")[2]


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from the ``@`` signs:
    the name part is the run before the sign, as far as the last match."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1, start):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All base spans, by kind as listed and then by start."""
    out = [("email", a, b) for a, b in emails(text)]
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(kind, m.group())]
    return out


def digest_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def codes(s: str) -> np.ndarray:
    """Characters as small numbers: ASCII as itself, others by kind; 0 pads."""
    raw = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    return np.where(raw < 128, raw + 1, 129 + (raw > 0x2FF)).astype(np.int64)


SYMBOLS = 131


def name_start(text: str, at: int, least: int = 0) -> int:
    """Where the run of name characters before ``at`` starts, from ``least``."""
    while at > least and _LOCAL.match(text, at - 1, at):
        at -= 1
    return at


def address_zone(text: str, at: int) -> tuple[int, int]:
    """Start of the name before an ``@`` and end of the host after it, blanks
    (up to ``MARGIN``) between."""
    a, b = at, at + 1
    while a > max(0, at - MARGIN) and text[a - 1] == " ":
        a -= 1
    while b < min(len(text), at + 1 + MARGIN) and text[b] == " ":
        b += 1
    return name_start(text, a), _HOST.match(text, b).end()


def windows_of(text: str) -> list[tuple[int, str]]:
    """(start, characters) of windows that cover every digit and ``@`` with
    ``MARGIN`` characters around, half overlapping within a zone.  A name or
    host that reaches beyond those is covered, with as many around it."""
    zones: list[list[int]] = []
    for m in _SIGN.finditer(text):
        a, b = m.start() - MARGIN, m.end() + MARGIN
        if m.group() == "@":
            name, host = address_zone(text, m.start())
            a, b = a if name > a else name - MARGIN, b if host < b else host + MARGIN
        a, b = max(0, a), min(len(text), b)
        while zones and a <= zones[-1][1]:
            x, y = zones.pop()
            a, b = min(a, x), max(b, y)
        zones.append([a, b])
    out = []
    for a, b in zones:
        while True:
            out.append((a, text[a:a + WINDOW]))
            if a + WINDOW >= b:
                break
            a += WINDOW // 2
    return out


def tags_of(n: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    out = np.zeros(n, dtype=np.int64)
    for kind, a, b in spans:
        k = KINDS.index(kind)
        out[max(a, 0):b] = 2 + 2 * k
        if 0 <= a < n:
            out[a] = 1 + 2 * k
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Tagger:
    """BiLSTM emissions and a CRF over the tags; weights in ``w``."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.gates = dict.fromkeys(KINDS, LEAST)
        self.w = {"emb": rng.normal(0, 0.3, (SYMBOLS, EMBED)), "out": rng.normal(0, 0.2, (2 * HIDDEN, TAGS)), "out_b": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
        for d in "fb":
            self.w["lstm_" + d] = rng.normal(0, 0.25, (EMBED + HIDDEN + 1, 4 * HIDDEN))
            self.w["lstm_" + d][-1, HIDDEN:2 * HIDDEN] += 1.0  # forget little at first
        # inside must follow begin or inside of the same kind
        for k in range(len(KINDS)):
            begin, inside = 1 + 2 * k, 2 + 2 * k
            for t in range(TAGS):
                if t not in (begin, inside):
                    self.w["trans"][t, inside] = -6.0
            self.w["first"][inside] = -1.0

    def _run(self, x: np.ndarray, w: np.ndarray):
        """One direction over (time, batch, embed): states and what backward
        needs."""
        steps, batch, _ = x.shape
        h, c = np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN))
        hs, kept = np.zeros((steps, batch, HIDDEN)), []
        one = np.ones((batch, 1))
        for t in range(steps):
            z = np.concatenate([x[t], h, one], axis=1)
            g = z @ w
            i, f, o = _sigmoid(g[:, :HIDDEN]), _sigmoid(g[:, HIDDEN:2 * HIDDEN]), _sigmoid(g[:, 2 * HIDDEN:3 * HIDDEN])
            u = np.tanh(g[:, 3 * HIDDEN:])
            before, c = c, f * c + i * u
            tc = np.tanh(c)
            h = o * tc
            hs[t] = h
            kept.append((z, i, f, o, u, before, tc))
        return hs, kept

    def _back(self, dh_all: np.ndarray, kept, w: np.ndarray):
        dw, dx = np.zeros_like(w), np.zeros((len(kept), dh_all.shape[1], EMBED))
        dh, dc = np.zeros_like(dh_all[0]), np.zeros_like(dh_all[0])
        for t in range(len(kept) - 1, -1, -1):
            z, i, f, o, u, before, tc = kept[t]
            dh = dh + dh_all[t]
            dc = dc + dh * o * (1 - tc * tc)
            g = np.concatenate([dc * u * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u * u)], axis=1)
            dw += z.T @ g
            dz = g @ w.T
            dx[t], dh, dc = dz[:, :EMBED], dz[:, EMBED:EMBED + HIDDEN], dc * f
        return dw, dx

    def emissions(self, x: np.ndarray, keep: bool = False):
        """(time, batch, tags) scores of (batch, time) character codes."""
        e = self.w["emb"][x.T]
        forward, kept_f = self._run(e, self.w["lstm_f"])
        backward, kept_b = self._run(e[::-1], self.w["lstm_b"])
        h = np.concatenate([forward, backward[::-1]], axis=2)
        out = h @ self.w["out"] + self.w["out_b"]
        return (out, h, kept_f, kept_b) if keep else out

    def marginals(self, em: np.ndarray, mask: np.ndarray):
        """Forward-backward: (log partition, tag marginals, expected moves).
        Padding (mask 0) carries the state on unchanged."""
        steps, batch, _ = em.shape
        trans = np.exp(self.w["trans"])
        alpha, beta = np.zeros_like(em), np.zeros_like(em)
        log_z = np.zeros(batch)
        a = np.exp(self.w["first"] + em[0] - em[0].max(axis=1, keepdims=True))
        log_z += em[0].max(axis=1) + np.log(a.sum(axis=1))
        alpha[0] = a / a.sum(axis=1, keepdims=True)
        scale = np.ones((steps, batch))
        pot = np.exp(em - em.max(axis=2, keepdims=True))
        for t in range(1, steps):
            a = (alpha[t - 1] @ trans) * pot[t]
            s = a.sum(axis=1)
            on = mask[t]
            alpha[t] = np.where(on[:, None], a / s[:, None], alpha[t - 1])
            scale[t] = np.where(on, s, 1)
            log_z += np.where(on, np.log(s) + em[t].max(axis=1), 0)
        beta[-1] = 1
        moves = np.zeros((TAGS, TAGS))
        for t in range(steps - 1, 0, -1):
            on = mask[t]
            follow = pot[t] * beta[t] / scale[t][:, None]
            moves += (alpha[t - 1][on].T @ follow[on]) * trans
            beta[t - 1] = np.where(on[:, None], follow @ trans.T, beta[t])
        m = alpha * beta
        return log_z, m / m.sum(axis=2, keepdims=True), moves

    def train(self, x: np.ndarray, tags: np.ndarray, seed: int = 5, batch: int = 32, rate: float = 0.01) -> None:
        rng = np.random.default_rng(seed)
        state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.w.items()}
        step = 0
        for _ in range(EPOCHS):
            for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
                step += 1
                for k, g in self._gradients(x[part], tags[part]).items():
                    g = np.clip(g / len(part), -1, 1)
                    m, v = state[k]
                    m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                    state[k] = (m, v)
                    self.w[k] = self.w[k] - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def _gradients(self, x: np.ndarray, tags: np.ndarray) -> dict:
        mask = (x > 0).T
        em, h, kept_f, kept_b = self.emissions(x, keep=True)
        _, m, moves = self.marginals(em, mask)
        steps, batch, _ = em.shape
        gold = np.eye(TAGS)[tags.T]
        d = (m - gold) * mask[:, :, None]
        seen = np.zeros((TAGS, TAGS))
        on = mask[1:]
        np.add.at(seen, (tags.T[:-1][on], tags.T[1:][on]), 1)
        dh = d @ self.w["out"].T
        dw_f, dx_f = self._back(dh[:, :, :HIDDEN], kept_f, self.w["lstm_f"])
        dw_b, dx_b = self._back(dh[::-1, :, HIDDEN:], kept_b, self.w["lstm_b"])
        emb = np.zeros_like(self.w["emb"])
        np.add.at(emb, x.T, dx_f + dx_b[::-1])
        emb[0] = 0
        return {"emb": emb, "out": np.einsum("tbh,tbk->hk", h, d), "out_b": d.sum(axis=(0, 1)), "trans": moves - seen,
                "first": (m[0] - gold[0]).sum(axis=0), "lstm_f": dw_f, "lstm_b": dw_b}

    def decode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window its Viterbi tags and their marginals."""
        x = np.zeros((len(texts), WINDOW), dtype=np.int64)
        for k, s in enumerate(texts):
            c = codes(s)
            x[k, :len(c)] = c
        em = self.emissions(x)
        mask = (x > 0).T
        _, m, _ = self.marginals(em, mask)
        steps, batch, _ = em.shape
        score = self.w["first"] + em[0]
        back = np.zeros((steps, batch, TAGS), dtype=np.int64)
        for t in range(1, steps):
            way = score[:, :, None] + self.w["trans"]
            back[t] = np.where(mask[t][:, None], way.argmax(axis=1), np.arange(TAGS))
            score = np.where(mask[t][:, None], way.max(axis=1) + em[t], score)
        tag = score.argmax(axis=1)
        path = np.zeros((steps, batch), dtype=np.int64)
        for t in range(steps - 1, -1, -1):
            path[t] = tag
            tag = back[t][np.arange(batch), tag]
        sure = np.take_along_axis(m, path[:, :, None], axis=2)[:, :, 0]
        return [(path[:len(s), k], sure[:len(s), k]) for k, s in enumerate(texts)]


def reconcile(found: list[tuple[int, np.ndarray, np.ndarray]]) -> list[tuple[str, int, int, float]]:
    """Spans off the windows' tags: (kind, start, end, least marginal)."""
    best: dict[int, tuple[int, int, float]] = {}
    for start, tags, sure in found:
        n = len(tags)
        for k in range(n):
            inner = min(k, n - 1 - k)
            if start + k not in best or inner > best[start + k][0]:
                best[start + k] = (inner, int(tags[k]), float(sure[k]))
    spans, now = [], None
    for p in sorted(best):
        _, tag, sure = best[p]
        kind, inside = (None, False) if tag == 0 else (KINDS[(tag - 1) // 2], tag % 2 == 0)
        if now and inside and kind == now[0] and p == now[2]:
            now[2], now[3] = p + 1, min(now[3], sure)
            continue
        if now:
            spans.append(tuple(now))
        now = [kind, p, p + 1, sure] if kind else None
    if now:
        spans.append(tuple(now))
    return spans


def generated(kind: str, rng: np.random.Generator, beyond: bool | None = None) -> str:
    """Made-up data of a kind, in the spelling of the patterns, in one
    ``beyond`` them, or (None) in either."""
    digits = lambda n: "".join(str(d) for d in rng.integers(0, 10, n))
    word = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 26, n))
    beyond = bool(rng.integers(2)) if beyond is None else beyond
    if kind == "email":
        at = rng.choice([" @ ", " @", "@ "]) if beyond else "@"
        return f"{word(rng.integers(2, 8))}{rng.choice(['.', '_', ''])}{digits(rng.integers(0, 3))}{at}{word(rng.integers(3, 8))}{rng.choice(['.example', ''])}.{rng.choice(['com', 'net', 'org'])}"
    if kind == "ip":
        return rng.choice([" . ", ". "] if beyond else ["."]).join(str(x) for x in rng.integers(0, 256, 4))
    if kind == "card":
        body = digits(15)
        body += next(c for c in "0123456789" if luhn(body + c))
        return rng.choice([".", "/", "  "] if beyond else ["", "", " ", "-"]).join(body[k:k + 4] for k in range(0, 16, 4))
    area, a, b = digits(3), digits(3), digits(4)
    if beyond:
        return rng.choice([f"({area}) {a}-{b}", f"{area}-{a}-{b}", f"{area}.{a}.{b}", f"00{digits(2)} {area} {a} {b}"])
    return rng.choice([f"+1 ({area}) {a}-{b}", f"+{digits(2)} {area} {a} {b}", f"+{digits(11)}"])


def near_miss(rng: np.random.Generator) -> str:
    """Made-up text with digits or an ``@`` that is no personal data."""
    n = lambda k: str(int(rng.integers(1, 10 ** k)))
    two = lambda: f"{int(rng.integers(1, 32)):02d}"
    return str(rng.choice([
        f"version {n(1)}.{n(1)}", f"Version {n(1)}.{n(2)}.{n(1)}", f"{two()}.{two()}.20{two()}", f"20{two()}-{two()}-{two()}", f"{two()}:{two()}:{two()}",
        f"${n(3)},{n(3).zfill(3)}.{two()}", f"{n(2)}-{n(2)}", f"{n(3)} {n(3)}", n(4), n(6), f"@{chr(97 + int(rng.integers(26)))}{n(2)}", f"{n(2)}%", f"no. {n(3)}",
        f"{n(2)}, {n(2)} and {n(2)}", f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}", "".join(rng.choice(list("0123456789abcdef"), 32)), f"{n(2)} @ ${n(2)}", f"p. {n(3)}-{n(3)}", f"section {n(1)}.{n(1)}.{n(1)}"]))


def _sample(batches):
    for b in batches:
        rows = []
        for text in b.column(0).to_pylist():
            spans = base_spans(text)
            for start, s in windows_of(text):
                rows.append((s, digest_text([(k, a - start, z - start) for k, a, z in spans if a < start + len(s) and z > start])))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], ["chars", "spans"])


def training_windows(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS) -> tuple[list[tuple[str, np.ndarray]], list[str]]:
    """Windows and tags: of the sampled documents (smallest hash of the text)
    with their base spans, and of their words with generated data or near
    misses among them; and those words."""
    signed = docs.select("text", F.xxhash64("text").alias("order")).filter(F.col("text").rlike("[0-9@]"))
    # the hash up to which the sample goes; texts of the sample alone move
    last = signed.select("order").distinct().orderBy("order").limit(sample_docs).agg(F.max("order")).first()[0]
    some = signed.filter(F.col("order") <= F.lit(last))
    rows = map_arrow(some.select("text"), _sample, "chars string, spans string").distinct()
    got = rows.orderBy(F.xxhash64("chars", "spans"), "chars").limit(sample_windows).collect()
    rng = np.random.default_rng(17)
    out, plain = [], ["the and of to in that is for with this from are was you what which on as it be"]
    for r in got:
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        out.append((r["chars"], tags_of(len(r["chars"]), [(k, a, min(b, len(r["chars"]))) for k, a, b in spans])))
        bare = re.sub(r"\S*[0-9@]\S*", "", r["chars"]).strip()
        if len(bare) > 15:
            plain.append(bare)
    for k in range(max(GENERATED, 2 * len(out))):
        kind = KINDS[k % 4] if k % 3 else None
        s, spans = written(kind, plain, rng)
        out.append((s, tags_of(len(s), spans)))
    return out, plain


def written(kind: str | None, plain: list[str], rng: np.random.Generator, beyond: bool | None = None) -> tuple[str, list]:
    """Generated data of a kind (None: a near miss) among words of the corpus:
    a window's characters and its spans."""
    words = plain[int(rng.integers(len(plain)))].split(" ")
    cut = int(rng.integers(len(words) + 1))
    data = near_miss(rng) if kind is None else generated(kind, rng, beyond)
    lead, tail = " ".join(words[:cut][-4:]), " ".join(words[cut:])
    lead = lead + " " if lead else ""
    s = (lead + data + str(rng.choice([" ", ", ", ". "])) + tail)[:WINDOW]
    return s, [(kind, len(lead), min(len(lead) + len(data), len(s)))] if kind else []


def choose_gates(model: Tagger, plain: list[str], rows: int = 1200) -> dict[str, float]:
    """Per kind, how sure a span must be: above every wrong span that the model
    finds in generated windows held out of training -- near misses, data of
    the other kinds, and text without either -- and LEAST at least."""
    rng = np.random.default_rng(23)
    gates = dict.fromkeys(KINDS, LEAST)
    held = [written(KINDS[k % 4] if k % 3 == 0 else None, plain, rng, True if k % 2 else None) if k % 4 else (plain[k % len(plain)][:WINDOW], []) for k in range(rows)]
    for (s, spans), (tags, sure) in zip(held, model.decode([s for s, _ in held])):
        base = base_spans(s)
        for kind, a, b, least in reconcile([(0, tags, sure)]):
            if added_spans(base, [(kind, a, b, 1.0)], s) and not any(k == kind and x < b and a < y for k, x, y in spans):
                gates[kind] = max(gates[kind], float(np.nextafter(least, 1)))
    return gates


def fit(docs: DataFrame, **bounds) -> Tagger:
    rows, plain = training_windows(docs, **bounds)
    x, y = np.zeros((len(rows), WINDOW), np.int64), np.zeros((len(rows), WINDOW), np.int64)
    for k, (s, tags) in enumerate(rows):
        c = codes(s)
        x[k, :len(c)], y[k, :len(c)] = c, tags
    model = Tagger()
    model.train(x, y)
    model.gates = choose_gates(model, plain)
    return model


def added_spans(base: list, model_spans: list, text: str, gates: dict[str, float] | None = None) -> list[tuple[str, int, int]]:
    """The model's spans that are sure, pass their check, and touch neither a
    base span nor one another (the first stays)."""
    starts = sorted(a for _, a, _ in base)
    ends = sorted(b for _, _, b in base)
    # of the base spans up to the k-th start, the greatest end
    reach = [0, *accumulate((b for _, b in sorted((a, b) for _, a, b in base)), max)]
    out, last = [], 0
    for kind, a, b, least in sorted(model_spans, key=lambda s: s[1:3]):
        if least < (gates or {}).get(kind, LEAST) or a < last:
            continue
        if kind == "email" and "@" in text[a:b]:
            k = bisect_right(ends, a)
            a = name_start(text, a, max(last, ends[k - 1] if k else 0))
            k = bisect_left(starts, b)
            b = min(_HOST.match(text, b).end(), starts[k] if k < len(starts) else len(text))
        while a < b and text[a] in " .,;:":
            a += 1
        while b > a and text[b - 1] in " .,;:":
            b -= 1
        if valid(kind, text[a:b]) and reach[bisect_left(starts, b)] <= a:
            out.append((kind, a, b))
            last = b
    return out


def find_spans(docs: DataFrame, model: Tagger) -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone`` (base
    spans), ``base`` and ``spans`` (kind:start:end, comma-joined)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            bases = [base_spans(t) for t in texts]
            todo = [(k, start, s) for k, t in enumerate(texts) for start, s in windows_of(t)]
            found: dict[int, list] = {}
            for a in range(0, len(todo), 256):
                part = todo[a:a + 256]
                for (k, start, _), (tags, sure) in zip(part, shared.value.decode([s for _, _, s in part])):
                    found.setdefault(k, []).append((start, tags, sure))
            spans = []
            for k, (text, base) in enumerate(zip(texts, bases)):
                more = added_spans(base, reconcile(found[k]), text, shared.value.gates) if k in found else []
                spans.append(sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))
            count = [pa.array([sum(s[0] == kind for s in base) for base in bases], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays([b.column(0), *count, pa.array([digest_text(x) for x in bases]), pa.array([digest_text(x) for x in spans])],
                                             ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def op6_pii(spark, sf_dir: str) -> DataFrame:
    """Contract query: counts, digest of the base spans, and all spans."""
    docs = documents(spark, sf_dir)
    d = find_spans(docs, fit(docs))
    return d.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")
