"""Personal data patterns and token ids against the plain definitions, on
random and on very long texts."""

from __future__ import annotations

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from hazrank.llm import pii
from hazrank.llm.tokens import encoded, vocabulary

#: The base patterns as the contract words them.
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_luhn(digits):
    doubled = [int(c) * 2 if k % 2 else int(c) for k, c in enumerate(digits[::-1])]
    return sum(x // 10 + x % 10 for x in doubled) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and plain_luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


@pytest.mark.parametrize("letters", ["0123.", "019.. ", "12-  9", "+1() .-5", "a@.1-+ ", "4012888 -", "2550. +(a@"])
def test_base_spans_are_the_patterns(letters):
    rng = random.Random(letters)
    for n in (12, 30, 80):
        for _ in range(1500):
            t = "".join(rng.choice(letters) for _ in range(rng.randint(0, n)))
            assert pii.base_spans(t) == plain_spans(t), t


def test_zeros_of_any_number_are_a_part():
    assert pii.base_spans("1.1.1." + "0" * 5000)[0] == ("ip", 0, 5006)
    assert [s for s in pii.base_spans("1.1.1." + "0" * 5000 + "256") if s[0] == "ip"] == []


@pytest.mark.parametrize("text", ["7" * 1_000_000, "1." * 500_000, "12 " * 300_000, "+1" + "(" * 1_000_000, "a" * 1_000_000 + "@", "a@" * 500_000, "1.2.3.4 " * 100_000])
def test_base_spans_of_long_texts_take_seconds(text):
    began = time.time()
    pii.base_spans(text)
    assert time.time() - began < 10


def test_added_spans_touch_no_base_span_nor_one_another():
    text = "call 10.0.0.1 or ann @ example.com ann @ example.com 1 2 3"
    a = text.index("ann")
    two = [("email", a, a + 17, 0.99), ("email", a + 2, a + 17, 0.99), ("email", a + 18, a + 35, 0.99), ("ip", 5, 13, 0.99)]
    assert pii.added_spans([("ip", 5, 13)], two, text) == [("email", a, a + 17), ("email", a + 18, a + 35)]
    many = [("ip", 10 * k, 10 * k + 9) for k in range(20_000)]
    began = time.time()
    pii.added_spans(many, [(k, a, b, 1.0) for k, a, b in many], "1.1.1.100 " * 20_000)
    assert time.time() - began < 5


@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_tokens_with_control_characters_are_the_library_s(name, spaced):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(name))
    rng = random.Random(6)
    controls = [chr(c) for c in (*range(32), 127, 0x85, 0xA0, 0x2028)]
    texts = ["\x01é", "\x01abc", "a \x01b", "\n\x01b", "\x01\x01", "x\x01", *controls, *(f"ab{c}é {c}d" for c in controls)]
    texts += ["".join(rng.choice(controls) if rng.random() < 0.3 else rng.choice("aébC .,1日") for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    for text, ids in zip(texts, encoded(pa.array(texts), name, spaced, 9)):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids + [9], repr(text)


def test_the_tagger_adds_what_the_patterns_miss_and_nothing_else(spark):
    """Held-out data in spellings beyond the patterns, measured after the
    gates; near misses and clean texts get no span."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice(["the", "an", "re", "ti", "on", "ing"]) for _ in range(rng.randint(1, 3)))
    made = np.random.default_rng(5)
    clean = [" ".join(word() for _ in range(40)) for _ in range(60)]
    docs = spark.createDataFrame([(k, f"{t} {pii.generated(pii.KINDS[k % 4], made, False)} {t[:50]}") for k, t in enumerate(clean)], "doc_id long, text string")
    model = pii.fit(docs)
    held = np.random.default_rng(77)
    texts, where = [], []
    for k in range(240):
        lead = " ".join(word() for _ in range(12)) + " "
        kind = pii.KINDS[k % 4]
        data = pii.generated(kind, held, True)
        texts.append(f"{lead}{data} {word()} {word()}")
        where.append((kind, len(lead), len(lead) + len(data)))
    texts += [f"{word()} {pii.near_miss(held)} {word()}" for _ in range(120)] + clean
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)] for r in pii.find_spans(rows, model).collect()}
    base = {k: pii.base_spans(t) for k, t in enumerate(texts)}
    beyond = [k for k in range(240) if not base[k]]
    assert len(beyond) > 150
    assert np.mean([any(k == kind and x <= a and y >= b for k, x, y in got[d]) for d in beyond for kind, a, b in [where[d]]]) > 0.8
    assert all(set(base[k]) <= set(got[k]) for k in got)
    assert sum(len(got[k]) > len(base[k]) for k in range(240, len(texts))) <= 2
