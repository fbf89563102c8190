"""Encoding whole texts with a public tokenizer inside tasks.

Texts are split at single spaces between two other characters, and at single
line breaks.  Neither vocabulary merges across such places, so the ids of a
text are those of its chunks, one after another.  All texts of a batch are
split at once, and each distinct chunk among them is looked up once.  A chunk
of Latin-1 letters and closing marks goes piece by piece to the tokenizer's
merge model, which is what the tokenizer itself would do with it; any other
chunk goes to the tokenizer whole.  A bounded table keeps the words' ids in one
array, from which numpy gathers those of a text.  Ids are little-endian unsigned
32 bit.
"""

from __future__ import annotations

import gc
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are split and looked up together, about.
STEP_BYTES = 7_000_000
#: Words whose ids a worker keeps; beyond that the table starts anew.
TABLE_WORDS = 800_000
_INNER = re.compile(r"(?<=\S) (?=\S)")
_MARKS = ".,!?;:"
_LATIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))
#: Stands for a line break at a chunk's start.
_BREAK = "\x01"
_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_ODD = rf"^\x01?({_BLANK}|$)|{_BLANK}$"
#: Chunks that are a word alone; with the mark of a line break only where such
#: marks are made, since U+0001 of a text is a character like any other.
_WORD = rf"^[{_LATIN}]+$"
_MARKED_WORD = rf"^\x01?[{_LATIN}]+$"
_ENCODERS: dict[tuple[str, bool], "ChunkEncoder"] = {}


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies:
    printable bytes for themselves, the others for letters from 256 on."""
    out, extra = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
            out[b] = chr(b)
        else:
            out[b] = chr(extra)
            extra += 1
    return out


_LETTERS = byte_letters()


def _bytes_as_letters(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(_LETTERS)


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def id_bytes(path: str) -> int:
    """Bytes that hold any id of a vocabulary: two or four."""
    from tokenizers import Tokenizer
    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


class ChunkEncoder:
    """``spaced``: a chunk's ids depend on the space before it and on case
    (byte-level vocabularies); otherwise white space is dropped and letters
    are lower-cased."""

    def __init__(self, path: str, spaced: bool):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spaced = spaced
        self._forget()

    def _forget(self) -> None:
        """An empty table: words by number, and the ids of all of them in a
        row, those of a word from its place in ``begin`` on."""
        self.words: dict[str, int] = {}
        self.pool = np.zeros(0, dtype="<u4")
        self.begin = np.zeros(1, dtype=np.int64)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: str) -> list[int]:
        return [t.id for t in self.model.tokenize(_bytes_as_letters(piece))]

    def _learn(self, words: list[str], plain: list[bool]) -> None:
        """Add words that the table lacks: of a plain one its ids without
        closing marks, of another those of the whole chunk; after a space or a
        line break if that matters."""
        before = _LETTERS[32] if self.spaced else ""
        lower = str if self.spaced else str.lower
        alone = [w for w, p in zip(words, plain) if p and w[0] != _BREAK]
        begins = [w for w, p in zip(words, plain) if p and w[0] == _BREAK]  # a line
        odd = [w for w, p in zip(words, plain) if not p]
        # ASCII letters stand for themselves
        letters = [before + (w if w.isascii() else _bytes_as_letters(lower(w))) for w in alone]
        # very many short lists, none of them in a cycle: looking for cycles
        # would walk over all of them again and again
        collecting = gc.isenabled()
        gc.disable()
        try:
            found = list(map(self.model.tokenize, letters))
            size = list(map(len, found))
            ids = [t.id for f in found for t in f]
            del found
        finally:
            if collecting:
                gc.enable()
        line = self._piece("\n") if begins else []
        rest = [line + self._piece(w[1:]) for w in begins]
        rest += self._whole([("\n" + w[1:] if w.startswith(_BREAK) else " " + w) if self.spaced else w for w in odd])
        size += map(len, rest)
        ids += [i for r in rest for i in r]
        known = len(self.words)
        self.words.update(zip(alone + begins + odd, range(known, known + len(words))))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(size, dtype=np.int64)])
        self.pool = np.concatenate([self.pool, np.array(ids, dtype="<u4")])

    def _apart(self, text: str) -> bytes:
        """White space beside a space: split only where a space stands alone."""
        parts = _INNER.split(text)
        return np.array(sum(self._whole([parts[0]] + [" " + c for c in parts[1:]]), []), dtype="<u4").tobytes()

    def encode(self, texts: pa.Array, end: int) -> list[bytes]:
        """Ids of each text with the end id."""
        texts = pc.fill_null(texts, "")
        if self.spaced:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " " + _BREAK), " ")
        else:
            lists = pc.split_pattern(pc.ascii_lower(pc.replace_substring(texts, "\n", " ")), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        coded = lists.flatten().dictionary_encode()
        chunk, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary

        core = pc.utf8_rtrim(distinct, _MARKS)
        plain = pc.match_substring_regex(core, _MARKED_WORD if self.spaced else _WORD)
        core = pc.if_else(plain, core, distinct)
        marks = pc.if_else(plain, pc.utf8_ltrim(distinct, _BREAK + _LATIN), "").dictionary_encode()
        if len(self.words) >= TABLE_WORDS:
            self._forget()
        names = core.to_numpy(zero_copy_only=False).tolist()
        word = list(map(self.words.get, names))
        if None in word:
            flags = plain.to_numpy(zero_copy_only=False).tolist()
            new = {n: p for n, k, p in zip(names, word, flags) if k is None}
            self._learn(list(new), list(new.values()))
            word = list(map(self.words.get, names))
        of_marks = [self._piece(m) if m else [] for m in marks.dictionary.to_pylist()]

        # the ids of each distinct chunk in a row: those of its word, then of its marks
        word, mark = np.array(word, dtype=np.int64), marks.indices.to_numpy().astype(np.int64)
        source = np.concatenate([self.pool, np.array(sum(of_marks, []), dtype="<u4")])
        mark_size = np.fromiter(map(len, of_marks), dtype=np.int64, count=len(of_marks))
        first_mark = len(self.pool) + np.cumsum(mark_size) - mark_size
        starts = np.stack([self.begin[word], first_mark[mark]], axis=1).reshape(-1)
        sizes = np.stack([self.begin[word + 1] - self.begin[word], mark_size[mark]], axis=1).reshape(-1)
        flat, size = _gather(source, starts, sizes), sizes.reshape(-1, 2).sum(axis=1)

        apart: list[int] = []
        first = offsets[:-1]
        if self.spaced:
            bad = pc.match_substring_regex(distinct, _ODD).to_numpy(zero_copy_only=False)[chunk]
            bad[first] = False
            bad = np.logical_or.reduceat(bad, first) | pc.match_substring(texts, _BREAK).to_numpy(zero_copy_only=False)
            # a text's first chunk has no space before it
            heads = self._whole([h.replace(_BREAK, "\n") for h in distinct.take(pa.array(chunk[first])).to_pylist()])
            # a text that starts with a line break has an empty first chunk
            apart = np.flatnonzero(bad).tolist()
            chunk[first] = len(distinct) + np.arange(len(heads))
            flat = np.concatenate([flat, np.array(sum(heads, []), dtype="<u4")])
            size = np.concatenate([size, np.fromiter(map(len, heads), dtype=np.int64, count=len(heads))])
        count = size[chunk]
        tokens = _gather(flat, (np.cumsum(size) - size)[chunk], count).tobytes()
        ends = 4 * np.cumsum(count)[offsets[1:] - 1]
        tail = np.array([end], dtype="<u4").tobytes()
        out = [tokens[a:z] + tail for a, z in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist())]
        for k in apart:
            out[k] = self._apart(texts[k].as_py()) + tail
        return out


def _gather(source: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs ``source[start:start + count]``, one after another."""
    after = np.cumsum(counts)
    total = int(after[-1]) if len(after) else 0
    kind = np.int32 if max(total, len(source)) < 1 << 31 else np.int64
    place = np.repeat((starts - (after - counts)).astype(kind), counts)
    place += np.arange(total, dtype=kind)
    return source[place]


def encoder(path: str, spaced: bool) -> ChunkEncoder:
    """The worker's encoder of this vocabulary."""
    if (path, spaced) not in _ENCODERS:
        _ENCODERS[path, spaced] = ChunkEncoder(path, spaced)
    return _ENCODERS[path, spaced]


def encoded(texts: pa.Array, name: str, spaced: bool, end: int):
    """Per text its ids' bytes with the end id."""
    e = encoder(vocabulary(name), spaced)
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    step = (np.cumsum(size, dtype=np.int64) // STEP_BYTES).tolist()
    start = 0
    for k in range(1, len(step) + 1):
        if k == len(step) or step[k] != step[start]:
            yield from e.encode(texts.slice(start, k - start), end)
            start = k
