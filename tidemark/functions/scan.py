"""Tokens of whole batches of texts as arrays of code points: what text.tokens gives, in numpy."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Characters of texts that are looked at together, and marks in tables: no part of a token, and
#: a character that becomes none or several.
PIECE = 1 << 20
GAP, HARD = 0, -1
_LAST = 0x32400


def _bare(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")


def fold_text(s: str, folded: bool = True) -> str:
    return _bare(s.lower()) if folded else s.lower()


def _token(c: str) -> bool:
    return (k := unicodedata.category(c))[0] in "LN" or k == "Co"


@lru_cache(2)
def table(folded: bool = True) -> np.ndarray:
    """What each code point becomes within a token: its folded code point, GAP or HARD."""
    out = np.full(0x110000, GAP, np.int32)
    for i in (*range(0xD800), *range(0xE000, _LAST), *range(0xE0000, 0xE0200)):
        c = chr(i)
        f = fold_text(c, folded)
        if len(f) != 1 or c == "Σ":
            out[i] = HARD
        elif _token(f):
            out[i] = ord(f)
    for a in (0xF0000, 0x100000):
        out[a : a + 0xFFFE] = np.arange(a, a + 0xFFFE)
    return out


def pieces(batch: pa.RecordBatch, texts: list[str], most_rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about PIECE bytes of text; a longer text is a slice of its own."""
    import pyarrow.compute as pc

    size = np.zeros(batch.num_rows, np.int64)
    for name in texts:
        size += pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    a = 0
    while a < batch.num_rows:
        b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PIECE, "right"))
        b = min(max(b, a + 1), a + most_rows, batch.num_rows)
        yield batch.slice(a, b - a)
        a = b


def coded(column: pa.Array, codes: np.ndarray, folded: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(values, edges): codes (a table, or one made from it) of all texts, one after another, each
    behind a GAP and the last before one; text i lies between edges i and i + 1. Texts with
    characters that are HARD are folded one by one."""
    texts = [t or "" for t in column.to_pylist()]
    for again in (False, True):
        edges = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1, out=edges[1:])
        values = codes[np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), "<u4")]
        if again or not (bad := np.flatnonzero(values == HARD)).size:
            break
        for i in np.unique(np.searchsorted(edges, bad, "right") - 1):
            texts[i] = fold_text(texts[i], folded)
    return values, edges


def starts(values: np.ndarray) -> np.ndarray:
    """Where tokens begin."""
    inside = values != GAP
    return np.flatnonzero(inside[1:] & ~inside[:-1]) + 1


def counts_of(begins: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many tokens each text has."""
    return np.diff(np.searchsorted(begins, edges, "right"))


def occurrences(column: pa.Array, folded: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(terms, codes, counts): the batch's distinct tokens, each token's place among them, and how
    many tokens each text has."""
    values, edges = coded(column, table(folded), folded)
    values = np.maximum(values, GAP)
    begins = starts(values)
    inside = values != GAP
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    chars = values[inside]
    data = chars.astype("<u4").tobytes().decode("utf-32-le").encode()
    width = 1 + (chars > 0x7F).astype(np.int8) + (chars > 0x7FF) + (chars > 0xFFFF)
    at = np.zeros(len(chars) + 1, np.int64)
    np.cumsum(width, out=at[1:])
    chars_at = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(ends - begins, out=chars_at[1:])
    tokens = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(at[chars_at].tobytes()), pa.py_buffer(data))
    d = tokens.dictionary_encode()
    return d.dictionary.cast(pa.string()), d.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts_of(begins, edges)


def term_counts(columns: list[pa.Array], folded: bool = True) -> tuple[np.ndarray, pa.Array, pa.Array, list[np.ndarray], np.ndarray]:
    """(rows, terms' places, terms, counts by column, tokens of each row): a row's distinct tokens
    over all columns, and how often each column has them."""
    each = [occurrences(c, folded) for c in columns]
    rows = [np.repeat(np.arange(len(n)), n) for _, _, n in each]
    d = pa.chunked_array([t for t, _, _ in each]).combine_chunks().dictionary_encode()
    terms, place = d.dictionary, d.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    starts_at = np.cumsum([0, *[len(t) for t, _, _ in each]])
    m = max(1, len(terms))
    keys = [r * m + place[a + codes] for r, (_, codes, _), a in zip(rows, each, starts_at)]
    of = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    key, of = key[order], of[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    counts = [np.add.reduceat(of == i, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64) for i in range(len(columns))]
    sizes = sum((n for _, _, n in each), np.zeros(len(columns[0]), np.int64))
    return key[first] // m, pa.array(key[first] % m), terms, counts, sizes


class Passages:
    """Which texts contain which of some passages, byte for byte: eight bytes of each passage are
    sought at all places of all texts at once, and where they are found the rest is compared."""

    WORD, BITS, FACTOR = 8, 20, np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, passages: list[str]) -> None:
        self.data = [p.encode() for p in passages]
        self.short = [i for i, p in enumerate(self.data) if len(p) < self.WORD]
        long = [i for i, p in enumerate(self.data) if len(p) >= self.WORD]
        self.at = np.array([(len(self.data[i]) - self.WORD) // 2 for i in long], np.int64)
        self.size = np.array([len(self.data[i]) for i in long], np.int64)
        anchor = np.array([int.from_bytes(self.data[i][a : a + self.WORD], "little") for i, a in zip(long, self.at)], np.uint64)
        order = np.argsort(anchor, kind="stable")
        self.which, self.at, self.size, self.anchor = np.array(long, np.int64)[order], self.at[order], self.size[order], anchor[order]
        self.seen = np.zeros(1 << self.BITS, bool)
        self.seen[self._hash(self.anchor)] = True
        self.edges = np.concatenate([[0], np.cumsum([len(p) for p in self.data])]).astype(np.int64)
        self.bytes = b"".join(self.data)

    def _hash(self, words: np.ndarray) -> np.ndarray:
        return (words * self.FACTOR) >> np.uint64(64 - self.BITS)

    @classmethod
    def _words(cls, data: np.ndarray) -> np.ndarray:
        """The eight bytes from each place on, as a view."""
        return np.ndarray((max(0, len(data) - cls.WORD + 1),), "<u8", data, strides=(1,))

    def found(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(texts, passages), each pair once. A null contains nothing."""
        texts = [None if t is None else t.encode() for t in column.to_pylist()]
        pairs = [(i, p) for p in self.short for i, t in enumerate(texts) if t is not None and self.data[p] in t]
        a, b = np.array([i for i, _ in pairs], np.int64), np.array([p for _, p in pairs], np.int64)
        if not len(self.which):
            return a, b
        edges = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t or b"") for t in texts], out=edges[1:])
        data, own = np.frombuffer(b"".join(t or b"" for t in texts), np.uint8), np.frombuffer(self.bytes, np.uint8)
        words, mine = self._words(data), self._words(own)
        places = np.flatnonzero(self.seen[self._hash(words)])
        lo, hi = np.searchsorted(self.anchor, words[places], "left"), np.searchsorted(self.anchor, words[places], "right")
        many = hi - lo
        k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
        begin = np.repeat(places, many) - self.at[k]
        text = np.searchsorted(edges, np.repeat(places, many), "right") - 1
        fits = (begin >= edges[text]) & (begin + self.size[k] <= edges[text + 1])
        begin, text, k, done = begin[fits], text[fits], k[fits], 0
        whole: list[tuple[np.ndarray, np.ndarray]] = []
        while len(k):
            at = np.minimum(done, self.size[k] - self.WORD)
            same = words[begin + at] == mine[self.edges[self.which[k]] + at]
            begin, text, k = begin[same], text[same], k[same]
            done += self.WORD
            over = self.size[k] <= done
            whole.append((text[over], self.which[k[over]]))
            begin, text, k = begin[~over], text[~over], k[~over]
        pair = np.unique(np.concatenate([a * len(self.data) + b, *[t * len(self.data) + p for t, p in whole]]).astype(np.int64))
        return pair // len(self.data), pair % len(self.data)
