"""Word tokens of many texts at once, as 64-bit hashes with byte offsets."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np

#: Bytes that are hashed at once; a longer text is taken in parts that end between words.
AT_ONCE = 400_000
BASE = 0x9E3779B97F4A7C15 | 1


def _wrap(x: int) -> int:
    return x & ((1 << 64) - 1)


def powers(n: int, base: int = BASE) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(_wrap(base)))]), dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


def folded(text: str | None) -> str:
    """The text for matching without case: Unicode's full case folding, in composed form, so that
    É, é and e with a combining accent are one letter, and so are ß and SS. ASCII is left to the
    tokenizer."""
    if not text or text.isascii():
        return text or ""
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).casefold())


class Tokenizer:
    """A word is a run of ASCII letters, digits and non-ASCII characters, with A-Z lower-cased."""

    def __init__(self) -> None:
        fold = np.arange(256)
        fold[65:91] += 32
        self.value = np.random.default_rng(0x70C).integers(1, 1 << 63, 256, dtype=np.uint64)[fold]
        low = np.array([chr(i).isalnum() for i in range(128)])
        self.word = np.concatenate([low, np.ones(128, bool)])
        self.up, self.down = powers(0), powers(0)

    def _hash(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(data) >= len(self.up):
            self.up, self.down = powers(len(data)), powers(len(data), pow(BASE, -1, 1 << 64))
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = self.word[data]
        edge = np.diff(inside)
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.value[data] * self.up[: len(data)], out=total[1:])
            return mixed((total[b] - total[a]) * self.down[a]), a, b

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, start and end (in bytes) of every word."""
        whole, at, found = np.frombuffer(data, np.uint8), 0, []
        while at < len(whole):
            end = min(len(whole), at + AT_ONCE)
            while end < len(whole) and self.word[whole[end]]:
                end += 1
            h, a, b = self._hash(whole[at:end])
            found.append((h, a + at, b + at))
            at = end
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))

    def groups(self, texts: list[str | None]) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Consecutive texts of about AT_ONCE bytes together: index of the first, their bytes, the
        index of each text's first word (and one past the last), and hash, start and end of the
        words, counted from each text's start."""
        at = 0
        while at < len(texts):
            part, size, first = [], 0, at
            while at < len(texts) and (not part or size < AT_ONCE):
                part.append((texts[at] or "").encode("utf-8", "replace"))
                size += len(part[-1]) + 1
                at += 1
            base = np.concatenate([[0], np.cumsum([len(p) + 1 for p in part])])
            h, a, b = self.words(b"\n".join(part))
            cut = np.searchsorted(a, base)
            back = np.repeat(base[:-1], np.diff(cut))
            yield first, part, cut, h, a - back, b - back


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for every n consecutive words."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            total = total * np.uint64(BASE) + h[k : len(h) - n + 1 + k]
    return mixed(total)


def running_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """The Karp-Rabin hash of every n consecutive tokens, from sums that run over the sequence."""
    if len(h) < n or n < 1:
        return np.empty(0, np.uint64)
    total = np.zeros(len(h) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(h * powers(len(h))[:-1], out=total[1:])
        return (total[n:] - total[:-n]) * powers(len(h), pow(BASE, -1, 1 << 64))[: len(h) - n + 1]
