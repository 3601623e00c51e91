"""Vectorised hashing of words and shingles over UTF-8 bytes (numpy, inside tasks).

Texts are joined into one byte buffer; a word's 64-bit hash is a polynomial
over its bytes, read off two prefix sums, so the cost per byte does not depend
on how many words there are. Hashes depend on the word's bytes alone: the same
word has the same hash in every task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Odd multipliers of the polynomial and of the shingle mixes.
_BASE = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_SHINGLE = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
            0x589965CC75374CC3, 0x1D8E4E27C47D124F)

#: White space of the shingle joins: space, tab, line feed, vertical tab, form feed, return.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

CHUNK_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: spreads every input bit over the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(_MIX[0])
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the odd base modulo 2**64 and of its inverse, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            inverse = pow(_BASE, -1, 1 << 64)
            size = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up, cls.down


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def chunks(texts: Sequence[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes each (one longer text is its own range)."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def hash_words(texts: Sequence[bytes], white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every word of every text, in order."""
    buf = np.frombuffer(b" ".join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    inside = np.zeros(len(buf) + 2, np.int8)
    np.logical_not(white[buf], out=inside[1:-1].view(bool))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[0::2], edge[1::2]
    up, down = _Powers.get(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[buf] * up[:len(buf)], out=total[1:])
    h = mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    owner = np.searchsorted(np.cumsum(lengths + 1), starts, side="right")
    return h, owner


def shingle_sets(texts: Sequence[bytes], width: int = 3) -> list[np.ndarray]:
    """The sorted distinct hashes of the ``width``-word shingles of each text.

    A text of fewer words is one shingle of all of them; one of none has none.
    """
    h, owner = hash_words(texts)
    n_words = np.bincount(owner, minlength=len(texts)) if len(h) else np.zeros(len(texts), np.int64)
    first = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(texts)
    if len(h) >= width:
        last = len(h) - width + 1
        x = h[:last] * np.uint64(_SHINGLE[0])
        for k in range(1, width):
            x = x + h[k:last + k] * np.uint64(_SHINGLE[k])
        whole = owner[:last] == owner[width - 1:]
        x, who = mix64(x[whole]), owner[:last][whole]
        ends = np.searchsorted(who, np.arange(len(texts) + 1))
        for i in np.flatnonzero(ends[1:] > ends[:-1]):
            s = np.sort(x[ends[i]:ends[i + 1]])
            keep = np.ones(len(s), bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out[i] = s[keep]
    for i in np.flatnonzero((n_words > 0) & (n_words < width)):
        words = h[first[i]:first[i] + n_words[i]]
        x = np.uint64(n_words[i])
        with np.errstate(over="ignore"):
            for k, w in enumerate(words):
                x = x + w * np.uint64(_SHINGLE[width + k] if width + k < len(_SHINGLE) else 2 * (width + k) + 1)
        out[i] = mix64(np.array([x], np.uint64))
    return out
