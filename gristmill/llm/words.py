"""Word hashing that several operators share."""

from __future__ import annotations

import string

import numpy as np

#: Entries after which a memo starts anew. A cache only: results don't depend on it.
MEMO = 300_000
_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_SEPARATES = np.zeros(256, bool)
_SEPARATES[list(string.punctuation.encode()) + list(range(33)) + [127]] = True
_powers: list[np.ndarray] = []


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < size:
        size = max(size, 2 * _BLOCK)
        _powers[:] = []
        for factor in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(size, factor, np.uint64)
            row[0] = 1
            _powers.append(np.multiply.accumulate(row))
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; values wrap."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def fold(text: str | None) -> bytes:
    return b"" if text is None else text.lower().encode("utf-8", "surrogatepass")


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of many folded texts, and the text each word is in.

    Words are runs of bytes other than ASCII punctuation, white space and
    control characters. A word's hash depends on its bytes alone.
    """
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
    apart = _SEPARATES[data]
    found, places = [], []
    at = 0
    while at < len(data):
        stop = min(len(data), at + _BLOCK)
        if stop < len(data) and not apart[stop - 1]:  # blocks end after a separator
            more = np.flatnonzero(apart[stop:])
            stop = stop + int(more[0]) + 1
        part, gap = data[at:stop], apart[at:stop]
        turns = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]])))
        begin, end = turns[::2], turns[1::2]
        if len(begin):
            power, inverse = _tables(len(part))
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=total[1:])
            found.append(mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64)))
            places.append(begin + at)
        at = stop
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.searchsorted(edges, np.concatenate(places), "right") - 1


def shingles(words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside an owner, and their owners.

    An owner with fewer words has one run of all its words, and one without words none.
    """
    if not len(words):
        return words, owner
    step = np.uint64(0x9E3779B97F4A7C15)
    size = len(words)
    value = np.zeros(size, np.uint64)
    out, own = [], []
    first = np.ones(size, bool)
    first[1:] = owner[1:] != owner[:-1]
    for k in range(1, min(n, size) + 1):
        m = size - k + 1
        value = mix(value[:m] * step + words[k - 1 :])
        whole = owner[:m] == owner[k - 1 :]
        if k == n:
            out.append(value[whole]), own.append(owner[:m][whole])
        else:  # texts of just k words
            ends = np.ones(m, bool)
            ends[:-1] = owner[k:] != owner[k - 1 : -1]
            short = first[:m] & whole & ends
            out.append(value[short]), own.append(owner[:m][short])
    return np.concatenate(out), np.concatenate(own)
