"""Hashes of words and of windows of consecutive words, vectorised over many texts at once."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = (np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5))
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x + np.uint64((salt * 0x632BE59BD9B4E019 + 0x1D8E4E27C47D124F) & (2**64 - 1))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base^0 ... base^n, modulo 2^64; kept for the next call."""
    known = _powers.get(int(base))
    if known is None or len(known) <= n:
        size = 1 << max(16, int(n).bit_length())
        factors = np.full(size + 1, base, np.uint64)
        factors[0] = 1
        known = _powers[int(base)] = np.multiply.accumulate(factors)
    return known[: n + 1]


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 2**64))


def _slices(values: np.ndarray, base: np.uint64, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[begin:end] for each pair, from one prefix sum."""
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(base, len(values))[: len(values)], out=prefix[1:])
    return (prefix[end] - prefix[begin]) * _power(_inverse(base), len(values))[begin]


UNSPACED = np.ones(256, bool)  # words `[^\\x20\\x09-\\x0D]+`
UNSPACED[[32, 9, 10, 11, 12, 13]] = False
LETTERS = np.zeros(256, bool)  # runs of ASCII letters, digits and all that is not ASCII
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words(
    data: np.ndarray, offsets: np.ndarray, of: np.ndarray = UNSPACED
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, text) of every word, a run of bytes marked in `of`; `offsets` bound the texts in `data`.

    Texts may touch: a word ends where its text does.
    """
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = of[data]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] |= inside[1:-1][cuts]
    last[cuts - 1] |= inside[1:-1][cuts - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(offsets, begin, side="right") - 1


def _blocks(begin: np.ndarray, limit: int):
    """[i, j) of items whose starts lie within `limit` of each other: keeps prefix sums short and in cache."""
    i = 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(begin, begin[i] + limit)))
        yield i, j
        i = j


def _sliced(values: np.ndarray, base: np.uint64, begin: np.ndarray, end: np.ndarray, limit: int = 1 << 17) -> np.ndarray:
    """`_slices` of ordered slices, a block at a time."""
    out = np.empty(len(begin), np.uint64)
    for i, j in _blocks(begin, limit):
        low = begin[i]
        part = values[low : end[j - 1]].astype(np.uint64) + np.uint64(1)
        out[i:j] = _slices(part, base, begin[i:j] - low, end[i:j] - low)
    return out


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix(_sliced(data, _BASE, begin, end) + (end - begin).astype(np.uint64))


def windows(hashes: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, 64 bits, 64 more) of every window of `width` words within one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at = np.flatnonzero(text[:n] == text[width - 1 :])
    return at, *(mix(_sliced(mix(hashes, i + 1), _STEP[i], at, at + width), i + 3) for i in (0, 1))
