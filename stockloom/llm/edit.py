"""Edit distance over words, bit-parallel: a column of the alignment is one integer."""

from __future__ import annotations

from collections.abc import Sequence


def _masks(pattern: Sequence[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, word in enumerate(pattern):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


def within(a: Sequence[int], b: Sequence[int], limit: int) -> int | None:
    """The distance of `a` and `b` if it is at most `limit`, else None, by banded alignment.

    Common ends are cut off first. Then only cells within `limit` of the diagonal
    are computed: bit i of column j stands for row j - limit + i, so the band slides
    down one row per column.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > limit:
        return None
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if not len(a):
        return len(b)
    # never wider than the texts: a distance is at most the longer one's length
    if limit >= len(a):
        found = _full(a, b)
        return found if found <= limit else None
    m, n, k = len(a), len(b), limit
    masks, band = _masks(a), (1 << 2 * k + 1) - 1
    top, up, down = 1 << 2 * k, (1 << 2 * k + 1) - (1 << k), 0
    score = k
    for j in range(1, m - k + 1):  # the band's last row has not reached the last word of a
        match = masks.get(b[j - 1], 0)
        match = (match >> j - k - 1 if j > k else match << k + 1 - j) & band
        diagonal = ((((match & up) + up) ^ up) | match | down) & band
        right, left = down | ~(diagonal | up) & band, diagonal & up
        if not diagonal & top:
            score += 1
            if score - (n - m + k) > k:
                return None
        diagonal >>= 1
        up, down = (left | ~(diagonal | right)) & band, diagonal & right
    bit = top >> 1
    for j in range(m - k + 1, n + 1):  # along the last row
        match = masks.get(b[j - 1], 0)
        match = (match >> j - k - 1 if j > k else match << k + 1 - j) & band
        diagonal = ((((match & up) + up) ^ up) | match | down) & band
        right, left = down | ~(diagonal | up) & band, diagonal & up
        if right & bit:
            score += 1
        elif left & bit:
            score -= 1
        bit >>= 1
        diagonal >>= 1
        up, down = (left | ~(diagonal | right)) & band, diagonal & right
    return score if score <= k else None


def _full(a: Sequence[int], b: Sequence[int]) -> int:
    return _columns(a, b, 1)[-1]


def _columns(a: Sequence[int], b: Sequence[int], start: int) -> list[int]:
    """Last row of the alignment of `a` with each prefix of `b`; start 0: with its best suffix."""
    m = len(a)
    masks, whole, top = _masks(a), (1 << m) - 1, 1 << m - 1
    up, down, score, out = whole, 0, m, [m]
    for word in b:
        match = masks.get(word, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        right, left = down | ~(diagonal | up) & whole, diagonal & up
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right, left = right << 1 | start, left << 1
        up, down = (left | ~(diagonal | right)) & whole, diagonal & right
        out.append(score)
    return out


def best_part(pattern: Sequence[int], text: Sequence[int]) -> tuple[int, int]:
    """(distance, end) of the part of `text` nearest to `pattern`, the first such end."""
    scores = _columns(pattern, text, 0)
    best = min(scores)
    return best, scores.index(best)
