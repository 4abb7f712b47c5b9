"""Texts of an Arrow batch as one byte array, for vectorised passes inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its n + 1 offsets; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive texts [i, j) of at most `limit` bytes together, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


STRING = 4  # bytes
PAD = "\n" * (STRING - 1)  # stands before a text, so that each of its bytes ends a string


def byte_strings(column: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, strings, starts of texts among the strings) of padded texts, some at a time.

    Every byte of a text has the string of four bytes that ends with it, as a number.
    """
    data, offsets = text_bytes(column)
    for i, j in runs(offsets, limit):
        wide = data[offsets[i] : offsets[j]].astype(np.uint32)
        starts = offsets[i:j] - offsets[i]
        grams = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
        keep = np.ones(len(grams), bool)
        for back in range(1, STRING):  # strings that end in the pad of the next text
            keep[starts[1:] - back] = False
        yield i, j, grams[keep], starts - len(PAD) * np.arange(j - i)


def spans(values: np.ndarray) -> list[tuple[int, int]]:
    """[begin, end) of every run of equal values."""
    if not len(values):
        return []
    cuts = (np.flatnonzero(values[1:] != values[:-1]) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, len(values)], strict=True))
