"""A bounded membership filter of 64-bit keys, built by tasks and small enough to broadcast."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stockloom.llm.arrow_text import spans
from stockloom.llm.word_windows import mix

BLOCK = 20  # a block has 2^20 bits
MOST = 27  # 2^27 bits: 16 MB


def slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64), 5) >> np.uint64(64 - bits)).astype(np.int64)


def bits_for(count: int, most: int = MOST) -> int:
    """Sixteen bits per key, in all at most 2^most: beyond that the filter lets more through, never less."""
    return min(most, max(3, int(16 * count).bit_length()))


def has(bitmap: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    at = slot(keys, bits)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """The bits of all values of the only column of `keys`, longs."""
    block_bits = min(BLOCK, bits)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.unique(slot(batch.column(0).to_numpy(zero_copy_only=False), bits))
            for i, j in spans(at >> block_bits):
                own = held.setdefault(int(at[i] >> block_bits), np.zeros(1 << block_bits, bool))
                own[at[i:j] & (1 << block_bits) - 1] = True
        yield from _out({b: np.packbits(own, bitorder="little") for b, own in held.items()})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column("block").to_pylist(), batch.column("bits"), strict=True):
                part = np.frombuffer(part.as_py(), np.uint8)
                held[block] = held[block] | part if block in held else part
        yield from _out(held)

    marked = keys.mapInArrow(mark, "block long, bits binary")
    merged = marked.repartition(1 << bits - block_bits, "block").mapInArrow(merge, "block long, bits binary")
    out = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    for r in merged.toLocalIterator():
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[r["block"] * len(part) :][: len(part)] = part
    return out


def _out(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for block, part in held.items():
        yield pa.record_batch({"block": pa.array([block], pa.int64()), "bits": pa.array([part.tobytes()], pa.binary())})
