"""Repeated passages by exact window counts behind a count-min prefilter.

Documents travel in compressed chunks of a few MB (a long document makes a chunk of
its own). A window is `width` consecutive words, known by 96 bits of its words.

1. Each task sketches its windows: `DEPTH` rows of counters, sent as sorted,
   difference-coded cells. Merged block by block, what remains of a counter is one
   bit: two or more. That bitmap is broadcast; its size follows the number of
   windows up to `MAX_BITS` and beyond that stays: it then only lets more through.
2. Windows whose every cell is set, the repeated ones and a few more, are grouped
   exactly: a chunk asks, once per distinct window, for the least document that
   has it. A window on a third of all rows is asked for once per chunk.
3. The answers return to their chunks, which cut the covered words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.arrow_text import runs, spans, text_bytes
from stockloom.llm.word_windows import mix, windows, word_hashes, words
from stockloom.plans.joins import settled

WIDTH = 13
DEPTH = 2
CHUNK = 2 << 20  # bytes of text
BLOCK = 23  # a block of the sketch has 2^23 cells
MAX_BITS = 30  # a row of the sketch has at most 2^30 cells: 128 MB when broadcast
BUCKET = 4 << 20  # windows asked for in one task, at most about
LEAST_BUCKETS = 64


def _pack(array: np.ndarray) -> bytes:
    """Bytes of equal significance side by side, then zstd: sorted differences shrink to about their entropy."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), -1).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _unpack(blob: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _packed(high: np.ndarray, low: np.ndarray, doc: np.ndarray) -> list[bytes]:
    """Windows in order of `high`, 96 bits of each, with a document."""
    return [_pack(np.diff(high, prepend=np.uint64(0))), _pack(low.astype(np.uint32)), _pack(doc)]


def _windows(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    return [
        (np.cumsum(_unpack(high, np.uint64)), _unpack(low, np.uint32).astype(np.uint64), _unpack(doc, np.int64))
        for high, low, doc in table["windows"].to_pylist()
    ]


def chunked(docs: DataFrame, chunk: int = CHUNK, width: int = WIDTH) -> DataFrame:
    """(`chunk`, `windows`, `blob`): documents with their texts, whole, in compressed Arrow form."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in runs(offsets, chunk):
                part = batch.slice(i, j - i)
                begin, _, text = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as out:
                    out.write_batch(part)
                raw = sink.getvalue()
                count = int((np.bincount(text, minlength=1) - width + 1).clip(0).sum()) if len(begin) else 0
                blob = zstandard.compress(raw, 3)
                name = xxhash.xxh64_intdigest(blob) - (1 << 63)
                yield pa.record_batch(
                    {
                        "chunk": pa.array([name], pa.int64()),
                        "windows": pa.array([count], pa.int64()),
                        "blob": pa.array([blob], pa.binary()),
                    }
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        pack, "chunk long, windows long, blob binary"
    )


class Chunk:
    """A chunk's documents, their words and windows."""

    def __init__(self, blob: bytes, width: int):
        pa.default_memory_pool().release_unused()  # of the chunk before
        self.docs = pa.ipc.open_stream(zstandard.decompress(blob)).read_all().combine_chunks()
        column = self.docs.column("text").combine_chunks() if self.docs.num_rows else pa.array([], pa.string())
        self.data, self.offsets = text_bytes(column)
        self.begin, self.end, self.text = words(self.data, self.offsets)
        hashes = word_hashes(self.data, self.begin, self.end)
        self.at, self.high, self.low = windows(hashes, self.text, width)
        ids = self.docs.column("doc_id")
        known = ~np.asarray(ids.is_null())[self.text[self.at]] if len(self.at) else np.zeros(0, bool)
        self.at, self.high, self.low = self.at[known], self.high[known], self.low[known]
        self.ids = ids.fill_null(0).to_numpy().astype(np.int64)

    def doc(self, which: np.ndarray) -> np.ndarray:
        return self.ids[self.text[self.at[which]]]


def _cells(high: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(high, 11 + row) >> np.uint64(64 - bits)).astype(np.uint32)


def sketch(chunks: DataFrame, bits: int, depth: int = DEPTH, width: int = WIDTH) -> list[np.ndarray]:
    """One bitmap per row: the cells that two or more windows fall into."""
    block_bits = min(BLOCK, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(depth)]

        def send():
            for row in range(depth):
                cells = np.sort(np.concatenate(held[row])) if held[row] else np.zeros(0, np.uint32)
                held[row].clear()
                for i, j in spans(cells >> np.uint32(block_bits)):
                    own = cells[i:j] & np.uint32((1 << block_bits) - 1)
                    yield row << 32 | int(cells[i]) >> block_bits, _pack(np.diff(own, prepend=np.uint32(0)))

        def batch_of(rows):
            blocks, cells = pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())
            return pa.record_batch({"block": blocks, "cells": cells})

        size = 0
        for batch in batches:
            for blob in batch.column("blob"):
                chunk = Chunk(blob.as_py(), width)
                for row in range(depth):
                    held[row].append(_cells(chunk.high, row, bits))
                size += len(chunk.high)
                if size > 2 << 20:
                    yield batch_of(list(send()))
                    size = 0
        yield batch_of(list(send()))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("cells"), strict=True):
                cells = np.cumsum(_unpack(blob.as_py(), np.uint32).astype(np.int64))
                seen = once.setdefault(block, np.zeros(1 << block_bits, bool))
                again = twice.setdefault(block, np.zeros(1 << block_bits, bool))
                again[cells[1:][cells[1:] == cells[:-1]]] = True
                again[cells[seen[cells]]] = True
                seen[cells] = True
        for block, again in twice.items():
            packed = np.packbits(again, bitorder="little").tobytes()
            yield pa.record_batch({"block": pa.array([block], pa.int64()), "bits": pa.array([packed], pa.binary())})

    blocks = depth << (bits - block_bits)
    sent = chunks.select("blob").mapInArrow(count, "block long, cells binary")
    found = sent.repartition(min(blocks, 1 << 12), "block").mapInArrow(merge, "block long, bits binary")
    maps = [np.zeros(max(1, (1 << bits) // 8), np.uint8) for _ in range(depth)]
    for r in found.toLocalIterator(prefetchPartitions=False):
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        begin = (r["block"] & 0xFFFFFFFF) * len(part)
        maps[r["block"] >> 32][begin : begin + len(part)] = part
    return maps


def _repeated(chunk: Chunk, maps: list[np.ndarray], bits: int) -> np.ndarray:
    """The windows that the sketch counts twice or more."""
    left = np.arange(len(chunk.high))
    for row, bitmap in enumerate(maps):
        cells = _cells(chunk.high[left], row, bits)
        left = left[(bitmap[cells >> np.uint32(3)] >> (cells & np.uint32(7)).astype(np.uint8)) & 1 == 1]
    return left


def _least(high: np.ndarray, low: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per distinct window, in order: where it first stands in sorted order, and the least document."""
    order = np.lexsort((doc, low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    return order, new, doc[order][new]


def remove_repeats(docs: DataFrame, width: int = WIDTH, chunk: int = CHUNK, max_bits: int = MAX_BITS) -> DataFrame:
    """`doc_id`, `text` (kept words, joined by one space), `n_words`, `n_removed` for every document.

    Removed is each word covered by a window that also starts in a document with a
    smaller doc_id, judged on the input. A null text has no words and comes back
    empty. A null id is neither smaller nor larger: such rows keep all words and cost
    no other row any. Rows repeated under one id do not touch each other. An
    empty table gives no rows. Extra columns are not read.
    """
    spark = docs.sparkSession
    chunks = settled(chunked(docs, chunk, width), "chunks")
    total = chunks.agg(F.sum("windows")).first()[0] or 0
    bits = min(max_bits, max(10, int(2 * total).bit_length()))
    maps = spark.sparkContext.broadcast(sketch(chunks, bits, width=width))
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob"), strict=True):
                own = Chunk(blob.as_py(), width)
                which = _repeated(own, maps.value, bits)
                high, low = own.high[which], own.low[which]
                order, new, least = _least(high, low, own.doc(which))
                high, low = high[order][new], low[order][new]
                bucket = (high >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)  # in order, as high is
                rows = {"bucket": [], "chunk": [], "windows": []}
                for i, j in spans(bucket):
                    rows["bucket"].append(int(bucket[i]))
                    rows["chunk"].append(name)
                    rows["windows"].append(_packed(high[i:j], low[i:j], least[i:j]))
                yield pa.record_batch(
                    {
                        "bucket": pa.array(rows["bucket"], pa.int64()),
                        "chunk": pa.array(rows["chunk"], pa.int64()),
                        "windows": pa.array(rows["windows"], pa.list_(pa.binary())),
                    }
                )

    def answer(asked: pa.Table) -> pa.Table:
        names = asked["chunk"].to_numpy()
        parts = _windows(asked)
        high, low, doc = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, new, least = _least(high, low, doc)
        over = np.empty(len(doc), np.int64)
        over[order] = least[np.cumsum(new) - 1]
        rows, at = {"chunk": [], "windows": []}, 0
        for name, (high, low, doc) in zip(names, parts, strict=True):
            own = over[at : at + len(doc)]
            at += len(doc)
            told = own < doc
            if told.any():
                rows["chunk"].append(name)
                rows["windows"].append(_packed(high[told], low[told], own[told]))
        return pa.table(
            {"chunk": pa.array(rows["chunk"], pa.int64()), "windows": pa.array(rows["windows"], pa.list_(pa.binary()))}
        )

    def cut(held: pa.Table, told: pa.Table) -> pa.Table:
        answers = _windows(told)
        out = [_cut(Chunk(blob, width), maps.value, bits, answers, width) for blob in held["blob"].to_pylist()]
        return pa.concat_tables(out)

    asked = chunks.select("chunk", "blob").mapInArrow(ask, "bucket long, chunk long, windows array<binary>")
    told = asked.groupBy("bucket").applyInArrow(answer, "chunk long, windows array<binary>")
    return (
        chunks.select("chunk", "blob")
        .groupBy("chunk")
        .cogroup(told.groupBy("chunk"))
        .applyInArrow(cut, "doc_id long, text string, n_words long, n_removed long")
    )


def _cut(chunk: Chunk, maps, bits: int, answers: list, width: int) -> pa.Table:
    which = _repeated(chunk, maps, bits)
    low = chunk.low[which].astype(np.uint32).astype(np.uint64)
    doc = chunk.doc(which)
    high = np.concatenate([chunk.high[which], *(a[0] for a in answers)])
    low = np.concatenate([low, *(a[1] for a in answers)])
    docs = np.concatenate([doc, *(a[2] for a in answers)])
    order, new, least = _least(high, low, docs)
    over = np.empty(len(docs), np.int64)
    over[order] = least[np.cumsum(new) - 1]
    begin = chunk.at[which[over[: len(which)] < doc]]
    edge = np.zeros(len(chunk.begin) + 1, np.int32)
    edge[begin] += 1
    edge[begin + width] -= 1
    kept = np.cumsum(edge)[:-1] == 0
    per_doc = np.searchsorted(chunk.text, np.arange(len(chunk.ids) + 1))
    texts, removed = [], []
    for k, (i, j) in enumerate(zip(chunk.offsets, chunk.offsets[1:], strict=False)):
        own = chunk.data[i:j].tobytes().split()  # on the same six bytes
        mask = kept[per_doc[k] : per_doc[k + 1]]
        left = len(own) if mask.all() else int(mask.sum())
        texts.append(b" ".join(own if left == len(own) else compress(own, mask)))
        removed.append(len(own) - left)
    return pa.table(
        {
            "doc_id": chunk.docs.column("doc_id"),
            "text": pa.array(texts, pa.binary()).cast(pa.string()),
            "n_words": pa.array(np.diff(per_doc), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
        }
    )


ORACLE = """
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id,
         coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words
  FROM documents
), windows AS (
  SELECT row, doc_id, i, array_to_string(words[i:i + 12], ' ') AS w  -- words have no spaces
  FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM split)
), first AS (
  SELECT w, min(doc_id) AS least FROM windows GROUP BY w
), gone AS (
  SELECT DISTINCT row, unnest(range(i, i + 13)) AS i
  FROM windows JOIN first USING (w) WHERE least < doc_id
), kept AS (
  SELECT s.row, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY s.i) FILTER (g.i IS NULL) AS text
  FROM (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split) s
  LEFT JOIN gone g ON g.row = s.row AND g.i = s.i GROUP BY s.row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (row)
"""
