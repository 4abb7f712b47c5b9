"""Costs of all strings of every text, added up by text, where the table of costs is too large to send out.

Tasks scan the texts in chunks of some MB and ask, once per chunk and distinct string
of four bytes, for its costs; the answers meet the chunk again and give each text's
sums. So no table is broadcast, and what moves are the compressed texts, once, and
the distinct strings of chunks, in as many buckets as the texts' bytes ask for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.arrow_text import byte_strings, runs, spans, text_bytes
from stockloom.plans.joins import settled

CHUNK = 4 << 20
BUCKET = 64 << 20  # bytes of text for each bucket of strings
LEAST_BUCKETS = 64
MIX = 1013904223  # odd and below 2^31, so products of four bytes fit a long
MOVED = "the documents came in another order when they were read again"


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(name, rows) of a batch, some MB at a time; the name follows from the content alone."""
    _, offsets = text_bytes(batch.column("text"))
    for i, j in runs(offsets, CHUNK):
        part = batch.slice(i, j - i)
        data, _ = text_bytes(part.column("text"))
        ids = str(part.column("doc_id").to_pylist()).encode()
        yield xxhash.xxh3_64_intdigest(data.tobytes() + ids) - (1 << 63), part


def _unpacked(blob: bytes) -> pa.Table:
    table = pa.ipc.open_stream(zstandard.decompress(blob)).read_all()
    return table.combine_chunks().to_batches()[0] if table.num_rows else table


def sum_costs(rows: DataFrame, resolve: Callable[[DataFrame], DataFrame], width: int = 1) -> DataFrame:
    """The columns of `rows` but `text`, `n` (strings of the text) and `costs` (their `width` sums) of every row.

    `rows` have `doc_id` and a padded `text`. `resolve` turns distinct strings (`gram`) into
    (`gram`, `costs` array<float>). The rows are scanned twice, to ask and to add up, and
    must come in the same order both times, as stored tables do; a chunk that finds no answers raises.
    """
    others = [c for c in rows.columns if c != "text"]
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, total // BUCKET)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, part in _chunks(batch):
                found = [np.unique(grams) for _, _, grams, _ in byte_strings(part.column("text"))]
                grams = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)
                mixed = (grams.astype(np.uint64) * np.uint64(MIX) & np.uint64(0xFFFFFFFF)) >> np.uint64(8)
                bucket = mixed % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                own = [(int(bucket[order[i]]), grams[order[i:j]].tobytes()) for i, j in spans(bucket[order])]
                yield pa.record_batch(
                    {
                        "bucket": pa.array([b for b, _ in own], pa.int32()),
                        "chunk": pa.array([name] * len(own), pa.int64()),
                        "grams": pa.array([g for _, g in own], pa.binary()),
                    }
                )

    def distinct(asked: pa.Table) -> pa.Table:
        parts = [np.frombuffer(g, np.uint32) for g in asked["grams"].to_pylist()]
        return pa.table({"gram": pa.array(np.unique(np.concatenate(parts)).astype(np.int64))})

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.table({"chunk": pa.array([], pa.int64()), "grams": pa.array([], pa.binary()), "costs": pa.array([], pa.binary())})
        grams = known["gram"].to_numpy().astype(np.uint32)
        costs = known["costs"].combine_chunks().flatten().to_numpy().reshape(len(grams), width)
        order = np.argsort(grams)
        grams, costs = grams[order], costs[order]
        found = [costs[np.searchsorted(grams, np.frombuffer(g, np.uint32))].tobytes() for g in asked["grams"].to_pylist()]
        return pa.table({"chunk": asked["chunk"], "grams": asked["grams"], "costs": pa.array(found, pa.binary())})

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, part in _chunks(batch):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as out:
                    out.write_batch(part)
                blob = zstandard.compress(sink.getvalue(), 3)
                yield pa.record_batch({"chunk": pa.array([name], pa.int64()), "blob": pa.array([blob], pa.binary())})

    def measure(held: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        grams = np.frombuffer(b"".join(told["grams"].to_pylist()), np.uint32)
        costs = np.frombuffer(b"".join(told["costs"].to_pylist()), np.float32).reshape(len(grams), width)
        order = np.argsort(grams)
        grams, costs = grams[order], np.ascontiguousarray(costs[order].T)
        for blob in held["blob"].to_pylist():
            part = _unpacked(blob)
            size, sums = np.zeros(part.num_rows, np.int64), np.zeros((part.num_rows, width))
            for i, j, own, starts in byte_strings(part.column("text")):
                size[i:j] = np.diff([*starts, len(own)])
                filled = size[i:j] > 0
                if filled.any():
                    at = np.searchsorted(grams, own)
                    if not len(grams) or (grams[np.minimum(at, len(grams) - 1)] != own).any():
                        raise RuntimeError(MOVED)
                    for k in range(width):
                        sums[i:j][filled, k] = np.add.reduceat(costs[k][at], starts[filled], dtype=np.float64)
            cuts = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * np.int32(width))
            columns = [*(part.column(c) for c in others), pa.array(size), pa.ListArray.from_arrays(cuts, pa.array(sums.ravel()))]
            out.append(pa.table(columns, names=[*others, "n", "costs"]))
        if not out:
            raise RuntimeError(MOVED)
        return pa.concat_tables(out)

    asked = settled(rows.mapInArrow(ask, "bucket int, chunk long, grams binary"), "asked")
    known = resolve(asked.groupBy("bucket").applyInArrow(distinct, "gram long"))
    mixed = F.shiftright((F.col("gram") * MIX).bitwiseAND(F.lit(0xFFFFFFFF)), 8)
    known = known.withColumn("bucket", (mixed % buckets).cast("int"))
    told = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(answer, "chunk long, grams binary, costs binary")
    carried = rows.mapInArrow(carry, "chunk long, blob binary")
    kept = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in others)
    return carried.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(measure, f"{kept}n long, costs array<double>")
