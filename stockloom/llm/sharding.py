"""Sharding by sampled splitters: ranges of about equal bytes, put together to shards of equal bytes.

A record's key is the hash of its text, its last bits those of its id's hash, so
equal texts are neighbours and a hot text can still be cut. Keys sampled with
probability in proportion to size give quantile boundaries; ranges counted
overfull are subdivided. Texts that hold a large part of a shard ("heavy", of
which there can only be so many) are placed whole, or by range where one is more
than a shard; the ranges of all others fill what is left in key order.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.plans.joins import settled

OVERHEAD = 16  # bytes a record costs besides its text
LOW = (1 << 24) - 1  # key bits that come from the id
RANGES = 16  # per shard, at least
RANGE_BYTES = 1 << 30  # text per range, at most about
SAMPLES = 16  # keys drawn per range
HEAVY = 64  # a text with more than 1/64 of a shard is heavy: at most 64 per shard
ROUNDS = 4  # of subdividing
SCHEMA = "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int"


def _bin(edges: np.ndarray, kind: str):
    """Number of edges at or below a value."""

    @F.pandas_udf(kind)
    def count(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, values.to_numpy(), side="right"))

    return count


def _group(key: Column) -> Column:
    return F.shiftright(key, 24)


def records(docs: DataFrame) -> DataFrame:
    """(`doc_id`, `size`, `text_crc32`, `key`) of every document; a null text has no bytes and a key of its own."""
    text = F.coalesce("text", F.lit(""))
    high = F.xxhash64(F.col("text").isNull(), text).bitwiseAND(F.lit(~LOW))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        high.bitwiseOR(F.xxhash64("doc_id").bitwiseAND(F.lit(LOW))).alias("key"),
    )


def splitters(rows: DataFrame, total: int, ranges: int, heavy: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """Quantile boundaries from a size-weighted sample of about ranges x samples keys.

    Only inside a heavy text may a boundary separate equal texts.
    """
    step = total / (ranges * samples)
    luck = F.shiftrightunsigned(F.xxhash64("key", F.lit("sample")), 11) / F.lit(float(1 << 53))
    drawn = rows.filter(luck * step < F.col("size")).select("key", "size").toArrow()
    keys, sizes = drawn["key"].to_numpy(), drawn["size"].to_numpy()
    order = np.argsort(keys, kind="stable")
    keys, weight = keys[order], np.cumsum(np.maximum(sizes[order], step))
    at = np.searchsorted(weight, np.arange(1, ranges) * (weight[-1] / ranges)) if len(keys) else []
    return _whole(keys[at], heavy)


def _whole(keys: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    return np.unique(np.where(np.isin(keys >> 24, heavy), keys, keys & ~LOW)).astype("int64")


def subdivided(edges: np.ndarray, full: dict[int, float], heavy: np.ndarray) -> np.ndarray:
    """Edges with each overfull range cut evenly in as many parts as it is too large; keys are hashes, so even."""
    low, high = np.iinfo("int64").min, np.iinfo("int64").max
    added = []
    for at, times in full.items():
        begin = int(edges[at - 1]) if at else low
        end = int(edges[at]) if at < len(edges) else high
        parts = min(int(np.ceil(times)), 1 << 12)
        added += [begin + (end - begin) * k // parts for k in range(1, parts)]
    return np.union1d(edges, _whole(np.array(added, dtype="int64"), heavy))


def place(units: list[tuple[int, list]], shards: int, target: float) -> tuple[list[tuple], np.ndarray]:
    """Largest first onto the emptiest shard: (unit's items, shard) and the bytes left in each shard."""
    loads = [(0, s) for s in range(shards)]
    placed = []
    for size, items in sorted(units, key=lambda u: (-u[0], u[1])):
        load, s = heapq.heappop(loads)
        placed += [(*item, s) for item in items]
        heapq.heappush(loads, (load + size, s))
    left = np.zeros(shards)
    for load, s in loads:
        left[s] = max(0.0, target - load)
    return placed, left


def shard(
    docs: DataFrame,
    shards: int = 40,
    ranges: int = RANGES,
    range_bytes: int = RANGE_BYTES,
    samples: int = SAMPLES,
    heavy: int = HEAVY,
) -> DataFrame:
    """`doc_id`, `size`, `text_crc32`, `law`, `shard`, `slot`, `grown_shard` for every document.

    The law is `bytes`: shards have nearly equal sizes, and equal texts share a
    shard unless they are more than one shard holds. `slot` numbers the records of
    a shard from 0 without gaps. Null texts count as empty and stand together;
    null ids and repeated rows are records like others (rows equal in id and text
    are never cut apart). An empty table gives no rows. Extra columns are not read.
    The driver sees the sample, a count per range, and the heavy texts, at most
    `heavy` x `shards`; it grows with the ranges (one per GB of text), not the rows.
    """
    spark = docs.sparkSession
    rows = settled(records(docs), "shard-records")
    total = rows.agg(F.sum("size")).first()[0]
    if total is None:
        return spark.createDataFrame([], SCHEMA)
    target = total / shards
    large = (
        rows.groupBy(_group(F.col("key")).alias("text"))
        .agg(F.sum("size").alias("bytes"))
        .filter(F.col("bytes") > target / heavy)
        .collect()
    )
    hot = np.array(sorted(r["text"] for r in large), dtype="int64")
    weights = {r["text"]: r["bytes"] for r in large}
    count = max(shards * ranges, -(-total // range_bytes))
    edges = splitters(rows, total, count, hot, samples)

    # a text's place among the hot ones, 0 for none: known by its key alone
    ends = np.unique(np.concatenate([hot << 24, (hot + 1) << 24])) if len(hot) else np.array([], dtype="int64")
    starts = pd.Series(np.isin(ends >> 24, hot)).to_numpy()

    @F.pandas_udf("boolean")
    def is_heavy(keys: pd.Series) -> pd.Series:
        at = np.searchsorted(ends, keys.to_numpy(), side="right") - 1
        return pd.Series((at >= 0) & starts[at]) if len(starts) else pd.Series(np.zeros(len(keys), bool))

    for _ in range(ROUNDS):
        ranged = rows.withColumn("range", _bin(edges, "int")("key")).withColumn("heavy", is_heavy("key"))
        cells = (
            ranged.groupBy("range", F.when(F.col("heavy"), _group(F.col("key"))).alias("text"))
            .agg(F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
            .collect()
        )
        filled: dict[int, list] = {}
        for c in cells:
            now = filled.setdefault(c["range"], [0, c["low"], c["high"]])
            filled[c["range"]] = [now[0] + c["bytes"], min(now[1], c["low"]), max(now[2], c["high"])]
        full = {at: b * count / total for at, (b, lo, hi) in filled.items() if b > 2 * total / count and lo < hi}
        finer = subdivided(edges, full, hot)
        if len(finer) == len(edges):
            break
        edges = finer

    units: dict[tuple, tuple[int, list]] = {}
    light: dict[int, int] = {}
    for c in cells:
        if c["text"] is None:
            light[c["range"]] = light.get(c["range"], 0) + c["bytes"]
        else:
            unit = (c["text"],) if weights[c["text"]] <= target else (c["text"], c["range"])
            size, items = units.get(unit, (0, []))
            units[unit] = (size + c["bytes"], [*items, (c["text"], c["range"])])
    placed, left = place(list(units.values()), shards, target)
    left = left if left.sum() else np.full(shards, target)
    cuts = np.cumsum(left * (max(1, sum(light.values())) / left.sum()))[:-1]
    offsets, at = [], 0
    for r in sorted(light):
        offsets.append((r, at))
        at += light[r]

    by_text = Window.partitionBy("range").orderBy("text")
    tail = ["doc_id", "size", "text_crc32", "key", "range", "shard"]
    ranged = ranged.withColumn("text", _group(F.col("key")))
    filling = (
        ranged.filter(~F.col("heavy"))
        .withColumn("upto", F.sum("size").over(by_text))  # equal texts are peers: all get the end of their text
        .withColumn("own", F.sum("size").over(Window.partitionBy("range", "text")))
        .join(F.broadcast(spark.createDataFrame(offsets, "range int, offset long")), "range")
        .withColumn("shard", _bin(cuts, "int")(F.col("offset") + F.col("upto") - F.col("own") / 2))
        .select(tail)
    )
    whole = (
        ranged.filter("heavy")
        .join(F.broadcast(spark.createDataFrame(placed, "text long, range int, shard int")), ["text", "range"])
        .select(tail)
    )
    sharded = settled(filling.unionByName(whole), "shard-ranges")
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    first = sharded.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    first = first.select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    number = F.row_number().over(Window.partitionBy("shard", "range").orderBy("key", "doc_id", "text_crc32"))
    return (
        sharded.withColumn("number", number)
        .join(F.broadcast(first), ["shard", "range"])  # one row per range and piece
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("number") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
