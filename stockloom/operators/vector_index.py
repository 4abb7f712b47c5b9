"""A stored inverted file over vectors: cells around centroids, searched until a bound rules the rest out.

Centroids are learned from a bounded sample. A vector is stored with the cell of the nearest one, cells as parts
of the store, and each cell knows the widest angle between its centroid and a vector of its own. No vector of a cell can be
nearer to a query than the angle to its centroid less that width, so cells are read in the order
of that bound until the k-th similarity found is above it: the result is exact.
With `share` below 1 a query stops after that share of the vectors, and the result is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockloom.operators.search import SCORE_DIGITS, _directed, top_per_query
from stockloom.plans.joins import settled
from stockloom.sources.store import read_tables, stored_parts, write_tables

SAMPLE = 16384  # vectors that centroids are learned from, at most
CELLS = 64
ROUNDS = 12
PIECE = 8192  # vectors of a cell that one task compares, about
FIRST = 2  # cells read in the first round; each further one reads as many again


def _unit(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    vectors = flat.reshape(len(column), -1)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def centroids(vectors: np.ndarray, cells: int = CELLS, rounds: int = ROUNDS) -> np.ndarray:
    """Directions of about `cells` groups of unit vectors: farthest-first starts, then means."""
    starts = [0]
    near = vectors @ vectors[0]
    while len(starts) < min(cells, len(vectors)) and near.min() < 1 - 1e-9:
        starts.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[starts[-1]])
    found = vectors[starts]
    for _ in range(rounds):
        own = (vectors @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, own, vectors)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), found)
    return found


def build(
    vectors: DataFrame, root: str, item: str = "item_id", vector: str = "embedding", cells: int = CELLS, sample: int = SAMPLE
) -> int:
    """Vectors (item, vector) stored by cell below `root`, in place of what was there; the version.

    The sample is the `sample` vectors of the smallest hash. Vectors without a direction are left out.
    """
    spark = vectors.sparkSession
    rows, _ = _directed(vectors, vectors.select(F.col(item).alias("_q"), vector), item, "_q", vector)
    drawn = rows.orderBy(F.xxhash64(item), item).limit(sample).select(vector).toArrow()
    middle = centroids(_unit(drawn.column(0).combine_chunks()), cells) if len(drawn) else np.zeros((0, 0))
    sent = spark.sparkContext.broadcast(middle)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                like = _unit(batch.column(1)) @ sent.value.T
                cell = like.argmax(axis=1)
                angle = np.arccos(np.clip(like[np.arange(len(cell)), cell], -1, 1))
                columns = [batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(angle)]
                yield pa.RecordBatch.from_arrays(columns, [item, vector, "cell", "angle"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in (item, vector)}
    placed = rows.mapInArrow(place, f"{item} {kinds[item]}, {vector} {kinds[vector]}, cell int, angle double")
    placed = settled(placed, "vector-cells")
    about = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("width"))
    middles = pa.table({"cell": pa.array(np.arange(len(middle), dtype=np.int32)), "middle": pa.array(list(middle), pa.list_(pa.float64()))})
    about = about.join(spark.createDataFrame(middles), "cell")
    return write_tables({"vector_cells": placed.drop("angle"), "vector_middles": about}, root, merge=False)


def _probes(queries: DataFrame, about: pa.Table, query: str, vector: str, share: float) -> DataFrame:
    """(query, cell, place, bound): a query's cells by the best similarity that a vector of theirs can have."""
    cell, n, width = (about.column(c).to_numpy() for c in ("cell", "n", "width"))
    middle = np.array(about.column("middle").to_pylist())
    sent = queries.sparkSession.sparkContext.broadcast((cell, n, width, middle))

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, n, width, middle = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            angle = np.arccos(np.clip(_unit(batch.column(1)) @ middle.T, -1, 1))
            bound = np.cos(np.maximum(angle - width - 1e-7, 0))  # the arc cosine is good to seven places
            by = np.argsort(angle if share < 1 else -bound, axis=1, kind="stable")
            before = np.cumsum(n[by], axis=1) - n[by]
            use = before < share * n.sum()
            rows, place = np.nonzero(use)
            own = by[rows, place]
            columns = [batch.column(0).take(pa.array(rows)), pa.array(cell[own]), pa.array(place.astype(np.int32)), pa.array(bound[rows, own])]
            yield pa.RecordBatch.from_arrays(columns, [query, "cell", "place", "bound"])

    kind = queries.schema[query].dataType.simpleString()
    return queries.select(query, vector).mapInArrow(order, f"{query} {kind}, cell int, place int, bound double")


def search(
    queries: DataFrame,
    root: str,
    k: int = 10,
    share: float = 1.0,
    item: str = "item_id",
    query: str = "query_id",
    vector: str = "embedding",
    read: list | None = None,
) -> DataFrame:
    """(query, item, score, rank): the `k` most similar stored vectors, like `search.vector_topk` where `share` is 1.

    Rounds read twice as many cells as the one before, for the queries that still need it: those whose k-th
    similarity is not above the bound of their next cell. A round reads only the parts of its cells and
    joins queries to them by cell and piece. With a share, cells go by the angle to their centroid.
    `read` is given, round by round, the number of (query, vector) pairs compared.
    """
    spark = queries.sparkSession
    about = read_tables(spark, root, "vector_middles")[0].toArrow()  # a row per cell
    kinds = {item: dict(read_tables(spark, root, "vector_cells")[0].dtypes)[item], query: dict(queries.dtypes)[query]}
    if not len(about):
        return spark.createDataFrame([], f"{query} {kinds[query]}, {item} {kinds[item]}, score double, rank int")
    _, queries = _directed(queries, queries, query, query, vector)
    probes = settled(_probes(queries, about, query, vector, share), "probes")
    vectors = queries.select(query, F.col(vector).alias("_asked"))
    sizes = spark.createDataFrame(about.select(["cell", "n"])).withColumn("_pieces", F.ceil(F.col("n") / PIECE).cast("int"))
    parts, best = set(stored_parts(spark, root, "vector_cells")), None
    last = probes.agg(F.max("place")).first()[0]
    open_, begin, end = probes.select(query).distinct(), 0, FIRST
    while last is not None and begin <= last and not open_.isEmpty():
        now = probes.filter((F.col("place") >= begin) & (F.col("place") < end)).join(open_, query, "left_semi")
        now = settled(now.join(sizes, "cell").select(query, "cell", "_pieces", "n"), "probes-now")
        cells = [r.cell for r in now.select("cell").distinct().collect()]  # at most one for each centroid
        held = read_tables(spark, root, "vector_cells", parts=sorted(parts & {f"c{c:05d}" for c in cells}))[0]
        held = held.join(F.broadcast(sizes.select("cell", "_pieces")), "cell")
        held = held.withColumn("piece", F.pmod(F.xxhash64(item), F.col("_pieces")).cast("int"))
        asked = now.join(vectors, query).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        asked = asked.select("cell", "piece", query, "_asked")
        both = asked.groupBy("cell", "piece").cogroup(held.select("cell", "piece", item, vector).groupBy("cell", "piece"))
        found = both.applyInArrow(_compare(k, item, query, vector), f"{query} {kinds[query]}, {item} {kinds[item]}, score double")
        if read is not None:
            read.append(now.agg(F.sum("n")).first()[0] or 0)
        best = found if best is None else best.unionByName(found)
        best = settled(top_per_query(best, item, k, query).drop("rank"), "best_vectors")
        bars = best.groupBy(query).agg(F.min("score").alias("bar"), F.count("*").alias("held"))
        ahead = probes.filter(F.col("place") >= end).groupBy(query).agg(F.max("bound").alias("bound"))
        still = (F.col("held") < k) | F.col("held").isNull() | (F.col("bar") <= F.round("bound", SCORE_DIGITS) + 10**-SCORE_DIGITS)
        open_ = settled(ahead.join(bars, query, "left").filter(still).select(query), "open_queries")
        begin, end = end, 2 * end
    if best is None:
        return spark.createDataFrame([], f"{query} {kinds[query]}, {item} {kinds[item]}, score double, rank int")
    return top_per_query(best, item, k, query)


def _compare(k: int, item: str, query: str, vector: str):
    """The best `k` of one piece of a cell for each query that reads it."""

    def compare(asked: pa.Table, held: pa.Table) -> pa.Table:
        names = [query, item, "score"]
        own = pa.table({query: asked.column(query).slice(0, 0), item: held.column(item).slice(0, 0), "score": pa.array([], pa.float64())})
        if not len(asked) or not len(held):
            return own
        vectors = _unit(held.column(vector).combine_chunks())
        wanted = _unit(asked.column("_asked").combine_chunks())
        ids = held.column(item).to_numpy()
        ids = ids.astype(str) if ids.dtype == object else ids
        order = np.argsort(ids, kind="stable")
        q, at, scores = [], [], []
        for i in range(0, len(wanted), 512):
            s = np.round(vectors[order] @ wanted[i : i + 512].T, SCORE_DIGITS) + 0.0
            for j in range(s.shape[1]):
                top = np.argsort(-s[:, j], kind="stable")[:k]  # equal ones by id
                q.append(np.full(len(top), i + j))
                at.append(order[top])
                scores.append(s[top, j])
        take = lambda column, places: column.combine_chunks().take(pa.array(np.concatenate(places)))
        return pa.table([take(asked.column(query), q), take(held.column(item), at), pa.array(np.concatenate(scores))], names=names)

    return compare


def recall(found: DataFrame, exact: DataFrame, item: str = "item_id", query: str = "query_id") -> float:
    """The share of `exact` (query, item) pairs that `found` has."""
    hit = exact.select(query, item).join(found.select(query, item), [query, item], "left_semi").count()
    return hit / max(exact.count(), 1)
