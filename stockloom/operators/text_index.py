"""A stored text index: postings by word, kept in blocks with bounds, appended load by load.

A load splits its texts once. What it leaves are, by word, blocks of items with about the same weight of
the word, each with the bounds of its postings; how many items have a word; and for each item its length and counted
words. A search reads the bounds of its words' blocks, opens the few that can matter, and scores the
items in them by their counted words, each item once for all queries. No text is read again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockloom.operators.search import K1, SCORE_DIGITS, B, WordScores, words
from stockloom.plans.joins import settled
from stockloom.sources.store import read_tables, state, stored_parts, write_tables

BLOCK = 64  # postings of a block, about
LEVELS = 24  # classes of weight in which a word's postings are put into blocks
SEEDS = 6  # blocks opened per query for a first k-th score
SLACK = 2 * 10**-SCORE_DIGITS  # rounding of scores


def _saturated(tf: Column, ratio: Column, mean) -> Column:
    """A word's weight before its idf, from its count and the text's length over that count; falls with the ratio."""
    return (K1 + 1) / (1 + K1 * ((1 - B) / tf + B * ratio / mean))


def append_texts(corpus: DataFrame, root: str, item: str = "item_id", text: str = "text", mark: str | None = None) -> int:
    """Texts added to the index below `root`; the version. Items that are there already are an error.

    Blocks are made by classes of weight and, inside one, by a hash of the item, so a word that
    every text has is as many groups as it has blocks. A load with a known mark is left out.
    """
    spark = corpus.sparkSession
    stored = state(spark, root)
    if mark is not None and stored and mark in stored.marks:
        return stored.version
    empty = F.array().cast("array<string>")
    split = corpus.select(F.col(item).alias("item"), F.coalesce(words(text), empty).alias("_words"))
    kind = split.schema["item"].dataType.simpleString()
    counts = f"item {kind}, length int, counts array<struct<word: string, tf: int>>"
    items = settled(split.mapInArrow(_counted_words(), counts).withColumn("counts", F.sort_array("counts")), "index-items")
    twice = corpus.groupBy(F.col(item).alias("item")).count().filter("count > 1").select("item")
    if stored:
        (held,) = read_tables(spark, root, "text_items")
        twice = twice.unionByName(items.select("item").join(held.select("item"), "item", "left_semi"))
    if not twice.isEmpty():
        raise ValueError(f"item {twice.first()[0]} is indexed already")
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("total"))
    mean = max(1.0, size.select((F.col("total") / F.greatest("n", F.lit(1))).alias("mean")).first()["mean"])
    ratio = F.col("length") / F.col("tf")
    level = F.floor(_saturated(F.col("tf"), ratio, mean) * (LEVELS / (K1 + 1))).cast("int")
    counted = items.select("item", "length", F.inline("counts"))
    postings = counted.select("word", "item", "tf", ratio.alias("ratio"), level.alias("level"))
    many = postings.groupBy("word", "level").agg(F.count("*").alias("n"))
    large = many.filter(F.col("n") > BLOCK).select("word", "level", F.ceil(F.col("n") / BLOCK).cast("int").alias("pieces"))
    placed = postings.join(settled(large, "index-large"), ["word", "level"], "left")
    piece = F.pmod(F.xxhash64("item"), F.coalesce("pieces", F.lit(1)))
    blocks = placed.groupBy("word", "level", piece.cast("int").alias("piece")).agg(
        F.max("tf").alias("most"), F.min("ratio").alias("least"), F.collect_list("item").alias("items")
    )
    frequencies = many.groupBy("word").agg(F.sum("n").alias("df"))
    tables = {"text_items": items, "text_blocks": blocks, "text_words": frequencies, "text_size": size}
    return write_tables(tables, root, mark=mark, append=True)


def _counted_words():
    """Items with their words as items with a length and counted words; a text is one row, so its words are counted in place."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_words")
            length = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int32)
            coded = lists.flatten().dictionary_encode()
            size = max(len(coded.dictionary), 1)
            row = np.repeat(np.arange(len(length)), length)
            pairs, tf = np.unique(row * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            spelt = coded.dictionary.take(pa.array(pairs % size))
            own = pa.StructArray.from_arrays([spelt, pa.array(tf.astype(np.int32))], ["word", "tf"])
            offsets = np.searchsorted(pairs // size, np.arange(len(length) + 1)).astype(np.int32)
            columns = [batch.column("item"), pa.array(length), pa.ListArray.from_arrays(pa.array(offsets), own)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "length", "counts"])

    return count


def _of_words(spark: SparkSession, root: str, name: str, asked: DataFrame) -> DataFrame:
    """A table kept by word, in the parts that the asked words are in."""
    bucket = F.format_string("b%02d", F.pmod(F.xxhash64("word"), F.lit(16)))
    wanted = {r.bucket for r in asked.select(bucket.alias("bucket")).distinct().collect()}
    parts = [p for p in stored_parts(spark, root, name) if p.split(".")[0] in wanted]
    return read_tables(spark, root, name, parts=parts)[0]


class Search:
    """One table of queries (query_id, text) against a stored index."""

    def __init__(self, queries: DataFrame, root: str, query: str = "query_id", text: str = "text") -> None:
        self.spark, self.root, self.query = queries.sparkSession, root, query
        asked = settled(queries.select(query, F.explode(F.array_distinct(words(text))).alias("word")), "query_words")
        size = read_tables(self.spark, root, "text_size")[0].agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
        self.n, self.mean = size.n or 0, (size.total or 0) / max(size.n or 0, 1)
        df = _of_words(self.spark, root, "text_words", asked).join(asked.select("word").distinct(), "word")
        df = df.groupBy("word").agg(F.sum("df").alias("df"))
        idf = F.log(1 + (self.n - F.col("df") + 0.5) / (F.col("df") + 0.5))
        self.terms = settled(asked.join(df, "word").select(query, "word", idf.alias("idf")), "query_terms")
        self.blocks = _of_words(self.spark, root, "text_blocks", asked)
        self.items = read_tables(self.spark, root, "text_items")[0].select("item", "length", "counts")
        self.df = settled(df, "word_counts")
        self.ranking = WordScores(self.items, self.terms, "item", query, stats=self._stats)

    def _stats(self, vocabulary: pa.Array):
        """What the index knows of a block's words."""
        wanted = self.spark.createDataFrame(pa.table({"word": vocabulary, "place": pa.array(range(len(vocabulary)))}))
        held = self.df.join(F.broadcast(wanted), "word").select("place", "df").toArrow().to_pydict()
        df = np.zeros(len(vocabulary))
        df[held["place"]] = held["df"]
        return self.n, self.mean * self.n, df

    def bounds(self) -> DataFrame:
        """Every block of the queries' words: what it can add to a score, and with the words after its own.

        A query's words go by the most they can add. An item is looked for in the blocks of the first of them it
        has, so what it can reach is what that block can add and the most of all words after it.
        """
        most = F.col("idf") * _saturated(F.col("most"), F.col("least"), self.mean)
        rows = self.blocks.select("word", "level", "piece", "load", "most", "least").join(self.terms, "word")
        rows = rows.select(self.query, "word", "level", "piece", "load", most.alias("adds"))
        best = rows.groupBy(self.query, "word").agg(F.max("adds").alias("best"))
        after = W.partitionBy(self.query).orderBy(F.desc("best"), "word").rowsBetween(1, W.unboundedFollowing)
        rest = best.select(self.query, "word", F.coalesce(F.sum("best").over(after), F.lit(0.0)).alias("rest"))
        return rows.join(rest, [self.query, "word"]).withColumn("bound", F.col("adds") + F.col("rest"))

    def items_in(self, opened: DataFrame) -> DataFrame:
        """The distinct (query, item) pairs of some blocks."""
        key = ["word", "level", "piece", "load"]
        held = self.blocks.select(*key, "items").join(opened.select(self.query, *key), key)
        return held.select(self.query, F.explode("items").alias("item")).distinct()

    def best_in(self, opened: DataFrame, k: int) -> DataFrame:
        """(query, item, score, rank): the best `k` of the items in some blocks, each scored once, for all queries."""
        key = ["word", "level", "piece", "load"]
        held = self.blocks.select(*key, "items").join(opened.select(*key).distinct(), key, "left_semi")
        own = settled(held.select(F.explode("items").alias("item")).distinct(), "opened_items")
        return self.ranking.topk(k, self.items.join(own, "item", "left_semi"))

    def opened(self, k: int) -> DataFrame:
        """The (query, block) pairs whose items may be among the best `k`: those that can reach the k-th score so far."""
        bounds = settled(self.bounds(), "block_bounds")
        place = W.partitionBy(self.query).orderBy(F.desc("adds"), "word", "level", "piece", "load")
        seeds = bounds.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") <= SEEDS)
        first = settled(self.best_in(seeds, k), "first_hits")
        bars = first.filter(F.col("rank") == k).select(self.query, F.col("score").alias("bar"))
        reach = F.coalesce(F.col("bar"), F.lit(0.0)) - SLACK
        opened = bounds.join(bars, self.query, "left").filter(F.col("bound") >= reach)
        return settled(opened.select(self.query, "word", "level", "piece", "load"), "opened_blocks")

    def candidates(self, k: int) -> DataFrame:
        """The (query, item) pairs that may be among the best `k`: all that blocks above the k-th score so far hold."""
        return settled(self.items_in(self.opened(k)), "candidates")

    def topk(self, k: int) -> DataFrame:
        """(query, item, score, rank): the best `k`, score descending, then item."""
        return self.best_in(self.opened(k), k)


def bm25_stored(queries: DataFrame, root: str, item: str = "item_id", k: int = 10, query: str = "query_id") -> DataFrame:
    """The BM25 ranking of the indexed texts, the same as `search.bm25_topk` over all of them."""
    rows = Search(queries, root, query).topk(k)
    return rows.select(query, F.col("item").alias(item), "score", "rank")
