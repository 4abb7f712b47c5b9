"""Quality by an n-gram model of trusted text: perplexity under interpolated modified Kneser-Ney smoothing.

The model counts strings of four bytes in all trusted texts. Its tables, a
probability per string and an interpolation weight per context for each
order, are made by sharded joins of counts and stay distributed; chunks of documents
ask them for the strings they hold (`string_costs`), which gives each document's code length.

A document's bits per byte, drawn to its language's mean by `SHRINK` bytes' worth, must not
exceed its language's threshold: the upper quantile of what the language's trusted documents have above that
mean, drawn to the same quantile over all languages by `SHRINK_DOCS` documents' worth.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm import bitmaps
from stockloom.llm.arrow_text import PAD, STRING, byte_strings
from stockloom.llm.string_costs import sum_costs
from stockloom.plans.joins import settled

QUANTILE = 0.998
SHRINK = 200  # bytes
SHRINK_DOCS = 20  # trusted documents
LEAST_DISCOUNT = 0.1
MOST_LANGUAGES = 10_000  # rows of some 30 bytes broadcast


def count_strings(texts: DataFrame) -> DataFrame:
    """(`gram`, `n`) over all rows of (`text`), padded; tasks add up their own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            return grams, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)

        for batch in batches:
            for _, _, grams, _ in byte_strings(batch.column("text")):
                parts.append(np.unique(grams, return_counts=True))
                if len(parts) > 32:
                    parts = [merged()]
        if parts:
            grams, n = merged()
            yield pa.record_batch({"gram": pa.array(grams.astype(np.int64)), "n": pa.array(n)})

    return texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _tail(gram: Column, size: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << 8 * size) - 1))


def _head(gram: Column) -> Column:
    return F.shiftright(gram, 8)


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ from how many strings were seen once, twice, three and four times."""
    seen = {r["n"]: r["count"] for r in counts.filter("n <= 4").groupBy("n").count().collect()}
    once, twice = seen.get(1, 0), seen.get(2, 0)
    y = once / (once + 2 * twice) if once else 0.5
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * seen.get(k + 1, 0) / seen[k] if seen.get(k) else k / 2
        out.append(min(max(d, LEAST_DISCOUNT), k))
    return out


def model(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Per order from 1: (`gram`, `p`) of the strings seen and (`context`, `weight`) of the next lower order.

    The highest order has the counts; a lower one counts the distinct bytes seen before a string.
    """
    levels = []
    for size in range(STRING, 0, -1):
        counts = settled(counts, f"strings-{size}")
        one, two, more = _discounts(counts)
        off = F.when(F.col("n") == 1, one).when(F.col("n") == 2, two).otherwise(more)
        contexts = settled(
            counts.groupBy(_head(F.col("gram")).alias("context"))
            .agg(F.sum("n").alias("total"), F.sum(off).alias("off"))
            .select("context", "total", (F.col("off") / F.col("total")).alias("weight")),
            f"contexts-{size}",
        )
        own = counts.withColumn("context", _head(F.col("gram"))).join(contexts, "context")
        levels.append((own.select("gram", ((F.col("n") - off) / F.col("total")).alias("own"), "weight"), contexts))
        counts = counts.groupBy(_tail(F.col("gram"), size - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    tables: list[tuple[DataFrame, DataFrame]] = []
    for size, (own, contexts) in enumerate(reversed(levels), 1):
        if size == 1:
            p = own.select("gram", (F.col("own") + F.col("weight") / 256).alias("p"))
        else:
            lower = tables[-1][0].select(F.col("gram").alias("tail"), F.col("p").alias("lower"))
            p = own.withColumn("tail", _tail(F.col("gram"), size - 1)).join(lower, "tail")
            p = p.select("gram", (F.col("own") + F.col("weight") * F.col("lower")).alias("p"))
        tables.append((settled(p, f"kneser-ney-{size}"), contexts.select("context", "weight")))
    return tables


def resolve(grams: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(`gram`, `bits`) for distinct strings: of the longest order that has seen the string, else through its weights."""
    p = None
    for size, (seen, contexts) in enumerate(tables, 1):
        tail = _tail(F.col("gram"), size)
        grams = grams.join(seen.select(F.col("gram").alias(f"g{size}"), F.col("p").alias(f"p{size}")), tail == F.col(f"g{size}"), "left")
        own = contexts.select(F.col("context").alias(f"c{size}"), F.col("weight").alias(f"w{size}"))
        grams = grams.join(own, _head(tail) == F.col(f"c{size}"), "left")
        lower = F.lit(1 / 256) if p is None else p
        p = F.coalesce(f"p{size}", F.coalesce(f"w{size}", F.lit(1.0)) * lower)
    return grams.select("gram", (-F.log2(p)).cast("float").alias("bits"))


def code_lengths(docs: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(`doc_id`, `lang`, `n`, `bits`) of every document: bytes and code length."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.concat(F.lit(PAD), F.coalesce("text", F.lit(""))).alias("text"),
    )
    costs = sum_costs(rows, lambda grams: resolve(grams, tables).select("gram", F.array("bits").alias("costs")))
    return costs.select("doc_id", "lang", "n", F.col("costs")[0].alias("bits"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def trusted_texts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Padded texts of the trusted documents; a filter of their ids thins the texts before the exact join.

    The ids grow with the labels, so they are merged at every size and never broadcast.
    """
    bits = bitmaps.bits_for(trusted.count())
    wanted = docs.sparkSession.sparkContext.broadcast(bitmaps.bitmap(trusted, bits))

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(bitmaps.has(wanted.value, batch.column("doc_id").to_numpy(), bits)))

    rows = docs.filter("doc_id IS NOT NULL AND text <> ''").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.concat(F.lit(PAD), "text").alias("text")
    )
    return rows.mapInArrow(thin, "doc_id long, text string").join(trusted.hint("merge"), "doc_id", "left_semi").select("text")


def _few(languages: DataFrame) -> DataFrame:
    """A table with a row per language, broadcast unless there are very many: no task then gets a whole language."""
    return F.broadcast(languages) if languages.count() <= MOST_LANGUAGES else languages


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, shrink: int = SHRINK) -> DataFrame:
    """`doc_id`, `lang`, `n_bytes`, `perplexity` (per byte), `score`, `threshold`, `kept` for every document.

    Trusted are documents whose label says quality 1; all of them are counted. `score`
    is the shrunk number of bits per byte. Kept is a document whose score is at most its
    language's threshold; a null language, or one without trusted documents, is held to
    the mean and quantile over all. A document without text has
    no perplexity and is not kept. Without trusted text nothing is measured and every
    document with text is kept. Null ids and repeated rows are documents like
    others; an empty table gives no rows; extra columns are not read.
    """
    trusted = settled(trusted_ids(labels), "trusted")
    counts = settled(count_strings(trusted_texts(docs, trusted)), "strings")
    if counts.isEmpty():
        filled = F.coalesce(F.octet_length("text"), F.lit(0))
        return docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("lang").cast("string").alias("lang"),
            filled.cast("long").alias("n_bytes"),
            *(F.lit(None).cast("double").alias(c) for c in ("perplexity", "score", "threshold")),
            (filled > 0).alias("kept"),
        )
    lengths = settled(code_lengths(docs, model(counts)), "code-lengths")
    known = lengths.filter("n > 0").join(trusted, "doc_id", "left_semi")
    means = known.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.sum("bits").alias("b"), F.sum("n").alias("s"))
    means = settled(means, "language-means")  # a row per language
    all_of = means.agg(F.sum("b") / F.sum("s")).first()[0]
    # drawn to the mean over all languages by as many bytes as `SHRINK_DOCS` documents are drawn
    weight = SHRINK_DOCS * shrink
    means = means.filter("lang IS NOT NULL").select(
        F.col("lang").alias("l"), "docs", ((F.col("b") + weight * all_of) / (F.col("s") + weight)).alias("mean")
    )

    def scored(rows: DataFrame) -> DataFrame:
        mean = F.coalesce("mean", F.lit(all_of))
        score = F.round((F.col("bits") + shrink * mean) / (F.col("n") + shrink), 4)
        rows = rows.join(_few(means), F.col("lang") == F.col("l"), "left").withColumn("score", score)
        return rows.withColumn("mean", F.round(mean, 4)).withColumn("excess", F.col("score") - F.col("mean"))

    # rounded scores take a bounded number of values, so exact quantiles stay small
    above = F.percentile("excess", quantile)
    overall = scored(known).agg(above).first()[0]
    own = scored(known).filter("l IS NOT NULL").groupBy("l").agg(above.alias("above"), F.first("docs").alias("docs"))
    drawn = (F.col("docs") * F.col("above") + SHRINK_DOCS * F.lit(overall)) / (F.col("docs") + SHRINK_DOCS)
    own = settled(own.select(F.col("l").alias("l2"), drawn.alias("limit")), "language-limits")
    return (
        scored(lengths)
        .join(_few(own), F.col("l") == F.col("l2"), "left")
        .withColumn("threshold", F.round(F.col("mean") + F.coalesce("limit", F.lit(overall)), 4))
        .select(
            "doc_id",
            "lang",
            F.col("n").alias("n_bytes"),
            F.when(F.col("n") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("n"))).alias("perplexity"),
            F.when(F.col("n") > 0, F.col("score")).alias("score"),
            "threshold",
            ((F.col("n") > 0) & (F.col("score") <= F.col("threshold"))).alias("kept"),
        )
    )
