"""Exact dedup by a heavy-hitter split, in DataFrame functions only.

A bounded frequent-items sketch (Misra-Gries counters, one per task, merged)
names the digests that may be frequent. Their exact counts and winners are
aggregated map-side, at most `heavy` rows, and broadcast: the copies of a frequent
text are settled where they were read and never shuffled. All other digests, none of
which is frequent, take the ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.plans.joins import settled

HEAVY = 256  # winners broadcast at most: 256 rows of 100 bytes
TRACKED = 4096  # counters of the sketch: finds every text with over 1/1000 of the rows


def exact_dedup(docs: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """One row per document: `doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Texts are equal when their UTF-8 bytes are; null counts as the empty text.
    Of equal texts the row with the largest doc_id stays (null is below every
    id); of rows that repeat both id and text one stays. `keep_id` is null only
    where all ids of a group are. An empty table gives no rows. Extra columns
    are not read. Whatever the sketch names, the result is the same: it only
    decides which way a row takes.
    """
    texts = settled(docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")), "exact-dedup")
    named = texts.agg(F.expr(f"approx_top_k(text_sha256, {heavy}, {tracked})").alias("top")).select(
        F.explode("top.item").alias("text_sha256")
    )
    winners = settled(
        texts.join(F.broadcast(named), "text_sha256")
        .groupBy("text_sha256")  # a row per task and digest is shuffled
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
        "exact-dedup-heavy",
    )
    frequent = texts.join(F.broadcast(winners), "text_sha256")
    wins = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    removed = frequent.filter(~wins).select(*columns, F.lit(False).alias("kept"))
    # rows that repeat a winner's id, and all rows of other texts, are counted before they are shuffled
    repeated = frequent.filter(wins).groupBy(columns).agg(F.count(F.lit(1)).alias("n"))
    rest = texts.join(F.broadcast(winners), "text_sha256", "left_anti")
    rest = rest.groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    groups = rest.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    ordinary = rest.join(groups, "text_sha256").select(*columns, "n")
    numbered = repeated.unionByName(ordinary).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    settled_rows = numbered.select(*columns, (wins & (F.col("copy") == 1)).alias("kept"))
    return removed.unionByName(settled_rows).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same
         AND row_number() OVER (PARTITION BY coalesce(text, ''), doc_id) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
