"""From raw documents to shards of training data: five stages, each one operator of `stockloom.llm`.

A stage takes (spark, docs, folder) and returns the documents it keeps, with the columns
they came with; the last returns each document's place. `run` writes every stage's rows to
the shared folder and reads them for the next, so a lost executor costs one stage at most.

Inside a stage a row is known by 64 bits of all its columns, not by its id: rows that share an id, or
have none, are told apart, and rows equal in every column share their fate. Helper columns take
names the documents do not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm import decontamination, mixing, near_dedup, quality, sharding
from stockloom.plans.joins import settled

ROW = "_pipeline_row"
TIMES = "_times"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _free(docs: DataFrame, name: str) -> str:
    """`name`, behind as many underscores as it takes to be a new column (names are not case-sensitive)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _own(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _known(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with each row's number, and that column's name."""
    row = _free(docs, ROW)
    parts = [part for c in _own(docs) for part in (c.isNull(), c)]
    return docs.withColumn(row, F.xxhash64(*parts)), row


def _by_row(docs: DataFrame) -> DataFrame:
    """The columns operators read, with the row's number in place of its id."""
    rows, row = _known(docs)
    return rows.select(F.col(row).alias("doc_id"), "text", "lang", "source")


def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose perplexity stays below their language's threshold. Those without text go."""
    rows, row = _known(docs)
    labels = _table(spark, folder, "labels").select("doc_id", "quality")
    trusted = rows.select("doc_id", row).join(labels, "doc_id").select(F.col(row).alias("doc_id"), "quality")
    kept = quality.judge(_by_row(docs), trusted).filter("kept").select(F.col("doc_id").alias(row))
    return rows.join(settled(kept, "quality-kept"), row, "left_semi").select(_own(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id; null ids come last, then the row decides."""
    rows, row = _known(docs)
    classes = near_dedup.near_duplicates(_by_row(docs)).select(F.col("doc_id").alias(row), "class_id").distinct()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)
    winners = (
        rows.select(row, "doc_id").join(classes, row).groupBy("class_id").agg(F.min(order)[row].alias(row)).select(row)
    )
    repeated = rows.select(row).groupBy(row).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not repeated.isEmpty():  # they meet map-side first, so one of a third of all rows is one row per task
        rows = rows.dropDuplicates([row])
    return rows.join(settled(winners, "near-winners"), row, "left_semi").select(_own(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontamination.find_items(_by_row(docs), _table(spark, folder, "benchmark"))
    rows, row = _known(docs)
    leaks = settled(found.select(F.col("doc_id").alias(row)).distinct(), "leaks")
    return rows.join(leaks, row, "left_anti").select(_own(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as often as the mix takes its words, to the nearest whole number of times."""
    rows, row = _known(docs)
    times = _free(docs, TIMES)
    taken = mixing.mix(_by_row(docs)).groupBy(F.col("doc_id").alias(row)).agg(F.sum("taken").alias("t"), F.sum("size").alias("s"))
    taken = taken.filter("s > 0").select(row, F.floor(F.col("t") / F.col("s") + 0.5).cast("int").alias(times))
    rows = rows.join(taken.filter(F.col(times) > 0), row)
    return rows.withColumn(times, F.explode(F.array_repeat(F.lit(1), F.col(times)))).select(_own(docs))


def sharding_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Shard and slot of every document of the mix."""
    return sharding.shard(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# Perplexities, sketches and samples are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, folder), f"stage-{name}")
    return docs
