"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("size", "key", "node", "label", "shard", "n", "target", "taken", "chunk", "range", "kept", "h", "bits", "gone")


def prose(words: int, seed: int = 1, vocabulary: int = 300) -> str:
    lucky = random.Random(seed)
    return " ".join(f"w{lucky.randrange(vocabulary)}x{lucky.randrange(9)}" for _ in range(words))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(doc_id, text, lang, source) rows, with further columns whose names operators use themselves."""
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    return df.select("*", *(F.lit("extra").alias(c) for c in CLASHING))


def awkward_rows() -> list[tuple]:
    copied = prose(60, 2)
    return [
        (1, prose(80, 1), "en", "a"),
        (1, prose(80, 1), "en", "a"),  # repeated row
        (2, copied, "en", "a"),
        (3, copied, "de", "b"),  # ties: equal texts
        (4, copied, None, None),
        (5, "", "en", "b"),
        (6, None, "fr", "b"),
        (7, None, None, None),
        (None, prose(70, 3), "en", "b"),
        (None, None, None, None),
        (8, " \t\n ", "en", "c"),
        (9, prose(40_000, 4, 5000), "en", "c"),  # very long
        (10, "one two", "en", "c"),
        (10, "other text under one id", "en", "c"),
        (11, "日本語 テキスト ü ß é", "fr", ""),
        (12, "!!! ??? 123", "en", "a"),
    ]


def awkward(spark: SparkSession) -> DataFrame:
    return documents(spark, awkward_rows())


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [])


def labels(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def stored(df: DataFrame, folder) -> DataFrame:
    df.write.parquet(str(folder))
    return df.sparkSession.read.schema(df.schema).parquet(str(folder))
