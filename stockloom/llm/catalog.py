"""The operators as queries over the test tables, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm import (
    decontamination,
    exact_dedup,
    language,
    lexical_search,
    line_dedup,
    manifest,
    mixing,
    near_dedup,
    quality,
    quality_rules,
    sharding,
    substring_dedup,
    toxicity,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "mix_shard")


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    cleaned = line_dedup.remove_spread_lines(docs, F.col("source"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "evidence")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents")).drop("node")


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.verified(table(spark, folder, "documents"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_sharding,
        op2_mixing,
        op3_language_id,
        op4_quality,
        op5_line_dedup,
        op6_substring_dedup,
        op7_exact_dedup,
        op8_toxicity,
        op9_decontamination,
        op10_near_dedup,
        op11_manifest,
        op12_lexical_search,
        op13_quality_rules,
    ]
    return {fn.__name__: fn for fn in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mixing": mixing.ORACLE,
        "op5_line_dedup": line_dedup.ORACLE,
        "op6_substring_dedup": substring_dedup.ORACLE,
        "op7_exact_dedup": exact_dedup.ORACLE,
        "op11_manifest": manifest.ORACLE,
        "op12_lexical_search": lexical_search.ORACLE,
    }
