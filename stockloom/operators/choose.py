"""Which source a symbol's rows come from."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Providers asked after the configured one, in order (fixed value).
PROVIDERS = ("VCI", "KBS")


def fallback_by_key(primary: DataFrame, secondary: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Primary rows, and the secondary rows of keys the primary lacks altogether."""
    held = primary.select(*keys).distinct()
    rest = secondary.join(held, list(keys), "left_anti")
    return primary.unionByName(rest.select(*primary.columns))


def fallback_table(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """The primary table, or the secondary one when the primary has no rows."""
    return primary.unionByName(secondary.select(*primary.columns).filter(~primary.exists()))


def provider_chain(configured: str, others: Sequence[str] = PROVIDERS) -> list[str]:
    """Providers in the order they are asked, each once."""
    return list(dict.fromkeys([configured, *others]))


def first_source(sources: Sequence[DataFrame], key: str = "symbol") -> DataFrame:
    """Per key, all rows of the first source that has any.

    `priority` tells which source it was, from 1.
    """
    ranked = [s.withColumn("priority", F.lit(i)) for i, s in enumerate(sources, start=1)]
    rows = reduce(DataFrame.unionByName, ranked)
    best = rows.groupBy(key).agg(F.min("priority").alias("priority"))
    return rows.join(best, [key, "priority"], "left_semi")


def resolve_symbols(requested: DataFrame | Sequence[str] | None, primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """The symbols of a load: those asked for, else the master's, else the listing's."""
    if isinstance(requested, DataFrame):
        return requested.select("symbol").distinct()
    if requested is not None:
        spark = primary.sparkSession
        return spark.createDataFrame([(s,) for s in dict.fromkeys(requested)], "symbol string")
    return fallback_table(primary.select("symbol"), secondary.select("symbol")).distinct()
