"""Last write wins per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.plans.joins import settled


def last_write_wins(df: DataFrame, keys: Sequence[str], version: Sequence[str] = (), keep_version: bool = False):
    """One row per key: the one with the largest version.

    The order is `version` first and then the remaining columns as they stand,
    so equal versions still give one definite row. It is a `max` of a struct:
    tasks reduce their own rows before the shuffle, so a hot key costs one row
    per task, and the row is kept whole.
    """
    values = [c for c in df.columns if c not in keys and c not in version]
    ranked = F.struct(*version, *values)
    kept = [c for c in df.columns if c not in keys and (keep_version or c not in version)]
    return (
        df.groupBy(*keys)
        .agg(F.max(ranked).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in kept])
    )


def merge_batch(current: DataFrame, batch: DataFrame, keys: Sequence[str], version: Sequence[str] = ()) -> DataFrame:
    """A table with one row per key after a later batch has been written to it.

    Every batch row replaces the row of its key. The current table is only
    anti-joined. The reduced batch is written out first: its size is then known,
    so a small one is broadcast and the current table is not shuffled.
    """
    latest = settled(last_write_wins(batch, keys, version).select(*current.columns), "batch")
    untouched = current.join(latest.select(*keys), list(keys), "left_anti")
    return untouched.select(*current.columns).unionByName(latest)
