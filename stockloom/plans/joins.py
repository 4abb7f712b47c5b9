"""Shapes for joins: hot keys, and small tables whose size the planner cannot guess."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.session import work_dir

SALTS = 32
PACKED = ("trades", "children", "holders", "measured", "edges", "facts", "load-")


def salted_join(many: DataFrame, one: DataFrame, key: str, spread_by: str, how: str = "inner", salts: int = SALTS):
    """Join `many` to `one`, which has one row per key, with hot keys spread out.

    Rows of `many` get a salt from `spread_by`, rows of `one` are repeated once
    per salt, so a key holding a third of `many` is shared by `salts` tasks.
    `one` grows by the factor `salts`, so this is for a `one` of a few short rows
    per key; elsewhere the adaptive skew join splits the hot partitions alone.
    """
    salted = many.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    repeated = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    For a table that several later steps start from: they read it instead of
    each computing it again, a lost executor costs them one read, and the
    planner knows its size, so it broadcasts the table only if it is small.
    Tables that are large and never sent out are written smaller; of others the planner goes by the size in files.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd" if purpose.startswith(PACKED) else "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
