"""Stored facts whose validity is kept up to date as later and late facts arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.operators.facts import closed, month_starts
from stockloom.operators.upsert import last_write_wins
from stockloom.plans.joins import settled
from stockloom.sources.store import read_tables, state, write_tables

ABOUT = ("subject", "predicate")
ORDER = ("valid_at", "seq")


def merge_facts(
    load: DataFrame, root: str, about: Sequence[str] = ABOUT, order: Sequence[str] = ORDER, mark: str | None = None
) -> int:
    """Facts written to the store, with the intervals closed that they end; the version.

    Facts with the same `about` and `order` are one, the later load's. Only months that the load has facts in, and for
    each subject of the load the last month with facts before one of those, can change; the store is kept by month, so
    no other month is read or written. The first fact of each subject's month is stored as well: it tells which
    months those are, and where a month's last fact ends. A load with a known mark is left out.
    """
    about, order = list(about), list(order)
    spark = load.sparkSession
    stored = state(spark, root)
    if mark is not None and stored and mark in stored.marks:
        return stored.version
    key = list(dict.fromkeys([*about, *order]))
    load = settled(last_write_wins(load.filter(F.col("valid_at").isNotNull()), key), "new-facts")
    new = settled(month_starts(load, about), "new-months")
    subjects = new.select(*about).distinct()
    months = new
    if stored:
        (held,) = read_tables(spark, root, "fact_months")
        held = held.drop("load").join(subjects, about, "left_semi")  # the months of the load's subjects
        months = held.unionByName(new).groupBy(*about, "_month").agg(F.min("_first").alias("_first"))
    months = settled(months, "fact-months")
    spans = months.join(new.select(*about, F.col("_month").alias("_new")), [*about], "inner")
    before = spans.filter(F.col("_month") < F.col("_new")).groupBy(*about, "_new").agg(F.max("_month").alias("_month"))
    touched = new.select(*about, "_month").unionByName(before.select(*about, "_month")).distinct()
    touched = settled(touched, "touched-months")
    rows = load
    if stored:
        names = [r.part for r in touched.select(F.date_format("_month", "yyyy-MM").alias("part")).distinct().collect()]
        (old,) = read_tables(spark, root, "fact", parts=names)
        old = old.drop("load", "invalid_at").withColumn("_month", F.trunc("valid_at", "month"))
        old = old.join(touched, [*about, "_month"], "left_semi").drop("_month").join(load.select(key), key, "left_anti")
        rows = rows.unionByName(old)
    facts = closed(rows, months, about, order)
    return write_tables({"fact": facts, "fact_months": months}, root, mark=mark, keys={"fact": key, "fact_months": [*about, "_month"]})


def read_facts(spark: SparkSession, root: str) -> DataFrame:
    """The stored facts with `valid_at` and `invalid_at`."""
    return read_tables(spark, root, "fact")[0].drop("load")
