"""Long and wide metrics, statement payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.functions.columns import number_of

PAYLOAD_TYPE = T.MapType(T.StringType(), T.DoubleType())


def long_metrics(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Wide metrics as (keys, metric, value): numbers only, nothing for the rest.

    Columns of days or times are no metrics. Text counts if it reads as a number.
    """
    not_numbers = (T.DateType, T.TimestampType, T.TimestampNTZType, T.ArrayType, T.MapType, T.StructType)
    metrics = [f for f in wide.schema.fields if f.name not in keys and not isinstance(f.dataType, not_numbers)]
    typed = wide.select(
        *keys,
        *[
            (number_of(F.col(f.name)) if isinstance(f.dataType, T.StringType) else F.col(f.name).cast("double")).alias(
                f.name
            )
            for f in metrics
        ],
    )
    rows = typed.unpivot(list(keys), [f.name for f in metrics], "metric", "value")
    return rows.filter(F.col("value").isNotNull())


def wide_metrics(long: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Long metrics as one column per named metric, newest period first.

    The metric names are given: finding them would cost a pass over the data. Each is a number of the group's one
    row from the start, so a task holds a row per group, not one per group and metric.
    """
    order = [F.desc(k) if k in ("year", "quarter") else F.asc(k) for k in keys]
    columns = [F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]
    return long.groupBy(*keys).agg(*columns).orderBy(*order)


def payload_map(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with its non-null metrics as a map.

    Needs one row per (key, metric); the group is then one statement.
    """
    entry = F.when(F.col("value").isNotNull(), F.struct("metric", "value"))
    entries = F.sort_array(F.collect_list(entry))
    return long.groupBy(*keys).agg(F.map_from_entries(entries).alias("payload"))


def payload_json(df: DataFrame) -> DataFrame:
    return df.withColumn("payload", F.to_json("payload"))


def payload_rows(df: DataFrame) -> DataFrame:
    """Payload text back as (metric, value) rows."""
    parsed = df.withColumn("payload", F.from_json("payload", PAYLOAD_TYPE))
    keys = [c for c in df.columns if c != "payload"]
    return parsed.select(*keys, F.explode("payload").alias("metric", "value"))
