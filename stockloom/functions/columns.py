"""Column rules: defaults for blanks, safe casts, day keys, date ranges."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Provider names of the day and symbol columns, lower case (fixed values).
DAY_NAMES = ("time", "tradingdate", "trading_date")
SYMBOL_NAMES = ("ticker",)
CANONICAL = {**dict.fromkeys(DAY_NAMES, "date"), **dict.fromkeys(SYMBOL_NAMES, "symbol")}

# Days of history read when no start is given (fixed value).
LOOKBACK_DAYS = 730

PRICE_MEASURES = ("open", "high", "low", "close")


def present(df: DataFrame, name: str, dtype: str) -> Column:
    """The column if the frame has it, else a typed null."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def text_or(df: DataFrame, name: str, default: str | Column = "") -> Column:
    """Text with null and '' replaced by the default."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(present(df, name, "string").cast("string"), F.lit("")), fallback)


def number_or_zero(df: DataFrame, name: str, dtype: str = "double") -> Column:
    """A number with null, or what is none, replaced by 0; NaN is a value and stays."""
    return F.coalesce(present(df, name, dtype).try_cast(dtype), F.lit(0).cast(dtype))


def unreadable(df: DataFrame, name: str, dtype: str = "double") -> Column:
    """Whether a value is there but is no number of the type."""
    value = present(df, name, dtype)
    return value.isNotNull() & value.try_cast(dtype).isNull()


def is_blank(col: Column) -> Column:
    return col.isNull() | (col == "")


def drop_blank_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key columns all hold text."""
    for key in keys:
        df = df.filter(~is_blank(F.col(key)))
    return df


def day_of(col: Column) -> Column:
    """The calendar day of a date, timestamp or ISO text; null if there is none."""
    return col.try_cast("date")


def number_of(col: Column) -> Column:
    """The number a value or text stands for; null if it stands for none.

    A type letter after the digits ("1.5d") is Java notation, not a number.
    """
    text = F.trim(col.cast("string"))
    return F.when(~text.rlike("[0-9.][dDfF]$"), col.try_cast("double"))


def whole(col: Column) -> Column:
    """A key number such as a year; null if it is none."""
    return col.try_cast("int")


def canonical_prices(df: DataFrame, symbol: str | None = None) -> DataFrame:
    """Provider price columns under the canonical names `date` and `symbol`, whatever their case.

    A frame with no symbol column is one symbol's extract and gets `symbol`.
    """
    named = [(c, CANONICAL.get(c.lower(), c)) for c in df.columns]
    targets = [target for _, target in named]
    if len(set(targets)) < len(targets):
        raise ValueError(f"more than one day or symbol column in {df.columns}")
    return with_symbol(df.select(*[F.col(c).alias(target) for c, target in named]), symbol)


def with_symbol(df: DataFrame, symbol: str | None) -> DataFrame:
    """Add a constant symbol where the extract has no such column."""
    if "symbol" in df.columns:
        return df
    if symbol is None:
        raise ValueError("the extract has no symbol column and no symbol was given")
    return df.withColumn("symbol", F.lit(symbol))


def coerce_prices(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Canonical price rows with declared types: day key, 0 for missing measures."""
    return df.select(
        F.col("symbol").cast("string").alias("symbol"),
        day_of(F.col("date")).alias("date"),
        *[number_or_zero(df, m).alias(m) for m in PRICE_MEASURES],
        number_or_zero(df, "volume", "bigint").alias("volume"),
        *extra,
    )


def statement_quarter(period: Column, quarter: Column) -> Column:
    """The quarter of a quarterly statement; 0 for a yearly one."""
    return F.when(period == "quarter", whole(quarter)).otherwise(F.lit(0))


def between_days(df: DataFrame, start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """Rows whose `date` lies in the inclusive range; an open side has no bound."""
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.filter(F.col("date") <= F.lit(str(end)).cast("date"))
    return df


def lookback(df: DataFrame, as_of: str | date, start: str | date | None = None, end: str | date | None = None):
    """The range read by default: up to `as_of`, from 730 days before it."""
    day = date.fromisoformat(str(as_of))
    first = start if start is not None else date.fromordinal(day.toordinal() - LOOKBACK_DAYS)
    return between_days(df, first, end if end is not None else day)


def on_day(df: DataFrame, as_of: str | date) -> DataFrame:
    return between_days(df, as_of, as_of)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Every decimal column as double."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; a missing one is a typed null."""
    return df.select(*[present(df, f.name, f.dataType).cast(f.dataType).alias(f.name) for f in schema.fields])


def iso_text(col: Column) -> Column:
    """ISO text of a timestamp, null kept."""
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
