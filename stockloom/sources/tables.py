"""Readers and scans over the source tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom import schemas
from stockloom.functions import columns as C
from stockloom.operators.reshape import long_metrics

Symbols = str | list[str] | DataFrame | None


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, right columns."""
    return C.decimals_to_double(spark.createDataFrame([], schema))


def read_table(
    spark: SparkSession, path: str | None, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A landed table under its declared schema, decimals as doubles.

    A table with no configured path is empty. A configured path that cannot be
    read is an error, not an empty table.
    """
    if not path:
        return empty(spark, schema)
    return C.decimals_to_double(spark.read.format(fmt).options(**options).schema(schema).load(path))


def read_jdbc(
    spark: SparkSession,
    url: str | None,
    table: str,
    schema: T.StructType,
    split_on: str | None = None,
    bounds: tuple[str, str] | None = None,
    splits: int = 64,
    fetch_rows: int = 10_000,
    properties: dict[str, str] | None = None,
    one_task: bool = False,
) -> DataFrame:
    """A database table, read in `splits` ranges of a numeric or date column.

    Filters and column choice made on the result reach the database. A table
    small enough for one connection and one task is read so only on request (`one_task`).
    """
    if not url:
        return empty(spark, schema)
    if not (split_on and bounds) and not one_task:
        raise ValueError(f"name a column and bounds to split {table} on, or ask for one_task")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("fetchsize", str(fetch_rows)).options(**(properties or {}))
    if split_on and bounds:
        reader = reader.option("partitionColumn", split_on).option("numPartitions", str(splits))
        reader = reader.option("lowerBound", bounds[0]).option("upperBound", bounds[1])
    return C.decimals_to_double(C.project(reader.load(), schema))


def read_source(spark: SparkSession, name: str, path: str | None, **options: str) -> DataFrame:
    """Any of the declared source tables by its name."""
    return read_table(spark, path, schemas.SOURCE_TABLES[name], **options)


def only(df: DataFrame, symbols: Symbols, column: str = "symbol") -> DataFrame:
    """Rows of one symbol, a literal list, or the symbols of a table; None is all."""
    if symbols is None:
        return df
    if isinstance(symbols, DataFrame):
        # made distinct where it is read: a list of every price's symbol is then one row per symbol and task
        wanted = symbols.select(F.col("symbol").alias("_wanted")).distinct()
        return df.join(wanted, F.col(column) == F.col("_wanted"), "left_semi")
    if isinstance(symbols, str):
        return df.filter(F.col(column) == symbols)
    return df.filter(F.col(column).isin(list(symbols)))


def symbol_list(overview: DataFrame) -> DataFrame:
    return overview.select("symbol")


def overview_rows(overview: DataFrame, schema: T.StructType = schemas.OVERVIEW) -> DataFrame:
    return C.project(overview, schema)


def price_rows(
    prices: DataFrame,
    symbols: Symbols = None,
    start: str | date | None = None,
    end: str | date | None = None,
) -> DataFrame:
    """Price history in an inclusive range, by symbol and day."""
    rows = C.between_days(only(prices, symbols), start, end)
    return rows.orderBy("symbol", "date")


def ratio_rows(ratios: DataFrame, symbols: Symbols = None) -> DataFrame:
    """Ratios, newest period first within a symbol."""
    return only(ratios, symbols).orderBy("symbol", F.desc("year"), F.desc("quarter"))


def officer_rows(officers: DataFrame, symbols: Symbols = None) -> DataFrame:
    return C.project(only(officers, symbols), schemas.OFFICERS)


def shareholder_rows(shareholders: DataFrame, symbols: Symbols = None) -> DataFrame:
    return C.project(only(shareholders, symbols), schemas.SHAREHOLDERS)


def stats_rows(stats: DataFrame, symbols: Symbols = None) -> DataFrame:
    return C.project(only(stats, symbols), schemas.STATS)


def statement_rows(
    statements: DataFrame, statement_type: str, period: str, symbols: Symbols = None
) -> DataFrame:
    """One statement of one period kind, newest first; an unknown pair has no rows."""
    rows = statements.filter((F.col("statement_type") == statement_type) & (F.col("period") == period))
    return only(rows, symbols).orderBy("symbol", F.desc("year"), F.desc("quarter"))


def extract_prices(df: DataFrame, symbol: str | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """A provider's price extract under the canonical names and types."""
    return C.coerce_prices(C.canonical_prices(df, symbol), extra)


def extract_officers(df: DataFrame, symbol: str | None = None) -> DataFrame:
    """A provider's officer extract; where it tells who still works there, only those."""
    rows = C.with_symbol(df, symbol)
    if "status" in rows.columns:
        rows = rows.filter(F.lower("status") == "working")
    return C.project(rows, schemas.OFFICERS)


def extract_shareholders(df: DataFrame, symbol: str | None = None) -> DataFrame:
    return C.project(C.with_symbol(df, symbol), schemas.SHAREHOLDERS)


def extract_subsidiaries(df: DataFrame, parent: str | None = None) -> DataFrame:
    rows = df if "parent_symbol" in df.columns else df.withColumn("parent_symbol", F.lit(parent))
    return C.project(rows, schemas.SUBSIDIARIES)


def extract_listing(df: DataFrame) -> DataFrame:
    return C.project(df, schemas.LISTING)


def extract_overview(df: DataFrame, symbol: str | None = None) -> DataFrame:
    """A provider's company overview; of one company's extract the symbol is the one asked for."""
    rows = df if symbol is None else df.withColumn("symbol", F.lit(symbol))
    return C.project(rows, T.StructType([*schemas.OVERVIEW.fields, T.StructField("sector", T.StringType())]))


def extract_ratios(df: DataFrame, symbol: str | None = None) -> DataFrame:
    """A provider's wide ratios as long rows."""
    rows = C.with_symbol(df, symbol)
    return long_metrics(rows, [k for k in ("symbol", "year", "quarter") if k in rows.columns])


def extract_statement(df: DataFrame, statement_type: str, period: str, symbol: str | None = None) -> DataFrame:
    """A provider's wide statement (one column per metric) as long rows."""
    rows = C.with_symbol(df, symbol)
    keys = [k for k in ("symbol", "year", "quarter") if k in rows.columns]
    return C.project(
        long_metrics(rows, keys)
        .withColumn("statement_type", F.lit(statement_type))
        .withColumn("period", F.lit(period)),
        schemas.STATEMENTS,
    )
