"""Questions over the node and edge tables.

Each takes `symbols`: one symbol, a list, a table of symbols, or None for all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockloom.functions import columns as C
from stockloom.plans.joins import salted_join
from stockloom.sources.tables import Symbols, only


def peers(company: DataFrame, links: DataFrame, limit: int = 20) -> DataFrame:
    """The largest companies sharing an industry with each company.

    A company's best `limit` peers of an industry are among that industry's
    first `limit + 1` companies, so only those are joined to the members; the
    members are never paired with each other. The members' join is salted, as
    one industry may hold a large share of them.
    """
    members = links.join(company.select("symbol", "name", "market_cap"), "symbol")
    by_size = W.partitionBy("industry").orderBy(F.desc("market_cap"), "symbol")
    leaders = members.withColumn("_place", F.row_number().over(by_size)).filter(F.col("_place") <= limit + 1)
    boards = leaders.groupBy("industry").agg(
        F.collect_list(
            F.struct(F.col("symbol").alias("peer_symbol"), F.col("name").alias("peer_name"), "market_cap")
        ).alias("_board")
    )
    pairs = (
        salted_join(links, boards, "industry", "symbol")
        .select("symbol", "industry", F.inline("_board"))
        .filter(F.col("peer_symbol") != F.col("symbol"))
    )
    order = W.partitionBy("symbol").orderBy(F.desc("market_cap"), "peer_symbol", "industry")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
    return ranked.select("symbol", "peer_symbol", "peer_name", "market_cap", "rank")


def peers_of(company: DataFrame, links: DataFrame, symbols: Symbols, limit: int = 20) -> DataFrame:
    """The largest peers of one asked company (or of a few together), largest first."""
    own = only(links, symbols).select(F.col("symbol").alias("_asked"), "industry")
    shared = links.join(own, "industry").filter(F.col("symbol") != F.col("_asked"))
    rows = shared.join(company.select("symbol", "name", "market_cap"), "symbol")
    rows = rows.select("symbol", "name", "market_cap")
    return rows.orderBy(F.desc("market_cap"), "symbol").limit(limit)


def subsidiaries(company: DataFrame, edges: DataFrame, symbols: Symbols = None) -> DataFrame:
    """Direct children of a company."""
    rows = only(edges, symbols, "parent")
    named = rows.join(company.select(F.col("symbol").alias("child"), "name"), "child")
    return named.select(
        F.col("parent").alias("symbol"),
        F.col("child").alias("sub_symbol"),
        F.col("name").alias("sub_name"),
        F.col("ownership_percent").alias("ownership_pct"),
        F.col("relation_type").alias("rel_type"),
    )


def shareholders(company: DataFrame, edges: DataFrame, symbols: Symbols = None) -> DataFrame:
    """Holders of a company, largest stake first."""
    rows = only(edges, symbols, "target")
    named = rows.join(company.select(F.col("symbol").alias("holder"), "name"), "holder")
    return named.select(
        F.col("target").alias("symbol"),
        F.col("name").alias("holder_name"),
        F.col("holder").alias("holder_symbol"),
        F.col("stake_percent").alias("stake_pct"),
    ).orderBy("symbol", F.desc("stake_pct"), "holder_symbol")


def price_history(prices: DataFrame, symbols: Symbols = None, start=None, end=None) -> DataFrame:
    """Daily prices in an inclusive range, oldest first.

    `prices` is the node table: it holds existing companies only, so the way
    from the company to its prices is the symbol column.
    """
    return C.between_days(only(prices, symbols), start, end).orderBy("symbol", "date")


def price_tail(prices: DataFrame, symbols: Symbols = None, days: int = 30) -> DataFrame:
    """The last `days` price rows of each company, oldest first."""
    newest = W.partitionBy("symbol").orderBy(F.desc("date"))
    rows = only(prices, symbols).withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") <= days)
    return rows.drop("_place").orderBy("symbol", "date")


def indicators(values: DataFrame, symbols: Symbols = None, latest_only: bool = False) -> DataFrame:
    """Indicators of existing companies, newest period first.

    `latest_only` keeps each metric's newest period.
    """
    rows = only(values, symbols)
    if latest_only:
        newest = F.max(F.struct("year", "quarter", "value")).alias("_newest")
        rows = rows.groupBy("symbol", "metric").agg(newest).select("symbol", "metric", "_newest.*")
    return rows.select("symbol", "metric", "value", "year", "quarter").orderBy(
        "symbol", F.desc("year"), F.desc("quarter"), "metric"
    )


def cross_shareholding(edges: DataFrame, limit: int | None = 50) -> DataFrame:
    """Companies holding stakes in each other, in both orientations.

    Edges are one row per (holder, target), so both directions of a pair meet
    in one group of at most two rows: one shuffle, no self-join.
    """
    a, b = F.least("holder", "target"), F.greatest("holder", "target")
    forward = F.col("holder") < F.col("target")
    both = (
        edges.filter(F.col("holder") != F.col("target"))
        .groupBy(a.alias("a"), b.alias("b"))
        .agg(
            F.max(F.when(forward, F.col("stake_percent"))).alias("ab"),
            F.max(F.when(~forward, F.col("stake_percent"))).alias("ba"),
            F.count("*").alias("n"),
        )
        .filter(F.col("n") == 2)
    )
    names = ("symbol_a", "symbol_b", "a_holds_b_pct", "b_holds_a_pct")
    turn = lambda *cols: F.struct(*[F.col(c).alias(n) for c, n in zip(cols, names, strict=True)])
    rows = both.select(F.inline(F.array(turn("a", "b", "ab", "ba"), turn("b", "a", "ba", "ab"))))
    rows = rows.orderBy("symbol_a", "symbol_b")
    return rows if limit is None else rows.limit(limit)


def graph_stats(company: DataFrame, prices: DataFrame, statements: DataFrame, values: DataFrame) -> DataFrame:
    """One row of counts, 0 for an empty table."""
    names = ("companies", "stock_prices", "stock_price_symbols", "financial_statements", "financial_indicators")
    count = F.count("*").alias("n")
    # One pass over the prices gives both their number and their symbols.
    by_symbol = prices.groupBy("symbol").agg(count)
    price_counts = by_symbol.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("stock_prices"), F.count("symbol").alias("stock_price_symbols")
    )
    single = {"companies": company, "financial_statements": statements, "financial_indicators": values}
    parts = [price_counts.unpivot([], ["stock_prices", "stock_price_symbols"], "part", "n")]
    parts += [df.agg(count).select(F.lit(name).alias("part"), "n") for name, df in single.items()]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.agg(*[F.sum(F.when(F.col("part") == k, F.col("n")).otherwise(F.lit(0))).alias(k) for k in names])


def loaded_symbols(prices: DataFrame) -> DataFrame:
    """Distinct symbols of a price load, blank ones aside."""
    return prices.filter(F.trim("symbol") != "").select("symbol").distinct()
