"""Node and edge tables from clean extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions import columns as C
from stockloom.operators.reshape import long_metrics, payload_map
from stockloom.operators.upsert import last_write_wins

STATEMENT_KEY = ("symbol", "statement_type", "period", "year", "quarter")
INDICATOR_KEY = ("symbol", "metric", "year", "quarter")


def known(df: DataFrame, company: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows whose company exists."""
    return df.join(company.select(F.col("symbol").alias("_known")), F.col(key) == F.col("_known"), "left_semi")


def unknown(df: DataFrame, company: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows whose company does not exist: what `known` leaves out."""
    return df.join(company.select(F.col("symbol").alias("_known")), F.col(key) == F.col("_known"), "left_anti")


# --- companies, industries, sectors ------------------------------------------


def company_defaults(overview: DataFrame, version: Sequence[str] = ()) -> DataFrame:
    """Company properties with blanks filled: name by symbol, text by '', numbers by 0."""
    symbol = F.col("symbol").cast("string")
    return overview.select(
        symbol.alias("symbol"),
        C.text_or(overview, "short_name", symbol).alias("name"),
        C.text_or(overview, "exchange").alias("exchange"),
        C.number_or_zero(overview, "market_cap", "bigint").alias("market_cap"),
        C.number_or_zero(overview, "no_employees", "bigint").alias("no_employees"),
        C.text_or(overview, "established_year").alias("established_year"),
        C.text_or(overview, "website").alias("website"),
        C.number_or_zero(overview, "outstanding_share").alias("outstanding_share"),
        C.number_or_zero(overview, "foreign_percent").alias("foreign_percent"),
        *version,
    )


def master_companies(overview: DataFrame, version: Sequence[str] = ()) -> DataFrame:
    """Company nodes of the master, one per symbol."""
    rows = C.drop_blank_keys(company_defaults(overview, version), "symbol")
    return last_write_wins(rows, ["symbol"], version)


def industries(overview: DataFrame) -> DataFrame:
    """Industry nodes: every distinct name, also of companies not known."""
    return C.drop_blank_keys(overview, "industry").select(F.col("industry").alias("name")).distinct()


def industry_links(overview: DataFrame, company: DataFrame) -> DataFrame:
    """BELONGS_TO_INDUSTRY: distinct (symbol, industry) of known companies.

    Checked before it is made distinct: both need the rows by symbol, and in
    this order one shuffle serves both.
    """
    return known(C.drop_blank_keys(overview, "industry").select("symbol", "industry"), company).distinct()


def sectors(overview: DataFrame) -> DataFrame:
    if "sector" not in overview.columns:
        return overview.select(F.lit("").alias("name")).limit(0)
    return C.drop_blank_keys(overview, "sector").select(F.col("sector").alias("name")).distinct()


def industry_in_sector(overview: DataFrame) -> DataFrame:
    """INDUSTRY_IN_SECTOR: distinct pairs, where the master names a sector."""
    if "sector" not in overview.columns:
        return overview.select("industry", F.lit("").alias("sector")).limit(0)
    return C.drop_blank_keys(overview, "industry", "sector").select("industry", "sector").distinct()


# --- prices, statements, indicators -------------------------------------------


def stock_prices(prices: DataFrame, company: DataFrame, version: Sequence[str] = ()) -> DataFrame:
    """Price nodes by (symbol, date).

    Checked before they are reduced: the check shuffles the rows as they are read, and having them by symbol the
    reduction shuffles none. The adaptive skew join splits a symbol with a large share of the rows.
    """
    rows = C.coerce_prices(C.canonical_prices(prices), tuple(version))
    rows = rows.filter(F.col("symbol").isNotNull() & F.col("date").isNotNull())
    return last_write_wins(known(rows, company), ["symbol", "date"], version)


def statement_metrics(statements: DataFrame, company: DataFrame, version: Sequence[str] = ()) -> DataFrame:
    """Statement values by the five-part key and metric, one row each."""
    rows = statements.select(
        "symbol",
        "statement_type",
        "period",
        C.whole(F.col("year")).alias("year"),
        C.statement_quarter(F.col("period"), C.present(statements, "quarter", "int")).alias("quarter"),
        "metric",
        F.col("value").try_cast("double").alias("value"),
        *version,
    ).filter(F.col("year").isNotNull() & F.col("quarter").isNotNull())
    return last_write_wins(known(rows, company), [*STATEMENT_KEY, "metric"], version)


def statement_nodes(statements: DataFrame, company: DataFrame, version: Sequence[str] = ()) -> DataFrame:
    """Statement nodes: the five-part key and the metrics as a map."""
    return payload_map(statement_metrics(statements, company, version), STATEMENT_KEY)


def indicator_nodes(
    ratios: DataFrame, company: DataFrame, version: Sequence[str] = (), wide: bool = False
) -> DataFrame:
    """Indicator nodes by (symbol, metric, year, quarter); the caller names the form."""
    if wide:
        rows = long_metrics(ratios, ["symbol", "year", "quarter", *version])
    else:
        rows = ratios.select(
            "symbol", "year", "quarter", "metric", F.col("value").try_cast("double").alias("value"), *version
        ).filter(F.col("value").isNotNull())
    rows = rows.select(
        "symbol",
        "metric",
        C.whole(F.col("year")).alias("year"),
        C.whole(F.col("quarter")).alias("quarter"),
        "value",
        *version,
    ).filter(F.col("year").isNotNull() & F.col("quarter").isNotNull())
    return last_write_wins(known(rows, company), INDICATOR_KEY, version)


# --- officers ------------------------------------------------------------------


def led_by(officers: DataFrame, company: DataFrame, version: Sequence[str] = ()) -> DataFrame:
    """LED_BY with the position and share held in that company."""
    rows = C.drop_blank_keys(officers, "officer_name").select(
        "symbol",
        "officer_name",
        C.text_or(officers, "officer_position").alias("position"),
        C.number_or_zero(officers, "officer_own_percent").alias("own_percent"),
        *version,
    )
    return known(last_write_wins(rows, ["symbol", "officer_name"], version), company)


def officer_nodes(edges: DataFrame) -> DataFrame:
    """Officer nodes by name; of several companies the largest symbol's values stand."""
    rows = edges.select("officer_name", "position", "own_percent", "symbol")
    return last_write_wins(rows, ["officer_name"], ["symbol"])


# --- ownership ------------------------------------------------------------------


def subsidiary_rows(subsidiaries: DataFrame, master: DataFrame, version: Sequence[str] = ()) -> DataFrame:
    """(child, parent) rows of known parents, one each, with the child's name."""
    code = F.col("sub_organ_code").cast("string")
    rows = C.drop_blank_keys(subsidiaries, "sub_organ_code").select(
        code.alias("child"),
        F.col("parent_symbol").alias("parent"),
        C.number_or_zero(subsidiaries, "ownership_percent").alias("ownership_percent"),
        C.text_or(subsidiaries, "type").alias("relation_type"),
        C.text_or(subsidiaries, "organ_name", code).alias("child_name"),
        *version,
    )
    return last_write_wins(known(rows, master, "parent"), ["child", "parent"], version)


def subsidiary_edges(rows: DataFrame) -> DataFrame:
    return rows.select("child", "parent", "ownership_percent", "relation_type")


def child_stubs(rows: DataFrame, master: DataFrame) -> DataFrame:
    """Companies only known as someone's child; named by the smallest parent symbol."""
    first = rows.groupBy(F.col("child").alias("symbol")).agg(
        F.min(F.struct("parent", "child_name")).alias("_first")
    )
    return unknown(first.select("symbol", F.col("_first.child_name").alias("name")), master)


def holder_rows(shareholders: DataFrame, master: DataFrame, version: Sequence[str] = ()) -> DataFrame:
    """(holder name, target) rows of known targets, one each."""
    rows = C.drop_blank_keys(shareholders, "share_holder").select(
        F.col("share_holder").alias("holder_name"),
        F.col("symbol").alias("target"),
        C.number_or_zero(shareholders, "share_own_percent").alias("stake_percent"),
        *version,
    )
    return last_write_wins(known(rows, master, "target"), ["holder_name", "target"], version)


def resolve_holders(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Stake rows by holder symbol: every company of exactly that name, else the name itself.

    `named` holds (symbol, name) of the companies a holder can be.
    """
    by_name = named.select(F.col("name").alias("holder_name"), F.col("symbol").alias("_symbol"))
    matched = rows.join(by_name, "holder_name", "left")
    return matched.select(
        F.coalesce("_symbol", "holder_name").alias("holder"),
        "target",
        "stake_percent",
        "holder_name",
        F.col("_symbol").isNotNull().alias("resolved"),
    )


def doubtful_holders(resolved: DataFrame, named: DataFrame) -> DataFrame:
    """Holder symbols that two names can lead to: names no company has that are some company's symbol."""
    names = resolved.filter(~F.col("resolved")).select("holder").distinct()
    return known(names, named, "holder")


def stake_edges(resolved: DataFrame, doubtful: DataFrame | None = None) -> DataFrame:
    """HOLDS_STAKE_IN by (holder, target).

    Two names can lead to one holder (a name that is another company's symbol);
    the larger holder name then stands. Of rows with one for each name and target, as `holder_rows` makes them, and
    companies with one name each, only those of `doubtful` holders have to be compared; all others stay where they are.
    """
    rows = resolved.select("holder", "target", "holder_name", "stake_percent")
    compared = rows if doubtful is None else rows.join(doubtful, "holder", "left_semi")
    edges = last_write_wins(compared, ["holder", "target"], ["holder_name"])
    if doubtful is None:
        return edges
    return rows.join(doubtful, "holder", "left_anti").drop("holder_name").unionByName(edges)


def holder_stubs(resolved: DataFrame, named: DataFrame) -> DataFrame:
    """Holders no company is named after; name and symbol are the holder's name."""
    names = resolved.filter(~F.col("resolved")).select(F.col("holder").alias("symbol")).distinct()
    return unknown(names, named).select("symbol", F.col("symbol").alias("name"))


def with_stubs(master: DataFrame, *stubs: DataFrame) -> DataFrame:
    """The company table: the master, then companies only referred to."""
    company = master
    for stub in stubs:
        company = company.unionByName(stub, allowMissingColumns=True)
    return company
