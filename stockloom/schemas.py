"""Column layouts of the source tables and of the node and edge tables.

Names and types here are fixed values: the extracts arrive with them.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_DAY, _TS, _NUM = T.DateType(), T.TimestampNTZType(), T.DecimalType(38, 10)


def _table(*cols: tuple) -> T.StructType:
    """(name, type) pairs, nullable; a third item False marks NOT NULL."""
    return T.StructType([T.StructField(c[0], c[1], c[2] if len(c) > 2 else True) for c in cols])


# --- node labels, relationship types (fixed values) -------------------------

NODE_LABELS = (
    "Company",
    "Sector",
    "Industry",
    "StockPrice",
    "FinancialStatement",
    "FinancialIndicator",
    "Officer",
)

REL_TYPES = (
    "BELONGS_TO_INDUSTRY",
    "INDUSTRY_IN_SECTOR",
    "HAS_PRICE",
    "HAS_STATEMENT",
    "HAS_INDICATOR",
    "SUBSIDIARY_OF",
    "HOLDS_STAKE_IN",
    "LED_BY",
)

STATEMENT_TYPES = ("balance_sheet", "income_statement", "cash_flow")
PERIODS = ("quarter", "year")

# --- source tables ----------------------------------------------------------

OVERVIEW = _table(
    ("symbol", _S, False),
    ("exchange", _S),
    ("industry", _S),
    ("no_shareholders", _L),
    ("foreign_percent", _D),
    ("outstanding_share", _D),
    ("issue_share", _D),
    ("established_year", _S),
    ("no_employees", _L),
    ("short_name", _S),
    ("website", _S),
    ("market_cap", _L),
)

PRICE_SNAPSHOT = _table(
    ("symbol", _S, False),
    ("current_price", _D),
    ("price_change", _D),
    ("pct_price_change", _D),
    ("accumulated_volume", _L),
)

PRICE_HISTORY = _table(
    ("symbol", _S, False),
    ("date", _DAY, False),
    ("open", _D),
    ("high", _D),
    ("low", _D),
    ("close", _D, False),
    ("volume", _L),
)

PROFILE = _table(
    ("symbol", _S, False),
    ("company_name", _S),
    ("company_profile", _S),
    ("history_dev", _S),
    ("company_promise", _S),
    ("business_risk", _S),
    ("key_developments", _S),
    ("business_strategies", _S),
)

STATS = _table(
    ("id", _L, False),
    ("symbol", _S),
    ("roe", _D),
    ("roa", _D),
    ("ev_ebitda", _D),
    ("dividend_yield", _D),
    ("gross_margin", _D),
    ("net_margin", _D),
    ("doe", _D),
    ("alpha", _D),
    ("beta", _D),
    ("pe", _D),
    ("pb", _D),
    ("eps", _L),
    ("ps", _D),
    ("ev", _D),
    ("rsi14", _D),
)

RATIO_QUARTERLY = _table(
    ("id", _I, False),
    ("symbol", _S, False),
    ("year", _I, False),
    ("quarter", _I, False),
    ("metric", _S, False),
    ("value", _NUM),
    ("updated_at", _TS),
)

RATIO_YEARLY = _table(
    ("id", _I, False),
    ("symbol", _S, False),
    ("year", _I, False),
    ("metric", _S, False),
    ("value", _NUM),
    ("updated_at", _TS),
)

SHAREHOLDERS = _table(
    ("share_holder", _S, False),
    ("symbol", _S, False),
    ("share_own_percent", _D),
)

OFFICERS = _table(
    ("symbol", _S, False),
    ("officer_name", _S, False),
    ("officer_position", _S),
    ("officer_own_percent", _D),
)

EVENTS = _table(
    ("symbol", _S, False),
    ("event_name", _S, False),
    ("price_change_ratio", _D),
    ("event_desc", _S),
)

NEWS = _table(
    ("symbol", _S, False),
    ("title", _S, False),
    ("publish_date", _S),
    ("price_change_ratio", _D),
)

INDEX_HISTORY = _table(
    ("time", _TS, False),
    ("open", _D),
    ("high", _D),
    ("low", _D),
    ("close", _D),
    ("volume", _L),
)

DAILY_CHANGES = _table(
    ("symbol", _S, False),
    ("industry", _S),
    ("period_end", _DAY),
    ("close", _D),
    ("prior_close", _D),
    ("pct_change", _NUM),
    ("updated_at", _TS),
    ("market_cap", _NUM),
)

# One long table holds all statements; it is laid out by statement_type and
# period, so picking a statement prunes directories.
STATEMENTS = _table(
    ("symbol", _S, False),
    ("statement_type", _S, False),
    ("period", _S, False),
    ("year", _I, False),
    ("quarter", _I),
    ("metric", _S, False),
    ("value", _NUM),
)

SUBSIDIARIES = _table(
    ("parent_symbol", _S, False),
    ("id", _S),
    ("sub_organ_code", _S),
    ("ownership_percent", _D),
    ("organ_name", _S),
    ("type", _S),
)

LISTING = _table(("symbol", _S, False), ("exchange", _S))

SOURCE_TABLES = {
    "tickers.overview_df": OVERVIEW,
    "tickers.price_df": PRICE_SNAPSHOT,
    "tickers.price_history": PRICE_HISTORY,
    "tickers.profile_df": PROFILE,
    "tickers.stats_df": STATS,
    "tickers.ratio_quarterly": RATIO_QUARTERLY,
    "tickers.ratio_yearly": RATIO_YEARLY,
    "tickers.shareholders_df": SHAREHOLDERS,
    "tickers.officers_df": OFFICERS,
    "tickers.events_df": EVENTS,
    "tickers.news_df": NEWS,
    "market.vnindex": INDEX_HISTORY,
    "market.daily_changes": DAILY_CHANGES,
}

# --- node and edge tables ---------------------------------------------------

COMPANY_NODE = _table(
    ("symbol", _S, False),
    ("name", _S),
    ("exchange", _S),
    ("market_cap", _L),
    ("no_employees", _L),
    ("established_year", _S),
    ("website", _S),
    ("outstanding_share", _D),
    ("foreign_percent", _D),
)

PRICE_NODE = _table(
    ("symbol", _S, False),
    ("date", _DAY, False),
    ("open", _D),
    ("high", _D),
    ("low", _D),
    ("close", _D),
    ("volume", _L),
)

EPISODE = _table(
    ("name", _S, False),
    ("body", _S),
    ("source", _S, False),
    ("reference_time", _TS, False),
    ("source_description", _S),
    ("group_id", _S, False),
)
