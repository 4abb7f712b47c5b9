"""The full load: all extracts to all node and edge tables, as one set of plans."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, fields
from functools import cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions import columns as C
from stockloom.operators import build
from stockloom.operators.choose import fallback_by_key, fallback_table, resolve_symbols
from stockloom.plans.joins import settled
from stockloom.sources.tables import only


@dataclass
class Sources:
    """Clean extracts of one provider. `versions` names each one's write order."""

    overview: DataFrame
    prices: DataFrame
    statements: DataFrame
    ratios: DataFrame
    officers: DataFrame
    shareholders: DataFrame
    subsidiaries: DataFrame
    versions: dict[str, Sequence[str]] = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name != "versions"}


class Graph:
    """Node and edge tables by name, each planned when it is first asked for.

    HAS_PRICE, HAS_STATEMENT and HAS_INDICATOR are the symbol column of their
    child table and are not stored a second time.
    """

    TABLES = (
        "company",
        "industry",
        "sector",
        "stock_price",
        "financial_statement",
        "financial_indicator",
        "officer",
        "belongs_to_industry",
        "industry_in_sector",
        "subsidiary_of",
        "holds_stake_in",
        "led_by",
    )

    def __init__(self, **makers: Callable[[], DataFrame]) -> None:
        self._makers = makers

    def __getattr__(self, name: str) -> DataFrame:
        if name not in Graph.TABLES:
            raise AttributeError(name)
        table = self._makers[name]()
        setattr(self, name, table)
        return table

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in Graph.TABLES}


def choose_sources(primary: Sources, secondary: Sources) -> Sources:
    """Primary rows where the primary has the symbol, else the secondary's.

    The master is chosen as a whole; statements by symbol and statement type;
    subsidiaries always come from the secondary.
    """
    return Sources(
        overview=fallback_table(primary.overview, secondary.overview),
        prices=fallback_by_key(primary.prices, secondary.prices),
        statements=fallback_by_key(primary.statements, secondary.statements, ("symbol", "statement_type", "period")),
        ratios=fallback_by_key(primary.ratios, secondary.ratios),
        officers=fallback_by_key(primary.officers, secondary.officers),
        shareholders=fallback_by_key(primary.shareholders, secondary.shareholders),
        subsidiaries=secondary.subsidiaries,
        versions=primary.versions,
    )


def restrict(sources: Sources, symbols: DataFrame | str | list[str] | None) -> Sources:
    """The extracts of some symbols only."""
    if symbols is None:
        return sources
    parts = {
        name: only(df, symbols, "parent_symbol" if name == "subsidiaries" else "symbol")
        for name, df in sources.tables().items()
    }
    return Sources(**parts, versions=sources.versions)


def build_graph(
    sources: Sources,
    symbols: DataFrame | str | list[str] | None = None,
    stored: bool = False,
    owned: Callable[[], Sources] | None = None,
) -> Graph:
    """Node and edge tables of all symbols, or of the given ones.

    `stored` writes the rows several tables are made from (the master, the
    children, the resolved holders, the officers) to the shared folder once,
    instead of computing them again for each of those tables. The facts are then also
    joined to a plain table, which lets the adaptive skew join split a busy symbol. `owned` hands
    out the sources of shareholders and subsidiaries, where both are worth preparing together; only tables that need them ask.
    A table of symbols is written out as well: knowing its size, the planner sends a small one to where the extracts are read.
    """
    if stored and isinstance(symbols, DataFrame):
        symbols = settled(symbols.select("symbol").distinct(), "symbols")
    s = restrict(sources, symbols)
    order = lambda name: s.versions.get(name, ())
    keep = settled if stored else lambda df, _: df

    @cache
    def owners():
        return restrict(owned(), symbols) if owned else s

    @cache
    def master():
        return keep(build.master_companies(s.overview, order("overview")), "master")

    @cache
    def children():
        return keep(build.subsidiary_rows(owners().subsidiaries, master(), order("subsidiaries")), "children")

    @cache
    def named():
        return keep(build.with_stubs(master(), build.child_stubs(children(), master())), "named")

    @cache
    def resolved():
        holders = build.holder_rows(owners().shareholders, master(), order("shareholders"))
        return keep(build.resolve_holders(holders, named()), "holders")

    @cache
    def led_by():
        return keep(build.led_by(s.officers, master(), order("officers")), "officers")

    return Graph(
        company=lambda: build.with_stubs(named(), build.holder_stubs(resolved(), named())),
        industry=lambda: build.industries(s.overview),
        sector=lambda: build.sectors(s.overview),
        stock_price=lambda: build.stock_prices(s.prices, master(), order("prices")),
        financial_statement=lambda: build.statement_nodes(s.statements, master(), order("statements")),
        financial_indicator=lambda: build.indicator_nodes(s.ratios, master(), order("ratios")),
        officer=lambda: build.officer_nodes(led_by()),
        belongs_to_industry=lambda: build.industry_links(s.overview, master()),
        industry_in_sector=lambda: build.industry_in_sector(s.overview),
        subsidiary_of=lambda: build.subsidiary_edges(children()),
        holds_stake_in=lambda: build.stake_edges(resolved(), keep(build.doubtful_holders(resolved(), named()), "doubtful")),
        led_by=led_by,
    )


AUDIT_COLUMNS = ("prices", "statements", "ratios", "officers", "subsidiaries", "shareholders")


def ingest_audit(sources: Sources, symbols: DataFrame, company: DataFrame) -> DataFrame:
    """Input rows per symbol and extract, and whether the master knows the symbol.

    A statement row is one period of one statement, as it arrives when wide.
    """
    periods = sources.statements.select("symbol", "statement_type", "period", "year", "quarter").distinct()
    counted = {
        "prices": sources.prices.select("symbol"),
        "statements": periods.select("symbol"),
        "ratios": sources.ratios.select("symbol"),
        "officers": sources.officers.select("symbol"),
        "subsidiaries": sources.subsidiaries.select(F.col("parent_symbol").alias("symbol")),
        "shareholders": sources.shareholders.select("symbol"),
        "asked": symbols.select("symbol"),
        "known": company.select("symbol"),
    }
    rows = reduce(DataFrame.unionByName, [df.withColumn("kind", F.lit(k)) for k, df in counted.items()])
    count = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    per_symbol = rows.groupBy("symbol").agg(
        *[count(c).alias(c) for c in AUDIT_COLUMNS],
        (count("known") > 0).alias("known"),
        count("asked").alias("_asked"),
    )
    return per_symbol.filter(F.col("_asked") > 0).drop("_asked")


MEASURES = {
    "prices": {**dict.fromkeys(C.PRICE_MEASURES, "double"), "volume": "bigint"},
    "statements": {"value": "double"},
    "officers": {"officer_own_percent": "double"},
    "subsidiaries": {"ownership_percent": "double"},
    "shareholders": {"share_own_percent": "double"},
}


def rejected_rows(sources: Sources) -> DataFrame:
    """Rows no table can take whole: extract, the keys missing and measures unreadable, and the row as text.

    A key that cannot be read (a day or year that is none) counts as missing. A
    measure that is no number is listed too; the load takes the row with 0 for it.
    """
    blank = lambda *names: {n: C.is_blank(F.col(n).cast("string")) for n in names}
    year = C.whole(F.col("year")).isNull()
    quarter = C.statement_quarter(F.col("period"), C.present(sources.statements, "quarter", "int")).isNull()
    tests = {
        "overview": blank("symbol"),
        "prices": {**blank("symbol"), "date": C.day_of(F.col("date")).isNull()},
        "statements": {**blank("symbol"), "year": year, "quarter": quarter},
        "ratios": {**blank("symbol"), "year": year, "quarter": C.whole(F.col("quarter")).isNull()},
        "officers": blank("symbol", "officer_name"),
        "subsidiaries": blank("parent_symbol", "sub_organ_code"),
        "shareholders": blank("symbol", "share_holder"),
    }
    tables = {**sources.tables(), "prices": C.canonical_prices(sources.prices)}
    for name, measures in MEASURES.items():
        df = tables[name]
        tests[name] |= {m: C.unreadable(df, m, kind) for m, kind in measures.items() if m in df.columns}
    parts = []
    for name, lacks in tests.items():
        missing = F.array_compact(F.array(*[F.when(test, F.lit(key)) for key, test in lacks.items()]))
        df = tables[name]
        parts.append(
            df.filter(F.size(missing) > 0).select(
                F.lit(name).alias("extract"),
                F.array_join(missing, ",").alias("missing"),
                F.to_json(F.struct(*df.columns)).alias("row"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def load_symbols(primary: Sources, secondary: Sources, requested=None) -> DataFrame:
    return resolve_symbols(requested, primary.overview, secondary.overview)
