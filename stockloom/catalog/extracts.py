"""The test tables read as market extracts.

Suppliers and customers are companies, line items their prices, statements and
ownership records, orders their ratios and dated facts, documents episodes.
Every row of a table takes part; what a row stands for follows from its values.
"""

from __future__ import annotations

import os
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.plans.joins import settled
from stockloom.plans.load import Graph, Sources, build_graph

VERSION = ("seq1", "seq2")
VERSIONS = {
    "prices": VERSION,
    "statements": VERSION,
    "ratios": ("seq",),
    "officers": VERSION,
    "shareholders": VERSION,
    "subsidiaries": VERSION,
}


# Layouts of the test tables; stated, so that opening one reads no file.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
}


def symbol_of(letter: str, key: str) -> Column:
    return F.concat(F.lit(letter), F.col(key).cast("string"))


class Extracts:
    """Domain frames over one scale folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            path = os.path.join(self.folder, f"{name}.parquet")
            self._tables[name] = self.spark.read.schema(TABLES[name]).parquet(path)
        return self._tables[name]

    def _placed(self, df: DataFrame, nation: str) -> DataFrame:
        nations = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return df.join(nations, F.col(nation) == F.col("n_nationkey"))

    @cached_property
    def overview(self) -> DataFrame:
        """The company master: suppliers not in debt, and all customers."""
        balance = F.col("s_acctbal")
        suppliers = (
            self._placed(self.table("supplier"), "s_nationkey")
            .filter(balance >= 0)
            .select(
                symbol_of("S", "s_suppkey").alias("symbol"),
                F.when(balance >= 1000, F.col("s_name")).alias("short_name"),
                F.when(balance >= 5000, "HOSE").otherwise("HNX").alias("exchange"),
                F.when(balance.between(1000, 2000), "").otherwise(F.col("n_name")).alias("industry"),
                F.col("r_name").alias("sector"),
                F.when(balance >= 500, F.round(balance * 100).cast("bigint")).alias("market_cap"),
                F.floor(balance / 10).cast("bigint").alias("no_employees"),
                (balance * 1000).alias("outstanding_share"),
            )
        )
        customers = self._placed(self.table("customer"), "c_nationkey").select(
            symbol_of("C", "c_custkey").alias("symbol"),
            F.col("c_name").alias("short_name"),
            F.col("c_mktsegment").alias("exchange"),
            F.col("n_name").alias("industry"),
            F.col("r_name").alias("sector"),
            F.round(F.col("c_acctbal") * 100).cast("bigint").alias("market_cap"),
            F.lit(None).cast("bigint").alias("no_employees"),
            F.lit(None).cast("double").alias("outstanding_share"),
        )
        return suppliers.unionByName(customers)

    @cached_property
    def listing(self) -> DataFrame:
        """A provider's listing: every supplier, in the master or not."""
        return self.table("supplier").select(
            symbol_of("S", "s_suppkey").alias("symbol"), F.lit("UPCOM").alias("exchange")
        )

    def _prices(self, symbol: str, day: str, day_type: str) -> DataFrame:
        price = F.col("l_extendedprice")
        return self.table("lineitem").select(*price_columns(price, symbol, day, day_type))

    @cached_property
    def prices(self) -> DataFrame:
        return self._prices("symbol", "date", "date")

    @cached_property
    def provider_prices(self) -> DataFrame:
        """The same rows as a provider names them: `ticker` and a `time`."""
        return self._prices("ticker", "time", "timestamp_ntz")

    @cached_property
    def hose_symbols(self) -> DataFrame:
        return self.overview.filter(F.col("exchange") == "HOSE").select("symbol")

    @cached_property
    def ratios(self) -> DataFrame:
        """Long ratios with repeated keys; the larger order key was written later."""
        return self.table("orders").select(
            symbol_of("C", "o_custkey").alias("symbol"),
            F.year("o_orderdate").alias("year"),
            F.quarter("o_orderdate").alias("quarter"),
            F.col("o_orderpriority").alias("metric"),
            F.col("o_totalprice").alias("value"),
            F.col("o_orderkey").alias("seq"),
        )

    @cached_property
    def wide_ratios(self) -> DataFrame:
        """Wide ratios: numbers, a number as text, words, and a time."""
        status, total = F.col("o_orderstatus"), F.col("o_totalprice")
        as_text = F.concat(F.lit(" "), total.cast("decimal(18,2)").cast("string"), F.lit(" "))
        return self.table("orders").select(
            symbol_of("C", "o_custkey").alias("symbol"),
            F.year("o_orderdate").alias("year"),
            F.quarter("o_orderdate").alias("quarter"),
            F.when(status == "F", total).alias("pe"),
            F.when(status == "O", total).alias("roe"),
            F.when(status == "P", as_text).alias("eps"),
            F.col("o_orderpriority").alias("note"),
            F.col("o_orderdate").alias("updated_at"),
            F.col("o_orderkey").alias("seq"),
        )

    @cached_property
    def stats(self) -> DataFrame:
        return self.wide_ratios.select(F.col("seq").alias("id"), "symbol", "pe", "roe")

    @cached_property
    def statements(self) -> DataFrame:
        """Long statements, quarterly and yearly; a line without discount has no value."""
        flag = F.col("l_returnflag")
        kind = F.when(flag == "R", "balance_sheet").when(flag == "A", "income_statement").otherwise("cash_flow")
        period = F.explode(F.array(F.lit("quarter"), F.lit("year")))
        rows = self.table("lineitem").select(
            symbol_of("S", "l_suppkey").alias("symbol"),
            kind.alias("statement_type"),
            period.alias("period"),
            F.year("l_shipdate").alias("year"),
            F.quarter("l_shipdate").alias("_quarter"),
            F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("metric"),
            F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).alias("value"),
            F.col("l_orderkey").alias("seq1"),
            F.col("l_linenumber").alias("seq2"),
        )
        quarter = F.when(F.col("period") == "quarter", F.col("_quarter"))
        return rows.withColumn("quarter", quarter).drop("_quarter")

    @cached_property
    def officers(self) -> DataFrame:
        lines = self.table("lineitem").join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        return self._officers(lines)

    @staticmethod
    def _officers(lines: DataFrame) -> DataFrame:
        """Officers: a part's brand; the smallest sizes name nobody."""
        return lines.select(
            symbol_of("S", "l_suppkey").alias("symbol"),
            F.when(F.col("p_size") <= 2, "").otherwise(F.col("p_brand")).alias("officer_name"),
            F.col("p_type").alias("officer_position"),
            (F.col("l_discount") * 100).alias("officer_own_percent"),
            F.col("l_orderkey").alias("seq1"),
            F.col("l_linenumber").alias("seq2"),
        )

    @cached_property
    def _trades(self) -> DataFrame:
        """Line items with their part, order's customer and supplier, and of these the names that a line speaks of.

        `traded` tells that a line has all three. Orders meet their customers before the lines, so the lines are
        shuffled for their orders and parts alone; suppliers come last, so their names are not shuffled.
        """
        line = {c: F.col("l_returnflag").eqNullSafe(c) for c in "RA"}
        filled = F.col("l_linestatus").eqNullSafe("F")
        named = lambda df, names: df.withColumns({n: F.when(test, F.col(n)) for n, test in names.items()})
        orders = self.table("orders").join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        lines = self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        lines = named(lines, {"c_name": line["A"] | ~filled})
        lines = lines.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        lines = lines.join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        traded = F.col("o_custkey").isNotNull() & F.col("s_suppkey").isNotNull()
        return named(lines, {"s_name": line["R"], "p_name": filled}).select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", "l_returnflag", "l_linestatus",
            "l_discount", "l_tax", "s_name", "c_name", "p_brand", "p_name", "p_type", "p_size", traded.alias("traded"),
        )

    @cached_property
    def shareholders(self) -> DataFrame:
        return self._shareholders(self._trades)

    @cached_property
    def subsidiaries(self) -> DataFrame:
        return self._subsidiaries(self._trades)

    @staticmethod
    def _shareholders(trades: DataFrame) -> DataFrame:
        """Returned lines: the supplier holds the customer; accepted ones: the
        customer holds the supplier; the rest: a brand, no company, holds the supplier."""
        flag = F.col("l_returnflag")
        return trades.filter("traded").select(
            F.when(flag == "R", symbol_of("C", "o_custkey")).otherwise(symbol_of("S", "l_suppkey")).alias("symbol"),
            F.when(flag == "R", F.col("s_name"))
            .when(flag == "A", F.col("c_name"))
            .otherwise(F.col("p_brand"))
            .alias("share_holder"),
            (F.col("l_discount") * 100).alias("share_own_percent"),
            F.col("l_orderkey").alias("seq1"),
            F.col("l_linenumber").alias("seq2"),
        )

    @staticmethod
    def _subsidiaries(trades: DataFrame) -> DataFrame:
        """Filled lines: an unlisted part is the child; open ones: the customer is; untaxed lines name no child."""
        filled = F.col("l_linestatus") == "F"
        code = F.when(filled, symbol_of("P", "l_partkey")).otherwise(symbol_of("C", "o_custkey"))
        return trades.filter("traded").select(
            symbol_of("S", "l_suppkey").alias("parent_symbol"),
            F.when(F.col("l_tax") == 0, "").otherwise(code).alias("sub_organ_code"),
            F.when(filled, F.col("p_name")).otherwise(F.col("c_name")).alias("organ_name"),
            (F.col("l_tax") * 100).alias("ownership_percent"),
            F.col("p_type").alias("type"),
            F.col("l_orderkey").alias("seq1"),
            F.col("l_linenumber").alias("seq2"),
        )

    @cached_property
    def order_facts(self) -> DataFrame:
        """Dated facts: a customer's order status, replaced by its next order's."""
        return self.table("orders").select(
            symbol_of("C", "o_custkey").alias("subject"),
            F.lit("ORDER_STATUS").alias("predicate"),
            F.col("o_orderstatus").alias("object"),
            F.col("o_orderdate").alias("valid_at"),
            F.col("o_orderkey").alias("seq"),
        )

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents").select(
            F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("name"),
            F.col("text").alias("body"),
            "lang",
            F.col("source").alias("source_description"),
        )

    @cached_property
    def sources(self) -> Sources:
        return Sources(
            overview=self.overview,
            prices=self.prices,
            statements=self.statements,
            ratios=self.ratios,
            officers=self.officers,
            shareholders=self.shareholders,
            subsidiaries=self.subsidiaries,
            versions=VERSIONS,
        )

    @cached_property
    def load_sources(self) -> Sources:
        """The same extracts for loads, which take officers, shareholders and subsidiaries: their trades are joined once and stored."""
        trades = settled(self._trades, "trades")
        return replace(
            self.sources,
            officers=self._officers(trades),
            shareholders=self._shareholders(trades),
            subsidiaries=self._subsidiaries(trades),
        )

    @cached_property
    def graph(self) -> Graph:
        return build_graph(self.sources, stored=True, owned=lambda: self.load_sources)

    @cached_property
    def whole_graph(self) -> Graph:
        """The same graph for what reads all its edges: officers are taken from the stored trades as well."""
        return build_graph(self.load_sources, stored=True)


def price_columns(price: Column, symbol: str = "symbol", day: str = "date", day_type: str = "date") -> list[Column]:
    """Price columns of a line item; a line without discount has no close."""
    return [
        symbol_of("S", "l_suppkey").alias(symbol),
        F.col("l_shipdate").cast(day_type).alias(day),
        price.alias("open"),
        (price * 2).alias("high"),
        (price / 2).alias("low"),
        F.when(F.col("l_discount") > 0, price).alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.col("l_orderkey").alias("seq1"),
        F.col("l_linenumber").alias("seq2"),
    ]
