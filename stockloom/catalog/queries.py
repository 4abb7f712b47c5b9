"""Every operator as a query over a scale folder: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom import schemas
from stockloom.catalog.extracts import TABLES, VERSION, Extracts, price_columns, symbol_of
from stockloom.functions import columns as C
from stockloom.operators import build, choose, facts, lookup, reshape, search, text_index, traverse, vector_index
from stockloom.operators.upsert import last_write_wins
from stockloom.plans import load
from stockloom.plans.joins import settled
from stockloom.session import work_dir
from stockloom.sources import facts_store, store, tables
from stockloom.streaming import daily

Query = Callable[[SparkSession, str], DataFrame]

RANGE = ("1996-01-01", "1997-12-31")
AS_OF = "1998-06-15"
MOMENT = "1998-01-01 00:00:00"
LOAD_TIME = "2001-01-01 00:00:00"
SECOND_LOAD_TIME = "2001-02-01 00:00:00"
METRICS = [f"{status}{line}" for status in "FO" for line in range(1, 8)]

_QUERIES: dict[str, Callable[[Extracts], DataFrame]] = {}


def query(fn: Callable[[Extracts], DataFrame]) -> Callable[[Extracts], DataFrame]:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    def bind(fn: Callable[[Extracts], DataFrame]) -> Query:
        return lambda spark, folder: fn(Extracts(spark, folder))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


# --- scans ------------------------------------------------------------------------


@query
def scan_symbols(x):
    return tables.symbol_list(x.overview)


@query
def scan_overview(x):
    return tables.overview_rows(x.overview)


@query
def scan_price_range(x):
    return tables.price_rows(C.project(x.prices, schemas.PRICE_HISTORY), None, *RANGE)


@query
def scan_ratios(x):
    return tables.ratio_rows(x.ratios)


@query
def scan_officers(x):
    return tables.officer_rows(x.officers)


@query
def scan_shareholders(x):
    return tables.shareholder_rows(x.shareholders)


@query
def scan_stats(x):
    return tables.stats_rows(x.stats)


@query
def scan_statement(x):
    return tables.statement_rows(x.statements, "balance_sheet", "quarter")


@query
def decimal_to_double(x):
    return C.decimals_to_double(x.ratios.withColumn("value", F.col("value").cast("decimal(18,2)")))


@query
def project_schema(x):
    return C.decimals_to_double(C.project(x.ratios, schemas.RATIO_QUARTERLY))


@query
def scan_extract_prices(x):
    return tables.extract_prices(x.provider_prices)


@query
def optional_source_empty(x):
    primary = tables.read_source(x.spark, "tickers.price_history", None)
    return choose.fallback_by_key(primary, tables.extract_prices(x.provider_prices))


# --- projections and filters --------------------------------------------------------


@query
def filter_symbols(x):
    return tables.only(x.overview, x.prices.select("symbol"))


@query
def normalise_prices(x):
    return C.canonical_prices(x.provider_prices)


@query
def inject_symbol(x):
    return C.canonical_prices(x.provider_prices.drop("ticker"), "VNINDEX")


@query
def company_defaults(x):
    return build.company_defaults(x.overview)


@query
def drop_blank_keys(x):
    return C.drop_blank_keys(x.subsidiaries, "sub_organ_code")


@query
def indicator_try_cast(x):
    numbers = [C.number_of(F.col(c)).alias(c) for c in ("pe", "eps", "note")]
    return x.wide_ratios.select("symbol", "seq", *numbers)


@query
def coerce_prices(x):
    return C.coerce_prices(x.prices, VERSION)


@query
def price_day_key(x):
    time = F.col("time")
    return x.provider_prices.select(
        "ticker",
        "seq1",
        "seq2",
        C.day_of(time).alias("of_time"),
        C.day_of(C.iso_text(time)).alias("of_text"),
        C.day_of(time.cast("date")).alias("of_day"),
    )


@query
def statement_quarter(x):
    quarter = C.statement_quarter(F.col("period"), F.col("quarter")).alias("quarter")
    keyed = x.statements.select("symbol", "statement_type", "period", "year", quarter)
    return keyed.groupBy(*build.STATEMENT_KEY).agg(F.count("*").alias("rows"))


@query
def price_history_range(x):
    return lookup.price_history(x.graph.stock_price, None, *RANGE)


@query
def price_lookback(x):
    return C.lookback(C.coerce_prices(x.prices, VERSION), AS_OF)


@query
def price_as_of_day(x):
    return C.on_day(C.coerce_prices(x.prices, VERSION), AS_OF)


@query
def statement_payload(x):
    return reshape.payload_rows(reshape.payload_json(x.graph.financial_statement))


# --- joins ------------------------------------------------------------------------


@query
def prices_known_companies(x):
    return build.known(C.coerce_prices(x.prices, VERSION), build.master_companies(x.overview))


@query
def peers(x):
    # Companies only referred to have no industry, so the master is enough here.
    return lookup.peers(build.master_companies(x.overview), x.graph.belongs_to_industry)


@query
def peers_one(x):
    """The peers of the largest company."""
    master = build.master_companies(x.overview)
    largest = master.orderBy(F.desc("market_cap"), "symbol").limit(1)
    return lookup.peers_of(master, x.graph.belongs_to_industry, largest)


@query
def subsidiaries(x):
    return lookup.subsidiaries(x.graph.company, x.graph.subsidiary_of)


@query
def shareholders(x):
    return lookup.shareholders(x.graph.company, x.graph.holds_stake_in)


@query
def price_history(x):
    return lookup.price_history(x.graph.stock_price)


@query
def indicators(x):
    return lookup.indicators(x.graph.financial_indicator)


@query
def indicators_latest(x):
    return lookup.indicators(x.graph.financial_indicator, latest_only=True)


def _least(df, key):
    """The first symbol of a table, as a table."""
    return df.agg(F.min(key).alias("symbol"))


@query
def subsidiaries_one(x):
    return lookup.subsidiaries(x.graph.company, x.graph.subsidiary_of, _least(x.graph.subsidiary_of, "parent"))


@query
def shareholders_one(x):
    return lookup.shareholders(x.graph.company, x.graph.holds_stake_in, _least(x.graph.holds_stake_in, "target"))


@query
def price_history_one(x):
    return lookup.price_history(x.graph.stock_price, _least(x.graph.stock_price, "symbol"))


@query
def indicators_one(x):
    return lookup.indicators(x.graph.financial_indicator, _least(x.graph.financial_indicator, "symbol"))


@query
def extract_officers(x):
    """A provider's officers, of whom those with a share still work there."""
    status = F.when(F.col("officer_own_percent") > 0, "Working").otherwise("resigned")
    return tables.extract_officers(x.officers.withColumn("status", status))


@query
def extract_shareholders(x):
    return tables.extract_shareholders(x.shareholders)


@query
def extract_subsidiaries(x):
    return tables.extract_subsidiaries(x.subsidiaries)


@query
def extract_listing(x):
    return tables.extract_listing(x.listing)


@query
def extract_overview(x):
    return tables.extract_overview(x.overview)


@query
def extract_ratios(x):
    """A provider's wide ratios: numbers, numbers as text, words and times."""
    return tables.extract_ratios(x.wide_ratios.drop("seq"))


@query
def extract_statement(x):
    """A provider's wide quarterly balance sheets, one column per metric."""
    values = build.statement_metrics(x.statements, build.master_companies(x.overview), VERSION)
    own = values.filter((F.col("statement_type") == "balance_sheet") & (F.col("period") == "quarter"))
    wide = reshape.wide_metrics(own, ["symbol", "year", "quarter"], METRICS)
    return C.decimals_to_double(tables.extract_statement(wide, "balance_sheet", "quarter"))


@query
def cross_shareholding(x):
    return lookup.cross_shareholding(x.graph.holds_stake_in)


@query
def fallback_prices(x):
    """The primary holds prices of one exchange only; the provider has the rest."""
    hose = C.coerce_prices(tables.only(x.prices, x.hose_symbols), VERSION).withColumn("origin", F.lit("primary"))
    provider = tables.extract_prices(x.provider_prices, extra=VERSION).withColumn("origin", F.lit("secondary"))
    return choose.fallback_by_key(hose, provider)


@query
def fallback_overview(x):
    return choose.fallback_table(x.overview.select("symbol", "exchange"), x.listing)


@query
def source_chain(x):
    """Three overlapping providers: one exchange, one sector, the whole listing."""
    first = x.overview.filter(F.col("exchange") == "HOSE").select("symbol", "exchange")
    second = x.overview.filter(F.col("sector") == "ASIA").select("symbol", F.lit("ASIA").alias("exchange"))
    return choose.first_source([first, second, x.listing])


@query
def resolve_holders(x):
    s = x.load_sources
    master = settled(build.master_companies(x.overview), "master")
    children = build.subsidiary_rows(s.subsidiaries, master, VERSION)
    named = build.with_stubs(master, build.child_stubs(children, master))
    return build.resolve_holders(build.holder_rows(s.shareholders, master, VERSION), named)


@query
def stub_companies(x):
    master = build.master_companies(x.overview)
    return build.unknown(x.graph.company, master).select("symbol", "name")


# --- aggregation and reshaping ------------------------------------------------------


@query
def graph_stats(x):
    g = x.graph
    return lookup.graph_stats(g.company, g.stock_price, g.financial_statement, g.financial_indicator)


@query
def statement_pivot(x):
    values = build.statement_metrics(x.statements, build.master_companies(x.overview), VERSION)
    return reshape.wide_metrics(values, build.STATEMENT_KEY, METRICS)


@query
def ratio_unpivot(x):
    return reshape.long_metrics(x.wide_ratios, ["symbol", "year", "quarter", "seq"])


@query
def upsert_last_wins(x):
    return last_write_wins(C.coerce_prices(x.prices, VERSION), ["symbol", "date"], VERSION)


@query
def industries(x):
    return build.industries(x.overview)


@query
def ingest_audit(x):
    asked = load.load_symbols(x.sources, x.sources, x.listing.unionByName(x.overview.select("symbol", "exchange")))
    return load.ingest_audit(x.sources, asked, build.master_companies(x.overview))


@query
def rejected_rows(x):
    return load.rejected_rows(x.sources).groupBy("extract", "missing").agg(F.count("row").alias("rows"))


@query
def loaded_symbols(x):
    return lookup.loaded_symbols(x.prices)


@query
def price_tail(x):
    return lookup.price_tail(x.graph.stock_price)


# --- graph tables -------------------------------------------------------------------


@query
def company_nodes(x):
    return x.graph.company


@query
def industry_links(x):
    return x.graph.belongs_to_industry


@query
def sectors(x):
    return x.graph.sector


@query
def industry_in_sector(x):
    return x.graph.industry_in_sector


@query
def stock_prices(x):
    return x.graph.stock_price


@query
def statement_nodes(x):
    """Statement keys with the payload spelled out to two decimals."""
    entry = lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("decimal(18,2)").cast("string"))
    entries = F.transform(F.map_entries("payload"), entry)
    return x.graph.financial_statement.select(
        *build.STATEMENT_KEY,
        F.size("payload").alias("metrics"),
        F.array_join(entries, ";").alias("payload"),
    )


@query
def indicator_nodes(x):
    return x.graph.financial_indicator


@query
def indicator_nodes_wide(x):
    return build.indicator_nodes(x.wide_ratios, build.master_companies(x.overview), ("seq",), wide=True)


@query
def officer_nodes(x):
    return x.graph.officer


@query
def led_by(x):
    return x.graph.led_by


@query
def subsidiary_edges(x):
    return x.graph.subsidiary_of


@query
def stake_edges(x):
    return x.graph.holds_stake_in


# --- load flows ---------------------------------------------------------------------


@query
def resolve_symbols(x):
    """No master configured: the symbols come from the listing."""
    unset = tables.read_source(x.spark, "tickers.overview_df", None)
    return choose.resolve_symbols(None, unset, x.listing)


@query
def subset_load(x):
    """A load of the companies of one exchange."""
    g = load.build_graph(x.load_sources, x.hose_symbols, stored=True)
    return lookup.graph_stats(g.company, g.stock_price, g.financial_statement, g.financial_indicator)


@query
def graph_merge(x):
    """A full load, then one exchange's companies loaded again with prices closing at their high: the stored prices."""
    root = work_dir(x.spark, "graph")
    store.full_load(x.load_sources, root)
    later = replace(x.load_sources, prices=x.sources.prices.withColumn("close", F.col("high")))
    store.full_load(later, root, x.hose_symbols)
    return store.read_graph(x.spark, root).stock_price


def _second_load(x):
    """The extracts of a later load: prices close at their high, officers own one percent more, stakes are half."""
    s = x.load_sources
    return replace(
        s,
        prices=s.prices.withColumn("close", F.col("high")),
        officers=s.officers.withColumn("officer_own_percent", F.col("officer_own_percent") + 1),
        shareholders=s.shareholders.withColumn("share_own_percent", F.col("share_own_percent") / 2),
    )


def _two_loads(x) -> str:
    """A store with a full load and, on top, one of a single exchange's companies with other values."""
    root = work_dir(x.spark, "graph")
    store.full_load(x.load_sources, root, loaded_at=LOAD_TIME)
    store.full_load(_second_load(x), root, x.hose_symbols, loaded_at=SECOND_LOAD_TIME)
    return root


@query
def graph_merge_tables(x):
    """Two loads: what each of the twelve tables holds then, its keys and one value of every row."""
    graph = store.read_graph(x.spark, _two_loads(x))
    cents = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    text = lambda c: F.col(c).cast("string")
    pairs = F.transform(F.map_entries("payload"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("decimal(18,2)").cast("string")))
    values = {
        "company": text("market_cap"),
        "stock_price": F.concat_ws(" ", cents("close"), text("volume")),
        "financial_statement": F.array_join(pairs, ";"),
        "financial_indicator": cents("value"),
        "officer": F.concat_ws(" ", "position", cents("own_percent")),
        "subsidiary_of": F.concat_ws(" ", cents("ownership_percent"), "relation_type"),
        "holds_stake_in": cents("stake_percent"),
        "led_by": F.concat_ws(" ", "position", cents("own_percent")),
    }
    rows = [
        df.select(
            F.lit(name).alias("table"),
            F.concat_ws("|", *[text(c) for c in store.KEYS[name]]).alias("key"),
            F.coalesce(values.get(name, F.lit("")), F.lit("")).alias("value"),
        )
        for name, df in graph.tables().items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def edge_fact_loads(x):
    """Two loads: every fact of the graph with the episode of the load that wrote its edge."""
    root = _two_loads(x)
    found = facts.edge_facts(store.read_graph(x.spark, root, loads=True), measured=True)
    episodes = store.read_episodes(x.spark, f"{root}/episodes")
    rows = facts.fact_provenance(found, episodes)
    return rows.select("uuid", "subject", "predicate", "object", "episode_name", "reference_time")


@query
def stream_graph(x):
    """Returned lines, closing at their high, streamed onto the stored prices in three folders, one of them handed on twice."""
    root, folder = work_dir(x.spark, "graph"), work_dir(x.spark, "price_files")
    company = settled(build.master_companies(x.overview), "master")
    store.write_tables({"stock_price": x.graph.stock_price}, root, loaded_at=LOAD_TIME)
    lines = x.table("lineitem").filter("l_returnflag = 'R'")
    for part in range(3):
        lines.filter(F.col("l_linenumber") % 3 == part).write.mode("append").parquet(f"{folder}/{part}")
    priced = lambda df: df.select(*price_columns(F.col("l_extendedprice"))).withColumn("close", F.col("high"))
    prepare = lambda batch: build.known(C.coerce_prices(priced(batch), VERSION), company)
    for part in range(3):  # a hand-over may be many files: each is a stream of its own, with all its files in one batch
        stream = daily.price_stream(x.spark, f"{folder}/{part}", TABLES["lineitem"])
        daily.stream_into_graph(stream, root, f"{root}-checkpoint-{part}", prepare, VERSION, f"prices-{part}")
    again = x.spark.read.schema(TABLES["lineitem"]).parquet(f"{folder}/0")
    daily.merge_batch_once(again, 0, root, prepare, VERSION, "prices-0")
    return store.read_graph(x.spark, root).stock_price


@query
def episodes_stored(x):
    """Text episodes of two loads, the second written twice, read back by group."""
    path = work_dir(x.spark, "episodes")
    rows = facts.text_episodes(x.documents, LOAD_TIME, F.col("source_description"))
    for load in ("first", "second", "second"):
        store.append_episodes(rows, path, load)
    return store.read_episodes(x.spark, path, facts.GROUP_ID)


@query
def rejected_measures(x):
    """Prices whose volume is a word where there is no close: the load goes on, the rows are listed."""
    volume = F.when(F.col("close").isNull(), "n/a").otherwise(F.col("volume").cast("string"))
    bad = replace(x.sources, prices=x.sources.prices.withColumn("volume", volume))
    listed = load.rejected_rows(bad).filter("extract = 'prices'")
    number = lambda c, kind: F.get_json_object("row", f"$.{c}").cast(kind).alias(c)
    return listed.select("extract", "missing", number("seq1", "bigint"), number("seq2", "int"))


@query
def daily_upsert(x):
    """One day's provider prices, closing at their high, over the price table."""
    extract = tables.extract_prices(x.provider_prices, extra=VERSION).withColumn("close", F.col("high"))
    company = build.master_companies(x.overview)
    return daily.daily_update(x.graph.stock_price, extract, company, AS_OF, VERSION)


@query
def stream_upsert(x):
    """The line items as a file stream into the price log, read back as the current table."""
    stream = daily.price_stream(x.spark, x.folder, TABLES["lineitem"], "lineitem.parquet")
    prices = stream.select(*price_columns(F.col("l_extendedprice")))
    company = build.master_companies(x.overview)
    prepare = lambda batch: build.known(C.coerce_prices(batch, VERSION), company)
    return daily.streamed_prices(prices, prepare, VERSION)


# --- episodes, facts, search ----------------------------------------------------------


@query
def episodes_text(x):
    return facts.text_episodes(x.documents, LOAD_TIME, F.col("source_description"))


@query
def episodes_json(x):
    rows = x.graph.company.select(
        F.col("symbol").alias("name"), F.col("name").alias("title"), "exchange", "market_cap"
    )
    episodes = facts.json_episodes(rows, ["title", "exchange", "market_cap"], LOAD_TIME)
    return facts.parsed_episodes(episodes, "title string, exchange string, market_cap bigint")


@query
def edge_facts(x):
    return facts.edge_facts(x.whole_graph, measured=True)


@query
def fact_validity(x):
    return facts.fact_validity(x.order_facts)


@query
def validity_merge(x):
    """The open orders' facts stored first, then all others, most of them earlier: the stored intervals."""
    root = work_dir(x.spark, "facts")
    first = F.col("object") == "O"
    facts_store.merge_facts(x.order_facts.filter(first), root)
    facts_store.merge_facts(x.order_facts.filter(~first), root)
    return facts_store.read_facts(x.spark, root)


@query
def facts_at_moments(x):
    """For every line: the status of its customer's last order by the day it was shipped."""
    orders = x.table("orders").select("o_orderkey", symbol_of("C", "o_custkey").alias("subject"))
    lines = x.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("moment"))
    moments = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    found = facts.facts_at_moments(moments, x.order_facts)
    return found.select("l_orderkey", "l_linenumber", "subject", "moment", "fact.object", "fact.valid_at", "fact.seq")


@query
def facts_as_of(x):
    return facts.facts_as_of(facts.fact_validity(x.order_facts), MOMENT)


@query
def fact_provenance(x):
    uuid = F.sha2(F.concat_ws("|", "name", "lang"), 256).alias("uuid")
    found = x.documents.select(
        uuid,
        F.col("source_description").alias("subject"),
        F.lit("WRITTEN_IN").alias("predicate"),
        F.col("lang").alias("object"),
        F.col("name").alias("episode_name"),
    )
    rows = facts.fact_provenance(found, facts.text_episodes(x.documents, LOAD_TIME, F.col("source_description")))
    return rows.withColumn("body", F.sha2("body", 256))


def _texts(x):
    return x.table("documents").select(F.col("doc_id").alias("item_id"), "text")


def _vectors(x):
    return x.table("embeddings").select(F.col("vec_id").alias("item_id"), "embedding")


def _questions(x):
    """Benchmark texts with the vector of the same number."""
    items = x.table("benchmark").select(F.col("item_id").alias("query_id"), "text")
    vectors = x.table("embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    return items.join(vectors, "query_id")


@query
def bm25_topk(x):
    items = x.table("benchmark").select(F.col("item_id").alias("query_id"), "text")
    return search.bm25_topk(_texts(x), items, "item_id", "text")


@query
def vector_topk(x):
    return search.vector_topk(_vectors(x), _questions(x).select("query_id", "embedding"))


@query
def bm25_stored(x):
    """The same ranking from a stored index, to which the texts came in two loads, English ones first."""
    root = work_dir(x.spark, "text_index")
    docs = x.table("documents").select(F.col("doc_id").alias("item_id"), "text", "lang")
    english = F.col("lang").eqNullSafe("en")
    for load in (english, ~english):
        text_index.append_texts(docs.filter(load), root)
    items = x.table("benchmark").select(F.col("item_id").alias("query_id"), "text")
    return text_index.bm25_stored(items, root)


@query
def vector_index_topk(x):
    """The same nearest vectors from a stored inverted file, read until the bound holds."""
    root = work_dir(x.spark, "vector_index")
    vector_index.build(_vectors(x), root)
    return vector_index.search(_questions(x).select("query_id", "embedding"), root)


@query
def hybrid_topk(x):
    return search.hybrid_topk(_texts(x), _vectors(x), _questions(x))


def _largest_per_sector(x, companies):
    """The largest of the given companies in each sector."""
    sized = x.overview.join(companies, "symbol", "left_semi").filter(F.col("market_cap").isNotNull())
    best = sized.groupBy("sector").agg(F.max(F.struct("market_cap", "symbol", "short_name")).alias("_best"))
    return best.select("sector", "_best.symbol", "_best.short_name")


@query
def khop(x):
    """Two steps around the largest company of each sector."""
    seeds = _largest_per_sector(x, x.overview.select("symbol")).select(F.col("symbol").alias("seed"))
    edges = settled(facts.all_edges(x.whole_graph).select("subject", "object"), "edges")  # each edge once, turned as it is read
    return traverse.khop(traverse.both_ways(edges, distinct=False), seeds, 2)


@query
def node_search(x):
    """Nations with their regions, market segments and order priorities, looked up among the entities of all labels."""
    nations = x.table("nation").join(x.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    parts = [
        nations.select(F.col("n_name").alias("query_id"), F.concat_ws(" ", "n_name", "r_name").alias("text")),
        x.table("customer").select(F.col("c_mktsegment").alias("query_id"), F.col("c_mktsegment").alias("text")).distinct(),
        x.table("orders").select(F.col("o_orderpriority").alias("query_id"), F.col("o_orderpriority").alias("text")).distinct(),
    ]
    asked = reduce(DataFrame.unionByName, parts)
    return search.node_search(settled(facts.entities(x.graph), "entities"), asked)


@query
def fact_search(x):
    """Among the facts of all types: what there is about each sector's largest company with a vector, and a day's prices."""
    vectors = x.table("embeddings").select(symbol_of("C", "vec_id").alias("node"), "embedding")
    companies = vectors.select(F.col("node").alias("symbol"))
    largest = _largest_per_sector(x, companies)
    about = F.concat_ws(" ", F.lit("subsidiary or stake or indicator of"), "symbol", "short_name")
    texts = {"": about, " prices": F.lit(f"price on {AS_OF}")}
    asked = [
        largest.select(F.concat("sector", F.lit(kind)).alias("query_id"), F.col("symbol").alias("seed"), text.alias("text"))
        for kind, text in texts.items()
    ]
    asked = reduce(DataFrame.unionByName, asked)
    questions = settled(asked.join(vectors.withColumnRenamed("node", "seed"), "seed"), "questions")
    found = facts.worded(settled(facts.named_edges(x.whole_graph, measured=True), "facts"))
    return search.fact_search(found, questions, traverse.both_ways(found, distinct=False), vectors)
