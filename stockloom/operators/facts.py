"""Episodes, facts drawn from the edge tables, and when a fact holds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockloom import schemas
from stockloom.plans.joins import settled
from stockloom.plans.load import Graph

GROUP_ID = "market_facts"
SOURCE_LABEL = "market"


def _episodes(rows: DataFrame, body: Column, source: str, reference_time, label, group_id: str) -> DataFrame:
    when = reference_time if isinstance(reference_time, Column) else F.lit(str(reference_time))
    what = label if isinstance(label, Column) else F.lit(label)
    shaped = rows.select(
        F.col("name").cast("string").alias("name"),
        body.alias("body"),
        F.lit(source).alias("source"),
        when.cast("timestamp_ntz").alias("reference_time"),
        what.alias("source_description"),
        F.lit(group_id).alias("group_id"),
    )
    return shaped.select(*schemas.EPISODE.names)


def text_episodes(
    rows: DataFrame,
    reference_time: Column | str,
    source_description: Column | str = SOURCE_LABEL,
    group_id: str = GROUP_ID,
) -> DataFrame:
    """Free-text episodes from (name, body) rows.

    The time is the caller's, so a repeated run gives the same rows.
    """
    return _episodes(rows, F.col("body"), "text", reference_time, source_description, group_id)


def json_episodes(
    rows: DataFrame,
    data: Sequence[str],
    reference_time: Column | str,
    source_description: Column | str = SOURCE_LABEL,
    group_id: str = GROUP_ID,
) -> DataFrame:
    """Structured episodes: the `data` columns as one JSON object per row."""
    return _episodes(rows, F.to_json(F.struct(*data)), "json", reference_time, source_description, group_id)


def parsed_episodes(episodes: DataFrame, schema) -> DataFrame:
    """JSON episodes with their fields as columns again."""
    parsed = episodes.filter(F.col("source") == "json").withColumn("_data", F.from_json("body", schema))
    return parsed.select("name", "reference_time", "source_description", "group_id", "_data.*")


# --- facts from edges -----------------------------------------------------------

FACT_COLUMNS = ("uuid", "subject", "predicate", "object", "fact", "valid_at", "invalid_at", "episode_name")

# What a fact says between its two names, by relationship type.
PHRASES = {
    "BELONGS_TO_INDUSTRY": "belongs to industry",
    "INDUSTRY_IN_SECTOR": "is an industry in sector",
    "SUBSIDIARY_OF": "is a subsidiary of",
    "HOLDS_STAKE_IN": "holds a stake in",
    "LED_BY": "is led by",
    "HAS_PRICE": "has a price on",
    "HAS_STATEMENT": "has a statement",
    "HAS_INDICATOR": "has the indicator",
}


def relations(graph: Graph) -> DataFrame:
    """The five stored relationship types as (subject, predicate, object)."""

    def part(df: DataFrame, predicate: str, subject: str, obj: str) -> DataFrame:
        return df.select(
            F.col(subject).alias("subject"),
            F.lit(predicate).alias("predicate"),
            F.col(obj).alias("object"),
            *[c for c in df.columns if c == "load"],
        )

    return reduce(
        DataFrame.unionByName,
        [
            part(graph.belongs_to_industry, "BELONGS_TO_INDUSTRY", "symbol", "industry"),
            part(graph.industry_in_sector, "INDUSTRY_IN_SECTOR", "industry", "sector"),
            part(graph.subsidiary_of, "SUBSIDIARY_OF", "child", "parent"),
            part(graph.holds_stake_in, "HOLDS_STAKE_IN", "holder", "target"),
            part(graph.led_by, "LED_BY", "symbol", "officer_name"),
        ],
    )


def measurements(graph: Graph) -> DataFrame:
    """The three relationship types that are a child table's symbol column."""
    return reduce(DataFrame.unionByName, _measurements(graph))


def _measurements(graph: Graph) -> list[DataFrame]:
    statement = F.concat_ws(" ", "statement_type", "period", "year", "quarter")
    indicator = F.concat_ws(" ", "metric", "year", "quarter")
    day = F.col("date").cast("string")
    parts = [
        (graph.stock_price, "HAS_PRICE", day, F.col("date").cast("timestamp_ntz")),
        (graph.financial_statement, "HAS_STATEMENT", statement, F.lit(None).cast("timestamp_ntz")),
        (graph.financial_indicator, "HAS_INDICATOR", indicator, F.lit(None).cast("timestamp_ntz")),
    ]
    return [
        df.select(
            F.col("symbol").alias("subject"),
            F.lit(predicate).alias("predicate"),
            obj.alias("object"),
            at.alias("valid_at"),
            *[c for c in df.columns if c == "load"],
        )
        for df, predicate, obj, at in parts
    ]


def all_edges(graph: Graph) -> DataFrame:
    """All eight relationship types as (subject, predicate, object, valid_at)."""
    stored = relations(graph).withColumn("valid_at", F.lit(None).cast("timestamp_ntz"))
    return stored.unionByName(measurements(graph))


def edge_facts(graph: Graph, measured: bool = False) -> DataFrame:
    """One fact per edge, in words, naming companies by name and symbol.

    `measured` adds prices, statements and indicators. The load is the episode
    a fact traces back to: of a graph read with its loads, the one that wrote the edge.
    """
    return worded(named_edges(graph, measured))


def named_edges(graph: Graph, measured: bool = False) -> DataFrame:
    """The edges with the names of both ends, where these are companies: all that a fact is worded from, without its words.

    Measured facts meet their companies table by table, where the rows already lie by symbol, and are then written out:
    their objects are many facts' days and periods, so only the distinct ones are looked up among the companies. So are
    parents, industries, sectors and officers, which have many edges each: the names found are sent to the edges if they
    are few. Only what a stake is held in is looked up edge by edge. A company named like its symbol needs no look-up.
    """
    names = graph.company.select("symbol", "name")
    if measured:
        names = settled(names, "names")
    names = names.filter(F.col("name") != F.col("symbol"))
    subject = names.select(F.col("symbol").alias("subject"), F.col("name").alias("_subject_name"))
    obj = names.select(F.col("symbol").alias("object"), F.col("name").alias("_object_name"))
    rows, undated = relations(graph), F.lit(None).cast("timestamp_ntz")
    if not measured:
        return rows.withColumn("valid_at", undated).join(subject, "subject", "left").join(obj, "object", "left")

    def met(rows: DataFrame, purpose: str) -> DataFrame:
        few = settled(obj.join(rows.select("object").distinct(), "object", "left_semi"), purpose)
        return rows.join(few, "object", "left")

    stake = F.col("predicate") == "HOLDS_STAKE_IN"
    stakes = rows.filter(stake).drop("predicate").join(subject, "subject", "left").join(obj, "object", "left")
    own = settled(reduce(DataFrame.unionByName, [df.join(subject, "subject", "left") for df in _measurements(graph)]), "measured")
    parts = [stakes.withColumn("predicate", F.lit("HOLDS_STAKE_IN")), met(rows.filter(~stake), "shared_objects").join(subject, "subject", "left")]
    return reduce(DataFrame.unionByName, [part.withColumn("valid_at", undated) for part in parts]).unionByName(met(own, "objects"))


def worded(named: DataFrame) -> DataFrame:
    """Named edges as facts. A fact's id and words take far more room than its edge, and follow from that one row."""

    def shown(symbol: str, name: str) -> Column:
        titled = F.concat(F.col(name), F.lit(" ("), F.col(symbol), F.lit(")"))
        return F.when(F.col(name) != F.col(symbol), titled).otherwise(F.col(symbol))

    phrase = F.create_map(*[F.lit(x) for pair in PHRASES.items() for x in pair])
    return named.select(
        F.sha2(F.concat_ws("|", "subject", "predicate", "object"), 256).alias("uuid"),
        "subject",
        "predicate",
        "object",
        F.concat_ws(
            " ", shown("subject", "_subject_name"), phrase[F.col("predicate")], shown("object", "_object_name")
        ).alias("fact"),
        "valid_at",
        F.lit(None).cast("timestamp_ntz").alias("invalid_at"),
        F.concat(F.lit("load:"), F.col("load") if "load" in named.columns else F.lower("predicate")).alias("episode_name"),
    )


def entities(graph: Graph) -> DataFrame:
    """Searchable entities of all seven labels. What a company has is named by its symbol and its own key."""

    def part(df: DataFrame, kind: str, key: Column, name: Column, summary: Column) -> DataFrame:
        return df.select(
            F.sha2(F.concat_ws("|", F.lit(kind), key), 256).alias("uuid"), name.alias("name"), summary.alias("summary")
        )

    def owned(df: DataFrame, kind: str, *key: str) -> DataFrame:
        name = F.concat_ws(" ", "symbol", *[F.col(c).cast("string") for c in key])
        return part(df, kind, F.concat_ws("|", "symbol", *[F.col(c).cast("string") for c in key]), name, F.lit(kind))

    about_company = F.concat_ws(" ", F.lit("Company"), "symbol", F.nullif("exchange", F.lit("")))
    about_officer = F.concat_ws(" ", F.lit("Officer"), "position")
    named = F.col("name")
    return reduce(
        DataFrame.unionByName,
        [
            part(graph.company, "Company", F.col("symbol"), named, about_company),
            part(graph.industry, "Industry", named, named, F.lit("Industry")),
            part(graph.sector, "Sector", named, named, F.lit("Sector")),
            part(graph.officer, "Officer", F.col("officer_name"), F.col("officer_name"), about_officer),
            owned(graph.stock_price, "StockPrice", "date"),
            owned(graph.financial_statement, "FinancialStatement", "statement_type", "period", "year", "quarter"),
            owned(graph.financial_indicator, "FinancialIndicator", "metric", "year", "quarter"),
        ],
    )


# --- validity ---------------------------------------------------------------------


def month_starts(facts: DataFrame, about: Sequence[str]) -> DataFrame:
    """(about, `_month`, `_first`): when each subject's first fact of a month starts."""
    return facts.groupBy(*about, F.trunc("valid_at", "month").alias("_month")).agg(F.min("valid_at").alias("_first"))


def closed(facts: DataFrame, starts: DataFrame, about: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Facts of whole months with their `invalid_at`; `starts` names all months of their subjects that have facts."""
    rows = facts.withColumn("_month", F.trunc("valid_at", "month"))
    within = W.partitionBy(*about, "_month").orderBy(*order)
    over_months = W.partitionBy(*about).orderBy("_month")
    chain = starts.withColumn("_next_month_first", F.lead("_first").over(over_months)).drop("_first")
    chained = rows.withColumn("_next", F.lead("valid_at").over(within))
    joined = chained.join(chain, [*about, "_month"])
    return joined.withColumn("invalid_at", F.coalesce("_next", "_next_month_first")).select(*facts.columns, "invalid_at")


def fact_validity(
    facts: DataFrame, about: Sequence[str] = ("subject", "predicate"), order: Sequence[str] = ("valid_at", "seq")
) -> DataFrame:
    """`invalid_at`: when the next fact about the same thing starts, null for the last.

    Facts are ordered within a month only, so one subject with a large share of
    all facts is spread over its months. A month's last fact ends where the
    subject's next month with facts begins; that is read from the months' first
    facts, a table of one row per subject and month.
    """
    return closed(facts, month_starts(facts, about), about, order)


def facts_at_moments(
    moments: DataFrame,
    facts: DataFrame,
    subject: str = "subject",
    moment: str = "moment",
    order: Sequence[str] = ("valid_at", "seq"),
) -> DataFrame:
    """Each row of `moments` with the last fact about its subject that had begun by then, as the column `fact`.

    `fact` is a struct of the fact's columns, null where none had begun; a fact that begins at the moment itself counts,
    and of facts that begin together the last in `order`. A moment that is null has no fact. Facts and
    moments are put in one table and ordered within a subject's month, where a running last value finds the fact, so
    no range is joined and a subject with most of the rows is as many groups as it has months. What
    was last before a month is carried on over a table of one row per subject and month.
    """
    value = F.struct(*[F.col(c) for c in facts.columns])
    rank = F.struct(*order)
    own = F.struct(*moments.columns)
    rows = facts.filter(F.col("valid_at").isNotNull()).select(
        F.col(subject).alias("_subject"), F.col("valid_at").cast("timestamp_ntz").alias("_at"), value.alias("_fact"), rank.alias("_rank")
    )
    asked = moments.select(F.col(subject).alias("_subject"), F.col(moment).cast("timestamp_ntz").alias("_at"), own.alias("_asked"))
    both = rows.unionByName(asked, allowMissingColumns=True).withColumn("_month", F.trunc("_at", "month"))
    key = ["_subject", "_month"]
    months = both.groupBy(*key).agg(F.max_by("_fact", F.when(F.col("_fact").isNotNull(), F.col("_rank"))).alias("_of_month"))
    before = W.partitionBy("_subject").orderBy("_month").rowsBetween(W.unboundedPreceding, -1)
    carried = months.select(*key, F.last("_of_month", ignorenulls=True).over(before).alias("_carried"))
    # facts first among equal times, so that a moment sees those that begin with it
    upto = W.partitionBy(*key).orderBy("_at", F.col("_asked").isNotNull(), "_rank")
    running = F.last("_fact", ignorenulls=True).over(upto.rowsBetween(W.unboundedPreceding, W.currentRow))
    met = both.withColumn("_running", running).filter(F.col("_asked").isNotNull())
    same = (F.col("_subject").eqNullSafe(F.col("_c_subject"))) & (F.col("_month").eqNullSafe(F.col("_c_month")))
    named = carried.select(F.col("_subject").alias("_c_subject"), F.col("_month").alias("_c_month"), "_carried")
    found = F.when(F.col("_at").isNotNull(), F.coalesce("_running", "_carried")).alias("fact")
    return met.join(named, same, "left").select("_asked.*", found)


def facts_as_of(facts: DataFrame, moment: str) -> DataFrame:
    """Facts that hold at a moment: begun, and not yet replaced."""
    at = F.lit(moment).cast("timestamp_ntz")
    return facts.filter((F.col("valid_at") <= at) & (F.col("invalid_at").isNull() | (at < F.col("invalid_at"))))


def fact_provenance(facts: DataFrame, episodes: DataFrame) -> DataFrame:
    """Each fact with the episode it came from.

    Plain join: episodes carry whole texts, so they are not repeated to spread
    a busy episode's facts; the adaptive skew join splits just those.
    """
    source = episodes.select(
        F.col("name").alias("episode_name"),
        F.col("source").alias("episode_source"),
        "reference_time",
        "source_description",
        "body",
    )
    return facts.join(source, "episode_name")
