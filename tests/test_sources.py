import pytest

from stockloom import schemas
from stockloom.operators import choose
from stockloom.sources import tables

FOLDER = "/root/testdata/sf0.001"


def test_source_tables_are_all_declared():
    assert len(schemas.SOURCE_TABLES) == 13
    assert schemas.SOURCE_TABLES["tickers.price_history"]["close"].nullable is False
    assert len(schemas.STATS.names) == 17


def test_labels_and_relationships_are_distinct():
    assert len(set(schemas.NODE_LABELS)) == 7 and len(set(schemas.REL_TYPES)) == 8


@pytest.mark.parametrize("name", list(schemas.SOURCE_TABLES))
def test_unset_source_is_empty_and_typed(spark, name):
    df = tables.read_source(spark, name, None)
    assert df.columns == schemas.SOURCE_TABLES[name].names
    assert "decimal" not in str(df.dtypes) and df.count() == 0


def test_unreadable_source_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path"):
        tables.read_source(spark, "tickers.overview_df", str(tmp_path / "absent")).count()


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_formats(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    spark.sql("SELECT 'A' AS symbol, date '2025-01-02' AS date, 1D AS open, 2D AS high, 3D AS low, 4D AS close, 5L AS volume").write.format(
        fmt
    ).save(path)
    df = tables.read_table(spark, path, schemas.PRICE_HISTORY, fmt)
    assert df.columns == schemas.PRICE_HISTORY.names
    assert tuple(df.first())[0] == "A" and df.first().close == 4.0 and df.first().volume == 5


def test_database_tables_are_split_or_said_to_be_small(spark):
    with pytest.raises(ValueError, match="one_task"):
        tables.read_jdbc(spark, "jdbc:none", "prices", schemas.PRICE_HISTORY)
    assert tables.read_jdbc(spark, None, "prices", schemas.PRICE_HISTORY).count() == 0


def test_symbol_choice(spark):
    df = spark.createDataFrame([("A",), ("B",), ("B",), ("C",)], "symbol string")
    asked = spark.createDataFrame([("B",), ("B",), ("C",)], "symbol string")
    assert tables.only(df, None).count() == 4
    assert tables.only(df, "B").count() == 2
    assert tables.only(df, ["A", "C"]).count() == 2
    assert tables.only(df, asked).count() == 3


def test_symbol_and_day_filters_reach_the_file(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.sql("SELECT 'A' AS symbol, date '2025-01-02' AS date, 1D AS open, 2D AS high, 3D AS low, 4D AS close, 5L AS volume").write.parquet(path)
    df = tables.price_rows(tables.read_table(spark, path, schemas.PRICE_HISTORY), "A", "2025-01-01", "2025-12-31")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = df.select("close")._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters")[1]
    assert "EqualTo(symbol,A)" in pushed and "GreaterThanOrEqual(date" in pushed and "Less" in pushed
    assert "volume" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_statements_prune_folders_and_unknown_pairs_are_empty(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = [
        ("A", t, p, 2024, 1 if p == "quarter" else None, "m", 1.0)
        for t in schemas.STATEMENT_TYPES
        for p in schemas.PERIODS
    ]
    df = spark.createDataFrame(rows, "symbol string, statement_type string, period string, year int, quarter int, metric string, value double")
    df.write.partitionBy("statement_type", "period").parquet(path)
    read = spark.read.parquet(path)
    picked = tables.statement_rows(read, "cash_flow", "quarter", "A")
    assert picked.count() == 1
    assert "PartitionFilters: [isnotnull(statement_type" in picked._jdf.queryExecution().executedPlan().toString()
    assert tables.statement_rows(read, "cash_flow", "week").count() == 0


def test_wide_provider_statement_becomes_long(spark):
    df = spark.createDataFrame([(2024, 1, 5.0, None, "x")], "year int, quarter int, assets double, debts double, note string")
    out = tables.extract_statement(df, "balance_sheet", "quarter", "VCB")
    assert [(r.symbol, r.statement_type, r.metric, float(r.value)) for r in out.collect()] == [
        ("VCB", "balance_sheet", "assets", 5.0)
    ]


def test_provider_overview_and_ratios(spark):
    df = spark.createDataFrame([("??", "Alpha", 5)], "symbol string, short_name string, market_cap int")
    row = tables.extract_overview(df, "VCB").first()
    assert (row.symbol, row.short_name, row.market_cap, row.sector) == ("VCB", "Alpha", 5, None)
    wide = spark.createDataFrame([(2024, 1, 7.5, None)], "year int, quarter int, pe double, roe double")
    assert [tuple(r) for r in tables.extract_ratios(wide, "VCB").collect()] == [("VCB", 2024, 1, "pe", 7.5)]


def test_officers_still_working(spark):
    df = spark.createDataFrame([("X", "working"), ("Y", "resigned")], "officer_name string, status string")
    assert [r.officer_name for r in tables.extract_officers(df, "VCB").collect()] == ["X"]


def test_fallback_is_per_symbol_and_for_whole_tables(spark):
    first = spark.createDataFrame([("A", 1), ("A", 2)], "symbol string, v int")
    second = spark.createDataFrame([("A", 9), ("B", 8)], "symbol string, v int")
    none = first.limit(0)
    both = {tuple(r) for r in choose.fallback_by_key(first, second).collect()}
    assert both == {("A", 1), ("A", 2), ("B", 8)}
    assert choose.fallback_table(first, second).count() == 2
    assert {tuple(r) for r in choose.fallback_table(none, second).collect()} == {("A", 9), ("B", 8)}


def test_first_source_with_rows_wins_per_symbol(spark):
    make = lambda *r: spark.createDataFrame(list(r), "symbol string, v int")
    out = choose.first_source([make(("A", 1)), make(("A", 2), ("B", 3), ("B", 4)), make(("B", 5), ("C", 6))])
    assert {tuple(r) for r in out.select("symbol", "v", "priority").collect()} == {
        ("A", 1, 1),
        ("B", 3, 2),
        ("B", 4, 2),
        ("C", 6, 3),
    }
    assert choose.provider_chain("KBS") == ["KBS", "VCI"] and choose.provider_chain("X") == ["X", "VCI", "KBS"]


def test_symbols_asked_for_come_first(spark):
    master = spark.createDataFrame([("A",), ("B",)], "symbol string")
    listing = spark.createDataFrame([("L",)], "symbol string")
    got = lambda *a: sorted(r.symbol for r in choose.resolve_symbols(*a).collect())
    assert got(["Z", "Z", "Y"], master, listing) == ["Y", "Z"]
    assert got(None, master, listing) == ["A", "B"]
    assert got(None, master.limit(0), listing) == ["L"]
    assert got(None, master.limit(0), listing.limit(0)) == []
