"""What must not grow with the tables: a task's share and its memory."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F
from test_queries import FOLDER

from stockloom.catalog import extracts
from stockloom.catalog import queries as catalog
from stockloom.operators import build, facts, reshape, search
from stockloom.plans import joins, load
from stockloom.sources import store, tables


def test_wanted_symbols_are_distinct_before_they_are_joined(spark):
    rows = spark.createDataFrame([("A",), ("B",)], "symbol string")
    found = tables.only(rows, spark.range(100).selectExpr("char(65 + cast(id % 1 AS int)) AS symbol"))
    assert "HashAggregate" in found._jdf.queryExecution().executedPlan().toString()
    assert [r.symbol for r in found.collect()] == ["A"]


def test_wide_metrics_hold_a_row_per_group(spark):
    long = spark.createDataFrame([("A", "x", 1.0), ("A", "x", 3.0), ("A", "z", 9.0), ("B", "y", None)], "symbol string, metric string, value double")
    wide = reshape.wide_metrics(long, ["symbol"], ["x", "y"])
    assert "pivot" not in wide._jdf.queryExecution().executedPlan().toString().lower()
    assert [tuple(r) for r in wide.collect()] == [("A", 3.0, None), ("B", None, None)]


def test_a_streamed_hand_over_is_more_than_one_file(spark, tmp_path, monkeypatch):
    folder = tmp_path / "tables"
    folder.mkdir()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        if not path.endswith("lineitem.parquet"):
            os.symlink(path, folder / os.path.basename(path))
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    for part in range(3):  # separate files, each a task of its own
        lines.filter(f"l_orderkey % 3 = {part}").coalesce(1).write.mode("append").parquet(str(folder / "lineitem.parquet"))
    monkeypatch.setattr(catalog, "work_dir", lambda _, purpose: str(tmp_path / purpose))
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        found = catalog.queries()["stream_graph"](spark, str(folder)).count()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == catalog.queries()["stock_prices"](spark, FOLDER).count()
    for part in range(3):
        assert len(glob.glob(f"{tmp_path}/price_files/{part}/*.parquet")) > 1


def shuffles(df):
    """How often the plan deals rows out by key, AQE's own copies aside."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_are_dealt_out_once_for_check_and_reduction(spark, no_broadcast):
    company = spark.createDataFrame([("A",)], "symbol string")
    day = spark.createDataFrame([("A", "2025-01-02", 1.0, 1), ("A", "2025-01-02", 2.0, 2), ("Z", "2025-01-02", 3.0, 1)], "symbol string, date string, close double, seq int")
    held = spark.createDataFrame([("A", "B", 1.0, 1), ("A", "B", 2.0, 2), ("Z", "B", 1.0, 1)], "symbol string, share_holder string, share_own_percent double, seq int")
    prices, holders = build.stock_prices(day, company, ("seq",)), build.holder_rows(held, company, ("seq",))
    assert shuffles(prices) == shuffles(holders) == 2  # the rows and the companies
    assert [(r.symbol, r.close) for r in prices.collect()] == [("A", 2.0)]
    assert [tuple(r) for r in holders.collect()] == [("B", "A", 2.0)]


def test_trades_are_joined_once_for_all_that_read_them(spark, monkeypatch):
    written = []
    keep = extracts.settled
    monkeypatch.setattr(extracts, "settled", lambda df, purpose: written.append(purpose) or keep(df, purpose))
    x = extracts.Extracts(spark, FOLDER)
    assert x.graph.industry.count() and written == []  # a table that needs no trades waits for none
    assert x.graph.holds_stake_in.count() and x.graph.subsidiary_of.count() and written == ["trades"]
    for name in ("shareholders", "subsidiaries"):
        stored, plain = getattr(x.load_sources, name), getattr(x, name)
        assert stored.columns == plain.columns and stored.count() == plain.count() > 0
        assert stored.exceptAll(plain).isEmpty()


def test_lines_are_dealt_out_for_orders_and_parts_alone(spark, no_broadcast):
    plan = extracts.Extracts(spark, FOLDER)._trades._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(o_custkey" in plan and plan.index("hashpartitioning(o_custkey") > plan.index("hashpartitioning(l_orderkey")


def test_a_load_of_some_symbols_cuts_the_extracts_where_they_are_read(spark):
    x = extracts.Extracts(spark, "/root/testdata/sf0.01")
    assert not x.hose_symbols.isEmpty()
    plan = load.build_graph(x.sources, x.hose_symbols, stored=True).stock_price._jdf.queryExecution().optimizedPlan().toString()
    assert "supplier.parquet" not in plan and "s_acctbal" not in plan  # a stored list, not the plan that makes it


def test_a_first_load_writes_its_rows_once(spark, tmp_path, monkeypatch):
    written = []
    keep = store.settled
    monkeypatch.setattr(store, "settled", lambda df, purpose: written.append(purpose) or keep(df, purpose))
    row = lambda d, c: spark.sql(f"SELECT 'A' AS symbol, date '{d}' AS date, {c}D AS close")
    first = row("2024-01-05", 1).unionByName(row("2024-02-05", 2))
    store.write_tables({"stock_price": first, "industry": spark.createDataFrame([("Bank",)], "name string")}, str(tmp_path))
    assert written == []
    assert store.stored_parts(spark, str(tmp_path), "stock_price") == ["2024-01", "2024-02"]
    store.write_tables({"stock_price": row("2024-02-05", 9)}, str(tmp_path))
    assert written == ["load-stock_price"]
    (prices,) = store.read_tables(spark, str(tmp_path), "stock_price")
    assert sorted((str(r.date), r.close, r.load) for r in prices.collect()) == [("2024-01-05", 1.0, 1), ("2024-02-05", 9.0, 2)]


def test_facts_look_up_distinct_objects_of_measurements(spark, monkeypatch):
    """Also a measurement's object that is a company's symbol is named; days are not dealt out one by one."""
    written = {}
    keep = facts.settled
    monkeypatch.setattr(facts, "settled", lambda df, purpose: written.setdefault(purpose, keep(df, purpose)))
    make = spark.createDataFrame
    days = make([("A", f"2024-01-{d:02d}", 1.0) for d in range(1, 29)], "symbol string, date string, close double").withColumn("date", F.col("date").cast("date"))
    empty = {
        "belongs_to_industry": "symbol string, industry string",
        "industry_in_sector": "industry string, sector string",
        "subsidiary_of": "child string, parent string",
        "holds_stake_in": "holder string, target string",
        "led_by": "symbol string, officer_name string",
        "financial_statement": "symbol string, statement_type string, period string, year int, quarter int",
    }
    held = {name: (lambda columns=columns: make([], columns)) for name, columns in empty.items()}
    company = make([("A", "Alpha"), ("2024-01-05", "A day"), ("pe 2024 1", "Odd"), ("B", "Beta")], "symbol string, name string")
    ratio = make([("A", "pe", 2024, 1), ("Z", "pe", 2024, 2)], "symbol string, metric string, year int, quarter int")
    graph = load.Graph(company=lambda: company, stock_price=lambda: days, financial_indicator=lambda: ratio, **held)
    found = {r.fact for r in facts.edge_facts(graph, measured=True).collect()}
    assert len(found) == 30
    assert {"Alpha (A) has a price on 2024-01-04", "Alpha (A) has a price on A day (2024-01-05)", "Alpha (A) has the indicator Odd (pe 2024 1)", "Z has the indicator pe 2024 2"} <= found
    assert sorted(r.object for r in written["objects"].collect()) == ["2024-01-05", "pe 2024 1"]


def test_an_expansion_stores_each_edge_once(spark, monkeypatch):
    stored = {}
    keep = catalog.settled
    monkeypatch.setattr(catalog, "settled", lambda df, purpose: stored.setdefault(purpose, keep(df, purpose)))
    assert not catalog.queries()["khop"](spark, FOLDER).isEmpty()
    assert stored["edges"].columns == ["subject", "object"]
    x = extracts.Extracts(spark, FOLDER)
    assert stored["edges"].count() == facts.all_edges(x.graph).count()


def test_a_search_stores_edges_not_their_words(spark, monkeypatch):
    stored = {}
    keep = catalog.settled
    monkeypatch.setattr(catalog, "settled", lambda df, purpose: stored.setdefault(purpose, keep(df, purpose)))
    assert not catalog.queries()["fact_search"](spark, FOLDER).isEmpty()
    assert not {"uuid", "fact"} & set(stored["facts"].columns)
    x = extracts.Extracts(spark, FOLDER)
    told = facts.worded(stored["facts"])
    assert told.exceptAll(facts.edge_facts(x.graph, measured=True)).isEmpty() and not told.isEmpty()


@pytest.mark.parametrize("little", [True, False])
def test_facts_near_a_seed_are_found_where_they_lie(spark, no_broadcast, monkeypatch, little):
    """Neither what is near nor what is wanted deals the facts out; both ways find the same."""
    written = {}
    monkeypatch.setattr(search, "settled", lambda df, purpose: written.setdefault(purpose, joins.settled(df, purpose)))
    if not little:
        monkeypatch.setattr(search, "SENT_NEAR", 0)
        monkeypatch.setattr(search, "SENT_ITEMS", 0)
    rows = [("u1", "a", "b"), ("u2", "b", "a"), ("u3", "c", "a"), ("u4", "c", "d"), ("u5", None, "b"), ("u6", "b", "b"), ("u7", "d", "c")]
    some = spark.createDataFrame(rows, "uuid string, subject string, object string")
    reached = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (1, "b", 2), (2, "d", 0)], "query_id int, node string, distance int")
    near, sizes = search._near(some, reached)
    want = [(1, "u1", 1), (1, "u2", 1), (1, "u3", 1), (1, "u5", 2), (1, "u6", 2), (2, "u4", 1), (2, "u7", 1)]
    assert sorted(tuple(r) for r in near.collect()) == want
    assert sorted(tuple(r) for r in sizes.collect()) == [(1, 1, 3), (1, 2, 2), (2, 1, 2)]
    assert ("near_facts" in written) == (not little)
    items = spark.createDataFrame([("u2",), ("u9",)], "uuid string")
    found = search._among(some, items, "uuid")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == little
    assert [r.uuid for r in found.collect()] == ["u2"]


def test_stakes_are_compared_for_doubtful_holders_alone(spark, no_broadcast, tmp_path):
    """A name that is no company's but a company's symbol leads to that company's holder; only its rows are dealt out."""
    named = spark.createDataFrame([("A", "Alpha"), ("B", "Beta"), ("C", "Alpha")], "symbol string, name string")
    held = [("Alpha", "B", 1.0), ("A", "B", 2.0), ("Beta", "A", 3.0), ("Fund", "A", 4.0), ("Fund", "B", 5.0)]
    rows = build.resolve_holders(spark.createDataFrame(held, "holder_name string, target string, stake_percent double"), named)
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    doubtful = joins.settled(build.doubtful_holders(rows, named), "doubtful")
    assert [r.holder for r in doubtful.collect()] == ["A"]
    found = build.stake_edges(rows, F.broadcast(doubtful))
    assert shuffles(found) == 1 and "LeftAnti" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, build.stake_edges(rows).collect()))


def test_officers_are_taken_from_the_stored_trades(spark):
    """Also of lines whose order or supplier nobody has, which are no trades."""
    x = extracts.Extracts(spark, FOLDER)
    some = F.col("o_orderkey") % 3 > 0
    x._tables |= {"orders": x.table("orders").filter(some), "supplier": x.table("supplier").filter("s_suppkey > 2")}
    trades = x._trades
    assert trades.filter("NOT traded").count() > 0
    for name in ("officers", "shareholders", "subsidiaries"):
        stored, plain = getattr(x.load_sources, name), getattr(x, name)
        assert stored.count() == plain.count() > 0 and stored.exceptAll(plain).isEmpty()
    lines = x.table("lineitem").join(x.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.join(x.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    assert x.shareholders.count() == lines.count() < x.officers.count() == x.table("lineitem").count()
    plan = x.load_sources.officers._jdf.queryExecution().optimizedPlan().toString()
    assert "trades" in x.load_sources.officers.inputFiles()[0] and "Join" not in plan


def test_shared_objects_are_looked_up_once_each(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(facts, "settled", lambda df, purpose: written.setdefault(purpose, joins.settled(df, purpose)))
    make = spark.createDataFrame
    tables = {
        "company": make([("A", "Alpha"), ("B", "B"), ("Bank", "Banking"), ("C", None)], "symbol string, name string"),
        "belongs_to_industry": make([("A", "Bank"), ("B", "Steel")], "symbol string, industry string"),
        "industry_in_sector": make([("Bank", "Money")], "industry string, sector string"),
        "subsidiary_of": make([("B", "A"), ("C", "A"), ("A", "B")], "child string, parent string"),
        "holds_stake_in": make([("A", "B"), ("Z", "A"), ("Bank", "A")], "holder string, target string"),
        "led_by": make([("A", "Ann")], "symbol string, officer_name string"),
        "stock_price": make([], "symbol string, date date"),
        "financial_statement": make([], "symbol string, statement_type string, period string, year int, quarter int"),
        "financial_indicator": make([], "symbol string, metric string, year int, quarter int"),
    }
    graph = load.Graph(**{name: (lambda df=df: df) for name, df in tables.items()})
    found = facts.edge_facts(graph, measured=True)
    plain = facts.edge_facts(graph)
    assert found.columns == plain.columns and found.count() == plain.count() == 10
    assert found.exceptAll(plain).isEmpty()
    assert {"Alpha (A) holds a stake in B", "C is a subsidiary of Alpha (A)", "Alpha (A) belongs to industry Banking (Bank)"} <= {r.fact for r in found.collect()}
    assert sorted(r.object for r in written["shared_objects"].collect()) == ["A", "Bank"]


def test_a_merge_deals_its_rows_out_once(spark, no_broadcast, monkeypatch):
    """Stored rows and the load's meet in one shuffle, by slices of their parts; a row without a key replaces none."""
    monkeypatch.setattr(store, "SLICE_ROWS", 4)
    make = lambda rows: spark.createDataFrame(rows, "symbol string, date date, close double, load bigint")
    day = lambda i: datetime.date(2024, 1 + i % 2, 1 + i % 9)
    old = [(f"S{i}", day(i), float(i), 1) for i in range(40)] + [(None, day(0), 1.0, 1)]
    new = [(f"S{i}", day(i), -float(i), 2) for i in range(30, 50)] + [("S1", day(2), 9.0, 2), (None, day(0), 2.0, 2)]
    merged = store._merged(make(old), make(new), store._part("stock_price"), "stock_price", store.KEYS["stock_price"])
    assert shuffles(merged) == 1
    want = [r for r in old if r[0] is None or int(r[0][1:]) < 30] + new
    assert sorted(map(repr, (tuple(r)[:4] for r in merged.collect()))) == sorted(map(repr, want))
    assert {r.part for r in merged.collect()} == {"2024-01", "2024-02"}


def test_a_company_only_referred_to_gives_way(spark):
    make = lambda rows: spark.createDataFrame(rows, "symbol string, name string, exchange string, load bigint")
    old = [("A", "Alpha", "X", 1), ("B", "B", None, 1), ("C", "C", None, 1), ("D", "D", "X", 1)]
    new = [("A", "A", None, 2), ("B", "Beta", "X", 2), ("C", "C two", None, 2), ("E", "E", None, 2), ("F", "F", "X", 2), ("F", "F", None, 2)]
    merged = store._merged(make(old), make(new), store._part("company"), "company", store.KEYS["company"])
    found = sorted((r.symbol, r.name, r.load) for r in merged.collect())
    assert found == [("A", "Alpha", 1), ("B", "Beta", 2), ("C", "C", 1), ("D", "D", 1), ("E", "E", 2), ("F", "F", 2)]
