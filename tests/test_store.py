"""The stored graph: parts and versions, loads that break off, batches handed on twice, facts that arrive late."""

import os
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stockloom.operators import facts
from stockloom.sources import facts_store, store
from stockloom.streaming import daily

PRICES = "symbol string, date date, open double, high double, low double, close double, volume bigint"


def prices(spark, rows):
    made = [(s, datetime.fromisoformat(d).date(), 1.0, 1.0, 1.0, float(c), 1) for s, d, c in rows]
    return spark.createDataFrame(made, PRICES)


def closes(spark, root):
    return {(r.symbol, str(r.date)): r.close for r in store.read_tables(spark, root, "stock_price")[0].collect()}


def test_a_load_writes_its_own_months_only(spark, tmp_path):
    root = str(tmp_path)
    store.merge_prices(prices(spark, [("A", "2024-01-05", 1), ("A", "2024-02-05", 2), ("B", "2024-02-06", 3)]), root)
    before = {f for d, _, fs in os.walk(root) for f in (os.path.join(d, n) for n in fs) if "stock_price" in f}
    store.merge_prices(prices(spark, [("A", "2024-02-05", 9), ("C", "2024-03-01", 4)]), root)
    assert closes(spark, root) == {("A", "2024-01-05"): 1, ("A", "2024-02-05"): 9, ("B", "2024-02-06"): 3, ("C", "2024-03-01"): 4}
    assert sorted(os.listdir(tmp_path / "stock_price" / "v2"))[-2:] == ["part=2024-02", "part=2024-03"]
    assert not [f for f in before if not os.path.exists(f)]  # no folder of the version before is touched
    loads = {(r.symbol, str(r.date)): r.load for r in store.read_tables(spark, root, "stock_price")[0].collect()}
    assert loads[("B", "2024-02-06")] == 1 and loads[("A", "2024-02-05")] == 2 and loads[("A", "2024-01-05")] == 1


def test_a_load_that_breaks_off_between_tables_changes_none(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    store.merge_prices(prices(spark, [("A", "2024-01-05", 1)]), root)
    monkeypatch.setattr(store, "_write_episode", lambda *_: 1 / 0)  # prices are written, their version is not
    with pytest.raises(ZeroDivisionError):
        store.merge_prices(prices(spark, [("A", "2024-01-05", 7), ("A", "2024-02-01", 8)]), root)
    assert closes(spark, root) == {("A", "2024-01-05"): 1} and store.current_version(spark, root) == 1
    monkeypatch.undo()
    store.merge_prices(prices(spark, [("A", "2024-01-05", 5)]), root)  # goes over what the broken load left
    assert closes(spark, root) == {("A", "2024-01-05"): 5} and store.current_version(spark, root) == 2


def test_empty_tables_are_stored_with_their_columns(spark, tmp_path):
    root = str(tmp_path)
    store.merge_prices(prices(spark, []), root)
    (df,) = store.read_tables(spark, root, "stock_price")
    assert df.columns == [*PRICES.replace(" string", "").replace(" date,", ",").replace(" double", "").replace(" bigint", "").split(", "), "load"]
    assert df.count() == 0
    with pytest.raises(ValueError, match="no graph"):
        store.read_graph(spark, str(tmp_path / "nowhere"))


def test_replacing_everything_forgets_other_parts(spark, tmp_path):
    root = str(tmp_path)
    store.merge_prices(prices(spark, [("A", "2024-01-05", 1)]), root)
    store.write_tables({"stock_price": prices(spark, [("A", "2024-02-05", 2)])}, root, merge=False)
    assert closes(spark, root) == {("A", "2024-02-05"): 2}
    store.merge_prices(prices(spark, [("A", "2024-03-05", 3)]), root)
    assert closes(spark, root) == {("A", "2024-02-05"): 2, ("A", "2024-03-05"): 3}


def test_a_batch_handed_on_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    same = lambda df: df
    daily.merge_batch_once(prices(spark, [("A", "2024-02-05", 1)]), 0, root, same)
    daily.merge_batch_once(prices(spark, [("A", "2024-02-05", 2), ("A", "2024-01-01", 3)]), 1, root, same)  # a late day
    daily.merge_batch_once(prices(spark, [("A", "2024-02-05", 1)]), 0, root, same)
    assert closes(spark, root) == {("A", "2024-02-05"): 2, ("A", "2024-01-01"): 3}
    assert store.current_version(spark, root) == 2
    daily.merge_batch_once(prices(spark, [("A", "2024-02-05", 4)]), 0, root, same, stream="other")
    assert closes(spark, root)["A", "2024-02-05"] == 4


def test_every_load_has_its_episode(spark, tmp_path):
    root = str(tmp_path)
    store.write_tables({"stock_price": prices(spark, [("A", "2024-01-05", 1)])}, root, loaded_at="2024-01-06 01:02:03")
    store.merge_prices(prices(spark, [("A", "2024-02-05", 1)]), root)
    found = {r.name: r for r in store.read_episodes(spark, f"{root}/episodes").collect()}
    assert set(found) == {"load:1", "load:2"}
    assert found["load:1"].reference_time == datetime(2024, 1, 6, 1, 2, 3)
    assert '"stock_price": 1' in found["load:1"].body


FACTS = "subject string, predicate string, object string, valid_at timestamp_ntz, seq bigint"


def dated(n, seed, subjects=("hot", "hot", "a", "b")):
    lucky = random.Random(seed)
    day = lambda: datetime(2023, lucky.randrange(1, 13), lucky.randrange(1, 28), lucky.randrange(3))
    return [(lucky.choice(subjects), "IS", f"o{lucky.randrange(9)}", day(), seed * 1000 + i) for i in range(n)]


def shown(df):
    return sorted((r.subject, r.valid_at, r.seq, r.object, r.invalid_at) for r in df.collect())


def test_intervals_stay_right_as_facts_arrive(spark, tmp_path):
    """Several loads in any order, one twice: the stored intervals are those of all facts together."""
    root, every = str(tmp_path), []
    for seed, n in ((1, 30), (2, 1), (3, 40), (4, 2)):
        every += dated(n, seed)
        load = spark.createDataFrame(dated(n, seed), FACTS)
        facts_store.merge_facts(load, root)
        assert shown(facts_store.read_facts(spark, root)) == shown(facts.fact_validity(spark.createDataFrame(every, FACTS)))
    facts_store.merge_facts(spark.createDataFrame(dated(40, 3), FACTS), root)
    assert shown(facts_store.read_facts(spark, root)) == shown(facts.fact_validity(spark.createDataFrame(every, FACTS)))


def test_only_the_months_concerned_are_written(spark, tmp_path):
    root = str(tmp_path)
    on = lambda s, m, d, i: (s, "IS", "x", datetime(2023, m, d), i)
    facts_store.merge_facts(spark.createDataFrame([on("a", 1, 1, 1), on("a", 3, 1, 2), on("a", 9, 1, 3), on("b", 6, 1, 4)], FACTS), root)
    facts_store.merge_facts(spark.createDataFrame([on("a", 5, 1, 5)], FACTS), root)
    assert sorted(os.listdir(tmp_path / "fact" / "v2"))[-2:] == ["part=2023-03", "part=2023-05"]
    ends = {r.seq: r.invalid_at for r in facts_store.read_facts(spark, root).collect()}
    assert ends == {1: datetime(2023, 3, 1), 2: datetime(2023, 5, 1), 5: datetime(2023, 9, 1), 3: None, 4: None}


def brute_at(moments, rows):
    out = []
    for subject, moment, key in moments:
        known = [(r[3], r[4], r[2]) for r in rows if r[0] == subject and moment is not None and r[3] <= moment]
        out.append((key, max(known)[1] if known else None))
    return sorted(out)


def test_facts_at_moments_against_brute_force(spark):
    """Moments before, between, at and after facts; a subject with most rows; null moments and subjects; equal times."""
    rows = dated(120, 7)
    lucky = random.Random(9)
    times = [r[3] for r in rows]
    moments = [(lucky.choice(["hot", "hot", "a", "b", "none"]), lucky.choice(times), i) for i in range(80)]
    moments += [("hot", datetime(2020, 1, 1), 100), ("a", datetime(2030, 1, 1), 101), ("hot", None, 102)]
    moments += [("b", datetime(2023, 12, 31), 103)] * 2
    asked = spark.createDataFrame([*moments, (None, datetime(2023, 5, 5), 104)], "subject string, moment timestamp_ntz, key bigint")
    got = facts.facts_at_moments(asked.repartition(4), spark.createDataFrame(rows, FACTS).repartition(3))
    assert got.columns == [*asked.columns, "fact"]
    have = sorted((r.key, r.fact.seq if r.fact else None) for r in got.collect())
    assert have == sorted([*brute_at(moments, rows), (104, None)])
    assert facts.facts_at_moments(asked.limit(0), spark.createDataFrame(rows, FACTS)).count() == 0
    none = facts.facts_at_moments(asked, spark.createDataFrame([], FACTS)).collect()
    assert len(none) == len(moments) + 1 and not any(r.fact for r in none)


def test_a_hot_subject_is_as_many_groups_as_months(spark):
    """The plan orders by subject and month; no window holds a whole subject's facts and no range is joined."""
    asked = spark.createDataFrame([("a", datetime(2023, 5, 5))], "subject string, moment timestamp_ntz")
    plan = facts.facts_at_moments(asked, spark.createDataFrame(dated(9, 1), FACTS))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("_fact#" in w and "[_subject#" in w and "_month#" in w.split("], [")[1] for w in windows if "], [" in w)
    assert not re.search("<=[^>]", plan) and "NestedLoop" not in plan
