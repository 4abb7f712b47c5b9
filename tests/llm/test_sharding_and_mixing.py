import zlib
from collections import Counter, defaultdict

import pytest
from frames import awkward, awkward_rows, documents, empty, prose
from pyspark.sql import functions as F

from stockloom.llm import mixing
from stockloom.llm.sharding import records, shard


def _checked(rows, got):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return Counter({s: sum(r.size for r in got if r.shard == s) for s in slots})


def test_shards_of_awkward_rows(spark):
    loads = _checked(awkward_rows(), shard(awkward(spark), shards=4).collect())
    assert set(loads) <= set(range(4))
    assert shard(empty(spark)).count() == 0


def test_shards_are_equal_and_keep_equal_texts_together(spark):
    rows = [(i, prose(20 + i % 50, i % 700, 90), "en", "a") for i in range(2000)]
    df = documents(spark, rows)
    got = shard(df, shards=8).collect()
    loads = _checked(rows, got)
    mean = sum(loads.values()) / 8
    assert len(loads) == 8 and max(loads.values()) < 1.02 * mean and min(loads.values()) > 0.98 * mean
    where = defaultdict(set)
    texts = dict((i, t) for i, t, *_ in rows)
    for r in got:
        where[texts[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    again = shard(df.repartition(7), shards=8).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_a_text_larger_than_a_shard_is_divided(spark):
    rows = [(i, "hot " * 30 if i % 3 == 0 else prose(25, i), "en", "a") for i in range(3000)]
    loads = _checked(rows, shard(documents(spark, rows), shards=10).collect())
    mean = sum(loads.values()) / 10
    assert len(loads) == 10 and max(loads.values()) < 1.05 * mean


@pytest.mark.parametrize("shards", [1, 3, 11])
def test_placement_is_that_of_the_definition(spark, shards):
    """Every row's shard and slot, by a loop over all texts in the order of their keys."""
    rows = [(i, prose(3 + i % 40, i % 500, 60), "en", "a") for i in range(900)]
    rows += [(2000 + i, f"copied {i % 4} " * 9, "en", "a") for i in range(120)] + [(5000, prose(900, 7), "en", "a"), (5001, None, "en", "a")]
    df = documents(spark, rows)
    known = sorted((r.key, r.doc_id, r.size) for r in records(df).collect())
    held = Counter()
    for key, _, size in known:
        held[key >> 24] += size
    target = sum(held.values()) / shards
    heavy = {t for t, n in held.items() if n > target / 64}
    assert heavy and max(held.values()) <= target
    loads, where = [0] * shards, {}
    for t in sorted(heavy, key=lambda t: (-held[t], t)):
        where[t] = loads.index(min(loads))
        loads[where[t]] += held[t]
    room = [max(0.0, target - n) for n in loads]
    room = room if sum(room) else [target] * shards
    light = sum(n for t, n in held.items() if t not in heavy)
    cuts = [sum(room[: s + 1]) * max(1, light) / sum(room) for s in range(shards - 1)]
    passed = 0
    for t in sorted(set(held) - heavy):
        where[t] = sum(c <= passed + held[t] / 2 for c in cuts)
        passed += held[t]
    want, slots = {}, Counter()
    for key, doc_id, _ in known:
        want[doc_id] = (where[key >> 24], slots[where[key >> 24]])
        slots[where[key >> 24]] += 1
    assert {r.doc_id: (r.shard, r.slot) for r in shard(df, shards=shards).collect()} == want


def _sainte_lague(votes: dict[str, float], seats: int) -> Counter:
    won: Counter = Counter()
    order = sorted(votes, key=lambda k: (k == "", k))
    for _ in range(seats):
        best = max(order, key=lambda k: (votes[k] / (2 * won[k] + 1), -order.index(k)))
        won[best] += 1
    return won


@pytest.mark.parametrize("seats", [0, 1, 5, 37, 400])
def test_quotas_are_the_highest_quotients(spark, seats):
    votes = {"sa": 1000.0, "sb": 313.0, "sc": 313.0, "sd": 2.0, "": 96.5, "se": 0.0, "sf": 41.0}
    rows = spark.createDataFrame(list(votes.items()), "key string, target double")
    got = {r.key: r.quota for r in mixing.quotas(rows, F.lit(seats)).collect()}
    assert got == {k: _sainte_lague(votes, seats)[k] for k in votes}


def test_shard_quotas_add_up(spark):
    votes = {"sa": 6400.0, "sb": 2000.0, "sc": 640.0, "sd": 64.0}
    rows = spark.createDataFrame(list(votes.items()), "key string, target double")
    got = mixing.shard_quotas(rows, 5).collect()
    assert all(r.quota >= 0 for r in got) and len(got) == 20
    total = Counter()
    for r in got:
        total[r.key] += r.quota
    assert total == _sainte_lague(votes, round(sum(votes.values()) / 64))


def test_mix_of_awkward_rows(spark):
    got = mixing.mix(awkward(spark)).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len((t or "").split())) for i, t, *_ in awkward_rows())
    total, aim = Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.target <= 2 * r.source_size
        total[r.source] += r.taken
        aim[r.source] = r.target
    assert all(abs(total[s] - aim[s]) <= 64 for s in aim)
    assert sum(aim.values()) == pytest.approx(1.5 * sum(r.size for r in got))
    assert mixing.mix(empty(spark)).count() == 0


def test_mix_takes_near_its_targets_whatever_the_buckets(spark):
    rows = [(i, prose(1 + i % 90, i), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(1500)]
    df = documents(spark, rows)
    got = sorted((r.doc_id, r.taken) for r in mixing.mix(df).collect())
    assert got == sorted((r.doc_id, r.taken) for r in mixing.mix(df.repartition(5), bucket_rows=50).collect())
    plan = mixing.mix(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shards_take_their_own_quotas(spark):
    """Documents of one block each: a shard takes as many of a source as its quota says."""
    rows = [(i, prose(64, i), "en", f"s{i % 5 // 2}") for i in range(600)]
    got = mixing.mix(documents(spark, rows), share=0.5, shards=7).collect()
    assert {r.taken for r in got} == {0, 64} and all((r.mix_shard is None) == (r.taken == 0) for r in got)
    aims = spark.createDataFrame(list({("s" + r.source, r.target) for r in got}), "key string, target double")
    want = Counter({(r.key[1:], r.shard): r.quota for r in mixing.shard_quotas(aims, 7).collect()})
    assert Counter((r.source, r.mix_shard) for r in got if r.taken) == +want


@pytest.mark.parametrize("ids", ["none", "one"])
def test_documents_without_an_id_of_their_own_are_spread(spark, ids):
    """Half the rows without an id, or under one; a third of all rows equal in id and text."""
    own = None if ids == "none" else 7
    rows = [(own, prose(1 + i % 50, i), "en", "a") for i in range(300)] + [(1000 + i, prose(40, i), "en", "b") for i in range(300)]
    rows += [(own, prose(30, 9999), "en", "a")] * 300
    df = documents(spark, rows)
    got = mixing.mix(df, bucket_rows=20).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(t.split())) for i, t, *_ in rows)
    taken, aim = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        aim[r.source] = r.target
    assert all(abs(taken[s] - aim[s]) <= 64 for s in aim)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(3), bucket_rows=100).collect()))
    whole = {r.text_md5 for r in got if r.source == "a" and r.taken == r.size}
    assert len({r.text_md5 for r in got if r.source == "a"}) == 301 and 0 < len(whole)


def test_nothing_to_mix(spark):
    got = mixing.mix(documents(spark, [(1, "", "en", "a"), (2, None, None, None)])).collect()
    assert [(r.size, r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 2
