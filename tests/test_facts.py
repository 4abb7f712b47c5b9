import datetime as dt
import random

from stockloom.operators import facts
from stockloom.sources.store import append_episodes


def test_validity_is_the_next_start_also_across_months(spark):
    random.seed(2)
    rows = []
    for seq in range(400):
        subject = "hot" if seq % 2 else random.choice("abc")
        day = dt.datetime(2020, 1, 1) + dt.timedelta(days=random.choice([0, 3, 40, 41, 500, 900]), hours=random.randint(0, 3))
        rows.append((subject, "STATUS", str(seq), day, seq))
    df = spark.createDataFrame(rows, "subject string, predicate string, object string, valid_at timestamp_ntz, seq int")
    want = {}
    for s in {r[0] for r in rows}:
        mine = sorted((r[3], r[4]) for r in rows if r[0] == s)
        for (_, seq), nxt in zip(mine, [*mine[1:], (None, None)], strict=True):
            want[seq] = nxt[0]
    valid = facts.fact_validity(df)
    assert {r.seq: r.invalid_at for r in valid.collect()} == want
    moment = dt.datetime(2020, 2, 15)
    holds = {r.seq for r in facts.facts_as_of(valid, str(moment)).collect()}
    assert holds == {r[4] for r in rows if r[3] <= moment and (want[r[4]] is None or moment < want[r[4]])}
    assert len(holds) == len({r[0] for r in rows if r[3] <= moment})


def test_episodes_are_appended_once_per_load(spark, tmp_path):
    rows = spark.createDataFrame([("n1", "Lời văn"), ("n2", "")], "name string, body string")
    text = facts.text_episodes(rows, "2024-01-02 00:00:00", "report")
    data = spark.createDataFrame([("n3", "Việt", 5, None)], "name string, title string, cap bigint, gone string")
    structured = facts.json_episodes(data, ["title", "cap", "gone"], "2024-01-02 00:00:00")
    path = str(tmp_path)
    for _ in range(2):
        append_episodes(text, path, "one")
    append_episodes(structured, path, "two")
    stored = spark.read.parquet(path)
    assert stored.count() == 3
    assert stored.filter("source = 'json'").first().body == '{"title":"Việt","cap":5}'
    parsed = facts.parsed_episodes(stored, "title string, cap bigint, gone string").first()
    assert (parsed.title, parsed.cap, parsed.gone) == ("Việt", 5, None)


def test_each_fact_finds_its_episode_and_no_other(spark):
    found = spark.createDataFrame([(f"u{i}", "load:x" if i % 3 else "load:y") for i in range(90)] + [("u99", "gone")], "uuid string, episode_name string")
    rows = spark.createDataFrame([("load:x", "bx"), ("load:y", "by"), ("load:z", "bz")], "name string, body string")
    out = facts.fact_provenance(found, facts.text_episodes(rows, "2024-01-02 00:00:00")).collect()
    assert len(out) == 90 and {(r.episode_name, r.body) for r in out} == {("load:x", "bx"), ("load:y", "by")}
