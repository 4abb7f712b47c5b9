from collections import Counter

import pytest
from frames import awkward, awkward_rows, documents, empty
from pyspark.sql import functions as F

from stockloom.llm.exact_dedup import exact_dedup
from stockloom.llm.line_dedup import lines_of, remove_spread_lines, spread_lines


@pytest.mark.parametrize("heavy", [1, 256])
def test_exact_dedup_against_brute_force(spark, heavy):
    """Which texts the sketch names must not matter: with one winner or many, the result is the same."""
    got = exact_dedup(awkward(spark), heavy=heavy, tracked=512).collect()
    rows = awkward_rows()
    size = Counter(t or "" for _, t, _, _ in rows)
    keep = {t: max((i for i, u, _, _ in rows if (u or "") == t and i is not None), default=None) for t in size}
    expected = Counter((i, keep[t or ""], size[t or ""]) for i, t, _, _ in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == expected
    kept = [r for r in got if r.kept]
    assert len(kept) == len(size) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_hot_text(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i}", "en", "a") for i in range(3000)]
    got = exact_dedup(documents(spark, rows))
    hot = got.filter("group_size = 1000")
    assert hot.count() == 1000 and hot.filter("kept").first().doc_id == 2997
    assert got.filter("kept").count() == 2001


def shuffled_rows(spark, since):
    """Rows written to shuffles by the executions numbered from `since` on."""
    store = spark._jsparkSession.sharedState().statusStore()
    runs, rows = store.executionsList(), 0
    for i in range(runs.size()):
        run = runs.apply(i).executionId()
        if run < since:
            continue
        nodes, values = store.planGraph(run).allNodes(), store.executionMetrics(run)
        for j in range(nodes.size()):
            metrics = nodes.apply(j).metrics()
            for m in range(metrics.size()):
                metric = metrics.apply(m)
                if metric.name() == "shuffle records written" and values.contains(metric.accumulatorId()):
                    rows += int(values.apply(metric.accumulatorId()).replace(",", ""))
    return rows


def test_copies_of_a_heavy_text_are_not_shuffled(spark):
    """Half of 40,000 rows hold one text, 4,000 of them the same id: what is shuffled is the rest."""
    rows = [(min(i, 36_000), "heavy" if i % 2 == 0 else f"text {i}", "en", "a") for i in range(40_000)]
    docs = documents(spark, rows)
    since = spark._jsparkSession.sharedState().statusStore().executionsCount()
    got = exact_dedup(docs)
    kept = got.filter("kept AND group_size = 20000").collect()
    assert [r.doc_id for r in kept] == [36_000] and kept[0].keep_id == 36_000
    assert shuffled_rows(spark, since) < 2.5 * 20_000


def test_exact_dedup_is_native(spark):
    plan = exact_dedup(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_exact_dedup_empty(spark):
    assert exact_dedup(empty(spark)).count() == 0


def _rows_with_lines():
    rows = []
    for i in range(40):
        lines = [f"own line {i}", "on every site" if i % 2 == 0 else "", f"on site {i % 9}"]
        if i % 20 < 9:
            lines.append("on nine sites")
        if i % 20 < 10:
            lines.append("on ten sites")
        rows.append((i, "\n".join(lines), "en", f"site{i % 20}"))
    return rows


def test_lines_against_brute_force(spark):
    rows = _rows_with_lines()
    sites: dict[str, set] = {}
    for _, text, _, source in rows:
        for line in text.split("\n"):
            sites.setdefault(line, set()).add(source)
    gone = {line for line, on in sites.items() if line.strip(" ") and len(on) >= 10}
    assert gone == {"on ten sites", "on every site"}
    got = {r.doc_id: r for r in remove_spread_lines(documents(spark, rows), F.col("source")).collect()}
    for i, text, _, _ in rows:
        kept = [line for line in text.split("\n") if line not in gone]
        assert got[i].text == "\n".join(kept)
        assert (got[i].n_lines, got[i].n_removed) == (len(text.split("\n")), len(text.split("\n")) - len(kept))


def test_near_threshold_lines_are_counted_exactly(spark):
    """With a band so wide that every line is near the threshold, and with none, the same lines are found."""
    lines = lines_of(documents(spark, _rows_with_lines()), F.col("source"))
    assert {tuple(r) for r in spread_lines(lines, 10, band=0.9).collect()} == {tuple(r) for r in spread_lines(lines, 10).collect()}


def test_lines_of_awkward_rows(spark):
    got = remove_spread_lines(awkward(spark), F.col("source"), sites=3)
    # the copied text is on the sites a, b and null
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()) == Counter(
        (i, "" if i in (2, 3, 4) else t, len(t.split("\n")) if t is not None else 0, int(i in (2, 3, 4)))
        for i, t, _, _ in awkward_rows()
    )
    assert remove_spread_lines(empty(spark), F.col("source")).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
