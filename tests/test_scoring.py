"""Word scores are worked out where the texts are read: what they may shuffle, write and join."""

import pytest
from test_search import joined_rows

from stockloom.operators import search, text_index
from stockloom.plans import joins

N, ASKED = 2000, 30


@pytest.fixture
def corpus(spark, tmp_path):
    rows = spark.range(N).selectExpr("id AS item_id", "concat_ws(' ', 'all', 'same', repeat('x ', cast(id % 7 AS int)), id) AS text")
    rows.write.parquet(str(tmp_path / "corpus"))
    return spark.read.parquet(str(tmp_path / "corpus"))


@pytest.fixture
def queries(spark):
    rows = [(q, f"all the same x {q}", [1.0, float(q)]) for q in range(ASKED)]
    return spark.createDataFrame(rows, "query_id bigint, text string, embedding array<double>")


def largest_written(monkeypatch):
    """The rows of the largest table that the searches write, as they write them."""
    sizes = [0]

    def counted(df, purpose):
        table = joins.settled(df, purpose)
        sizes.append(table.count())
        return table

    monkeypatch.setattr(search, "settled", counted)
    return sizes


def test_items_are_not_shuffled(corpus, queries):
    found = search.bm25_topk(corpus, queries, "item_id", "text", 3)
    assert "hashpartitioning(item_id" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 3 * ASKED


def test_hybrid_ranks_are_counted_not_written(spark, corpus, queries, monkeypatch):
    vectors = spark.range(N).selectExpr("id AS item_id", "array(1D, id + 0D) AS embedding")
    sizes = largest_written(monkeypatch)
    assert search.hybrid_topk(corpus, vectors, queries, 3).count() == 3 * ASKED
    assert max(sizes) < N * ASKED / 4


def test_facts_are_counted_per_score(spark, tmp_path, queries, monkeypatch):
    spark.range(N).selectExpr(
        "concat('u', id) AS uuid", "concat('n', id) AS subject", "'R' AS predicate", "'all' AS object",
        "concat('all the same ', repeat('y ', cast(id % 200 AS int))) AS fact", "CAST(NULL AS TIMESTAMP_NTZ) AS valid_at", "CAST(NULL AS TIMESTAMP_NTZ) AS invalid_at",
    ).write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    sizes = largest_written(monkeypatch)
    assert search.fact_search(facts, queries, k=2).count() == 2 * ASKED
    assert max(sizes) < N * ASKED / 2


def test_a_stored_item_is_scored_once_for_all_queries(spark, corpus, queries, tmp_path):
    root = str(tmp_path / "index")
    text_index.append_texts(corpus, root)
    since = spark._jsparkSession.sharedState().statusStore().executionsCount()
    assert text_index.bm25_stored(queries, root, k=3).count() == 3 * ASKED
    assert joined_rows(spark, since) < N * ASKED / 4
