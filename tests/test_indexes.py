"""The stored text and vector indexes against the rankings that read everything."""

import random

import numpy as np
import pytest

from stockloom.operators import search, text_index, vector_index


def zipf_texts(n, seed=1):
    """Texts of common words and a few rare ones each."""
    lucky = random.Random(seed)
    common = [f"c{i}" for i in range(30)]
    return [
        (i, " ".join([*lucky.choices(common, k=lucky.randint(1, 40)), *(f"r{lucky.randrange(n // 15)}" for _ in range(lucky.randint(0, 4)))]))
        for i in range(n)
    ]


def ranked(df):
    return sorted((r.query_id, r.rank, r.item_id, r.score) for r in df.collect())


def test_stored_ranking_is_the_ranking_and_opens_little(spark, tmp_path):
    root, n, k = str(tmp_path), 1500, 5
    texts = zipf_texts(n)
    texts += [(n + i, texts[3][1]) for i in range(200)]  # equal scores
    texts += [(9000, ""), (9001, None), (9002, "!!")]
    lucky = random.Random(5)
    asked = [(q, " ".join([*(f"c{lucky.randrange(30)}" for _ in range(4)), f"r{lucky.randrange(n // 15)}", f"r{lucky.randrange(n // 15)}"])) for q in range(12)]
    asked += [(50, texts[3][1]), (51, "unknown"), (52, ""), (53, "c1 c2 c3")]
    queries = spark.createDataFrame(asked, "query_id bigint, text string")
    corpus = spark.createDataFrame(texts, "item_id bigint, text string")
    for load in (corpus.filter("item_id % 3 = 0"), corpus.filter("item_id % 3 = 1"), corpus.filter("item_id % 3 = 2")):
        text_index.append_texts(load, root)
    want = ranked(search.bm25_topk(corpus, queries, "item_id", "text", k))
    got = ranked(text_index.bm25_stored(queries, root, k=k))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=2e-6)
    rare = queries.filter("query_id < 50")
    matching = search.bm25_scores(corpus, rare, "item_id", "text").count()
    assert text_index.Search(rare, root).candidates(k).count() < matching / 4


def test_an_item_is_indexed_once_and_a_marked_load_too(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([(1, "one two"), (2, "two")], "item_id bigint, text string")
    text_index.append_texts(rows, root, mark="first")
    text_index.append_texts(rows, root, mark="first")
    with pytest.raises(ValueError, match="indexed already"):
        text_index.append_texts(rows.limit(1), root)
    with pytest.raises(ValueError, match="indexed already"):
        text_index.append_texts(spark.createDataFrame([(7, "a"), (7, "b")], "item_id bigint, text string"), str(tmp_path / "other"))
    text_index.append_texts(rows.limit(0), root)
    asked = spark.createDataFrame([("q", "two")], "query_id string, text string")
    assert [(r.item_id, r.rank) for r in text_index.bm25_stored(asked, root).orderBy("rank").collect()] == [(2, 1), (1, 2)]
    assert text_index.bm25_stored(asked.limit(0), root).collect() == []


def test_a_word_of_every_text_is_many_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_index, "BLOCK", 16)
    rows = spark.range(1000).selectExpr("id AS item_id", "'all the same' AS text")
    text_index.append_texts(rows, str(tmp_path))
    from stockloom.sources.store import read_tables

    blocks = read_tables(spark, str(tmp_path), "text_blocks")[0]
    assert blocks.selectExpr("max(size(items))").first()[0] < 60 and blocks.count() > 3 * 40


def grouped_vectors(n, groups, seed=3, spread=0.1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, 16))
    return [(i, [float(x) for x in centres[i % groups] + spread * rng.normal(size=16)]) for i in range(n)]


@pytest.mark.parametrize("piece", [8192, 50])
def test_inverted_file_is_exact_and_reads_a_part(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(vector_index, "PIECE", piece)
    rows = grouped_vectors(2000, 40)
    rows += [(3000 + i, rows[7][1]) for i in range(600)]  # copies: equal similarities, and a full cell
    rows += [(4000, None), (4001, [0.0] * 16)]
    vectors = spark.createDataFrame(rows, "item_id bigint, embedding array<float>")
    queries = spark.createDataFrame([(q, rows[q * 11][1]) for q in range(30)], "query_id bigint, embedding array<float>")
    vector_index.build(vectors, str(tmp_path), cells=40)
    read = []
    got = ranked(vector_index.search(queries, str(tmp_path), 10, read=read))
    assert got == ranked(search.vector_topk(vectors, queries, 10))
    assert sum(read) < 0.4 * 30 * 2600


def test_a_share_of_the_vectors_finds_most(spark, tmp_path):
    rows = grouped_vectors(3000, 60, spread=0.35)
    vectors = spark.createDataFrame(rows, "item_id bigint, embedding array<float>")
    queries = spark.createDataFrame([(q, rows[q * 13][1]) for q in range(40)], "query_id bigint, embedding array<float>")
    vector_index.build(vectors, str(tmp_path), cells=60)
    read = []
    got = vector_index.search(queries, str(tmp_path), 10, share=0.2, read=read)
    assert vector_index.recall(got, search.vector_topk(vectors, queries, 10)) >= 0.95
    assert sum(read) <= 0.3 * 40 * 3000  # whole cells


def test_empty_index_and_no_queries(spark, tmp_path):
    none = spark.createDataFrame([], "item_id bigint, embedding array<float>")
    vector_index.build(none, str(tmp_path))
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<float>")
    assert vector_index.search(asked, str(tmp_path)).collect() == []
    some = spark.createDataFrame([(1, [1.0, 0.5]), (2, [0.0, 1.0])], "item_id bigint, embedding array<float>")
    vector_index.build(some, str(tmp_path))
    assert [(r.item_id, r.rank) for r in vector_index.search(asked, str(tmp_path)).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert vector_index.search(asked.limit(0), str(tmp_path)).collect() == []
