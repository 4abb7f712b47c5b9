"""Rankings against brute force on small fixtures."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stockloom.operators import search, traverse


def brute_bm25(docs, queries, k):
    words = {d: re.findall(r"[^\W_]+", t.lower()) for d, t in docs.items()}
    n, mean = len(docs), sum(map(len, words.values())) / len(docs)
    df = Counter(w for ws in words.values() for w in set(ws))
    out = []
    for q, text in queries.items():
        scores = []
        for d, ws in words.items():
            tf, score = Counter(ws), 0.0
            for w in set(re.findall(r"[^\W_]+", text.lower())):
                if tf[w]:
                    idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                    score += idf * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(ws) / mean))
            if any(tf[w] for w in set(re.findall(r"[^\W_]+", text.lower()))):
                scores.append((-round(score, 6), d))
        out += [(q, d, -s, r) for r, (s, d) in enumerate(sorted(scores)[:k], start=1)]
    return out


def test_bm25_is_the_formula(spark):
    random.seed(3)
    letters = ["Ngân", "bank", "of", "FPT", "thép", "x1", "ö", "the"]
    docs = {i: " ".join(random.choices(letters, k=random.randint(0, 30))) + "." for i in range(60)}
    docs[99] = ""
    queries = {0: "the bank, of the FPT", 1: "THÉP thép", 2: "absent", 3: "!?"}
    corpus = spark.createDataFrame(list(docs.items()), "item_id int, text string").repartition(5)
    asked = spark.createDataFrame(list(queries.items()), "query_id int, text string")
    rows = search.bm25_topk(corpus, asked, "item_id", "text", 7).select("query_id", "item_id", "score", "rank").collect()
    got = sorted([tuple(r) for r in rows], key=lambda r: (r[0], r[3]))
    want = brute_bm25(docs, queries, 7)
    assert [(g[0], g[1], g[3]) for g in got] == [(w[0], w[1], w[3]) for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=2e-6)


@pytest.mark.parametrize("block", [4096, 3])
@pytest.mark.parametrize("as_text", [False, True])
def test_vectors_are_exact_with_ties_and_many_passes(spark, block, as_text):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 8)).astype(np.float32)
    vectors[100:200] = vectors[0]  # a third of all vectors are copies
    ids = [f"v{i:03d}" if as_text else i for i in range(300)]
    kind = "string" if as_text else "bigint"
    rows = [(i, [float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
    corpus = spark.createDataFrame(
        [*rows, (ids[0] * 0 if as_text else -1, [0.0] * 8), (ids[0] * 0 if as_text else -2, None)],
        f"item_id {kind}, embedding array<float>",
    ).repartition(6)
    asked = spark.createDataFrame(rows[:10], f"query_id {kind}, embedding array<float>")
    got = search.vector_topk(corpus, asked, 12, block=block).collect()
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = []
    for q in range(10):
        s = np.round(unit @ unit[q], 6)
        order = sorted(range(300), key=lambda i: (-s[i], ids[i]))[:12]
        want += [(ids[q], ids[i], r) for r, i in enumerate(order, start=1)]
    assert sorted((r.query_id, r.item_id, r.rank) for r in got) == sorted(want)


def test_no_query_vectors_no_rows(spark):
    corpus = spark.createDataFrame([(1, [1.0])], "item_id bigint, embedding array<float>")
    asked = spark.createDataFrame([], "query_id bigint, embedding array<float>")
    assert search.vector_topk(corpus, asked).count() == 0


def test_no_candidate_of_the_true_top_is_missed():
    """An item below the depth in every list cannot beat the k-th of any list."""
    for lists in (1, 2, 3):
        for k in (1, 10, 50):
            depth = search.candidate_depth(lists, k)
            assert depth >= k
            assert lists / (search.RRF_K + depth + 1) < 1 / (search.RRF_K + k)


def test_fusion_adds_reciprocal_ranks(spark):
    a = spark.createDataFrame([(0, "x", 1), (0, "y", 2)], "query_id int, item string, rank int")
    b = spark.createDataFrame([(0, "y", 1), (0, "z", 2)], "query_id int, item string, rank int")
    rows = search.fuse([a, b], "item", 2).orderBy("rank").collect()
    assert [(r.item, r.score) for r in rows] == [("y", round(1 / 62 + 1 / 61, 6)), ("x", round(1 / 61, 6))]


def brute_hops(edges, seed, hops):
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    steps, ring = {seed: 0}, {seed}
    for i in range(1, hops + 1):
        ring = {n for r in ring for n in near[r]} - set(steps)
        steps.update(dict.fromkeys(ring, i))
    return steps


@pytest.mark.parametrize("hops", [0, 1, 3])
def test_expansion_takes_the_fewest_steps(spark, hops):
    random.seed(11)
    edges = [(f"n{random.randint(0, 40)}", f"n{random.randint(0, 40)}") for _ in range(60)]
    edges += [("hub", f"n{i}") for i in range(20)]
    df = traverse.both_ways(spark.createDataFrame(edges, "subject string, object string"))
    seeds = spark.createDataFrame([("n1",), ("n1",), ("hub",), ("lonely",)], "seed string")
    got = {(r.seed, r.node): r.distance for r in traverse.khop(df, seeds, hops).collect()}
    want = {(s, n): d for s in ("n1", "hub", "lonely") for n, d in brute_hops(edges, s, hops).items()}
    assert got == want


def _ranked(scores):
    """(query, item) -> rank, score descending, then item."""
    out = {}
    for q in {q for q, _, _ in scores}:
        order = sorted((-s, i) for p, i, s in scores if p == q)
        out.update({(q, i): r for r, (_, i) in enumerate(order, start=1)})
    return out


def test_fused_ranks_are_those_of_the_whole_lists(spark):
    """Items far down one list keep their share from it: against full-list fusion, not cut ones."""
    random.seed(9)
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(12)]
    texts = [(i, " ".join(random.choices(words, k=random.randint(3, 40)))) for i in range(400)]
    vectors = [(i, [float(round(x, 1)) for x in rng.normal(size=3)]) for i in range(400)]
    vectors[50:120] = [(i, vectors[0][1]) for i in range(50, 120)]  # ties
    asked = [(q, " ".join(words[q : q + 3]), [float(x) for x in rng.normal(size=3)]) for q in range(6)]
    corpus = spark.createDataFrame(texts, "item_id bigint, text string").repartition(3)
    directions = spark.createDataFrame(vectors, "item_id bigint, embedding array<float>").repartition(3)
    queries = spark.createDataFrame(asked, "query_id bigint, text string, embedding array<float>")
    got = search.hybrid_topk(corpus, directions, queries, 3).collect()
    by_text = _ranked([tuple(r) for r in search.bm25_scores(corpus, queries, "item_id", "text").collect()])
    cosine = []
    for q, _, v in asked:
        for i, w in vectors:
            a, b = np.float32(w).astype(float), np.float32(v).astype(float)
            if a.any():
                cosine.append((q, i, round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 6)))
    by_vector = _ranked(cosine)
    want = []
    for q, _, _ in asked:
        fused = Counter()
        for ranks in (by_text, by_vector):
            for (p, i), r in ranks.items():
                if p == q:
                    fused[i] += 1 / (60 + r)
        best = sorted((-round(s, 6), i) for i, s in fused.items())[:3]
        want += [(q, i, r) for r, (_, i) in enumerate(best, start=1)]
    assert sorted((r.query_id, r.item_id, r.rank) for r in got) == sorted(want)


def test_vectors_without_a_direction_push_nothing_out(spark):
    rows = [(i, [1.0, i / 10]) for i in range(4)] + [(8, [math.nan, 1.0]), (9, [math.inf, 1.0]), (10, [3e38, 3e38])]
    corpus = spark.createDataFrame(rows, "item_id bigint, embedding array<double>").coalesce(1)
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "query_id bigint, embedding array<double>")
    got = search.vector_topk(corpus, asked, 2).orderBy("rank").collect()
    assert [r.item_id for r in got] == [0, 1]


def test_vectors_of_another_length_are_an_error(spark):
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "query_id bigint, embedding array<float>")
    corpus = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0, 3.0])], "item_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="2 numbers"):
        search.vector_topk(corpus, asked, 2).collect()
    with pytest.raises(ValueError, match="1 and 2"):
        search.vector_topk(corpus, corpus.selectExpr("item_id AS query_id", "slice(embedding, 1, 2) AS embedding"), 2)


def test_expansion_far_out(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(8)], "subject string, object string")
    reached = traverse.khop(traverse.both_ways(chain), spark.createDataFrame([("n0",)], "seed string"), 50)
    assert {r.node: r.distance for r in reached.collect()} == {f"n{i}": i for i in range(9)}


def test_fact_search_with_and_without_the_other_rankings(spark):
    facts = spark.sql(
        """SELECT * FROM VALUES
        ('u1', 'C1', 'HOLDS_STAKE_IN', 'C2', 'Alpha (C1) holds a stake in Beta (C2)', timestamp_ntz '2024-01-02 03:04:05'),
        ('u2', 'C2', 'SUBSIDIARY_OF', 'C3', 'Beta (C2) is a subsidiary of Gamma (C3)', NULL),
        ('u3', 'C9', 'LED_BY', 'Ann', 'Omega (C9) is led by Ann', NULL)
        AS t(uuid, subject, predicate, object, fact, valid_at)"""
    ).selectExpr("*", "CAST(NULL AS TIMESTAMP_NTZ) AS invalid_at")
    asked = spark.createDataFrame([("q", "who holds a stake in Beta", "C2", [1.0, 0.0])], "query_id string, text string, seed string, embedding array<float>")
    vectors = spark.createDataFrame([("C9", [1.0, 0.1]), ("C1", [0.0, 1.0])], "node string, embedding array<float>")
    text_only = search.fact_search(facts, asked).orderBy("rank").collect()
    assert [r.uuid for r in text_only] == ["u1", "u2"]
    assert text_only[0].valid_at == "2024-01-02T03:04:05" and text_only[0].invalid_at is None
    every = search.fact_search(facts, asked, traverse.both_ways(facts), vectors).orderBy("rank").collect()
    assert every[0].uuid == "u1" and {r.uuid for r in every} == {"u1", "u2", "u3"}


def _facts(spark, rows):
    kind = "uuid string, subject string, predicate string, object string, fact string"
    return spark.createDataFrame(rows, kind).selectExpr(
        "*", "timestamp_ntz '2024-01-02 03:04:05' AS valid_at", "CAST(NULL AS TIMESTAMP_NTZ) AS invalid_at"
    )


def brute_facts(facts, asked, near, vectors, k):
    """Fusion of the whole lists; what a list cannot tell apart shares a rank."""
    docs = {u: f for u, _, _, _, f in facts}
    texts = brute_bm25(docs, {q: t for q, t, _, _ in asked}, len(docs))
    out = []
    for q, _, seed, v in asked:
        scores = {u: s for p, u, s, _ in texts if p == q}
        lists = [{u: 1 + sum(o > s for o in scores.values()) for u, s in scores.items()}]
        steps = brute_hops(near, seed, 1)
        away = {u: min((steps[n] for n in (a, b) if n in steps), default=None) for u, a, _, b, _ in facts}
        away = {u: d for u, d in away.items() if d is not None}
        lists.append({u: 1 + sorted(set(away.values())).index(d) for u, d in away.items()})
        like = {n: round(float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)), 6) for n, w in vectors.items()}
        used = {a for _, a, _, _, _ in facts}
        like = {n: s for n, s in like.items() if n in used}
        lists.append({u: 1 + sum(o > like[a] for o in like.values()) for u, a, _, _, _ in facts if a in like})
        total = Counter()
        for ranks in lists:
            for u, r in ranks.items():
                total[u] += 1 / (60 + r)
        best = sorted((-round(s, 6), u) for u, s in total.items())[:k]
        out += [(q, r, u) for r, (_, u) in enumerate(best, start=1)]
    return out


@pytest.mark.parametrize("shallow", [False, True])
def test_facts_read_from_the_top_are_those_of_the_whole_lists(spark, monkeypatch, shallow):
    """Early stopping against full fusion, also where the first rounds read next to nothing."""
    if shallow:
        monkeypatch.setattr(search, "candidate_depth", lambda lists, k: 1)
        monkeypatch.setattr(search, "DEEPER", 3)
    random.seed(21)
    rng = np.random.default_rng(21)
    names = [f"n{i}" for i in range(60)]
    words = ["alpha", "beta", "gamma", "delta", "stake", "holds"]
    rows = [
        (f"u{i:03d}", random.choice(names), "R", random.choice(names), " ".join(random.choices(words, k=random.randint(1, 6))))
        for i in range(500)
    ]
    vectors = {n: [float(round(x, 1)) for x in rng.normal(size=4)] for n in names[:40]}
    for n in names[5:15]:
        vectors[n] = vectors[names[0]]  # equally alike
    asked = [(q, " ".join(random.sample(words, 2)), names[q * 7], [float(x) for x in rng.normal(size=4)]) for q in range(5)]
    asked.append((9, "no such word", "nowhere", [1.0, 0.0, 0.0, 0.0]))
    facts = _facts(spark, rows)
    queries = spark.createDataFrame(asked, "query_id bigint, text string, seed string, embedding array<double>")
    nodes = spark.createDataFrame(list(vectors.items()), "node string, embedding array<double>")
    got = search.fact_search(facts, queries, traverse.both_ways(facts), nodes, 10).collect()
    want = brute_facts(rows, asked, [(a, b) for _, a, _, b, _ in rows], vectors, 10)
    assert sorted((r.query_id, r.rank, r.uuid) for r in got) == sorted(want)
    assert {r.valid_at for r in got} == {"2024-01-02T03:04:05"}


def joined_rows(spark, since):
    """The largest number of rows any join has made in the executions numbered from `since` on."""
    store = spark._jsparkSession.sharedState().statusStore()
    runs, most = store.executionsList(), 0
    for i in range(runs.size()):
        run = runs.apply(i).executionId()
        if run < since:
            continue
        nodes, values = store.planGraph(run).allNodes(), store.executionMetrics(run)
        for j in range(nodes.size()):
            node = nodes.apply(j)
            if "Join" not in node.name():
                continue
            for m in range(node.metrics().size()):
                metric = node.metrics().apply(m)
                if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                    most = max(most, int(values.apply(metric.accumulatorId()).replace(",", "")))
    return most


def test_facts_that_tie_are_not_paired(spark, tmp_path):
    """50,000 facts with one score, next to one seed: joins make rows in proportion, not pairs."""
    n = 50_000
    rows = spark.range(n).selectExpr(
        "concat('u', id) AS uuid", "'hub' AS subject", "'R' AS predicate", "concat('n', id) AS object",
        "'hub has one' AS fact", "CAST(NULL AS TIMESTAMP_NTZ) AS valid_at", "CAST(NULL AS TIMESTAMP_NTZ) AS invalid_at",
    )
    rows.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    asked = [(q, "what has the hub", "hub", [1.0, float(q)]) for q in range(3)]
    queries = spark.createDataFrame(asked, "query_id bigint, text string, seed string, embedding array<double>")
    vectors = spark.createDataFrame([("hub", [1.0, 0.5])], "node string, embedding array<double>")
    store = spark._jsparkSession.sharedState().statusStore()
    since = store.executionsCount()
    got = search.fact_search(facts, queries, traverse.both_ways(facts, distinct=False), vectors, 10).collect()
    first = sorted(f"u{i}" for i in range(n))[:10]
    assert [(r.query_id, r.uuid) for r in sorted(got, key=lambda r: (r.query_id, r.rank))] == [(q, u) for q in range(3) for u in first]
    assert n <= joined_rows(spark, since) <= 8 * n


def test_ranks_of_ten_thousand_queries(spark):
    """More queries and bars than one pass takes; no list of candidates is collected."""
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(400, 4)).round(1)
    vectors[:, 0] += 0.05
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "item_id bigint, embedding array<double>")
    asked = rng.normal(size=(10_000, 4))
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id bigint, embedding array<double>")
    wanted = spark.range(20_000).selectExpr("id % 10000 AS query_id", "(id * 7) % 400 AS item_id")
    got = {(r.query_id, r.item_id): r.rank for r in search.vector_ranks(corpus, queries, wanted, block=4096, bars=5000).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    s = np.round(asked / np.linalg.norm(asked, axis=1, keepdims=True) @ unit.T, 6)
    for i in range(0, 20_000, 37):
        q, item = i % 10000, i * 7 % 400
        better = (s[q] > s[q, item]).sum() + (s[q, :item] == s[q, item]).sum()
        assert got[q, item] == better + 1
    assert len(got) == len({(i % 10000, i * 7 % 400) for i in range(20_000)})


@pytest.mark.parametrize("piece", [3, 1 << 16])
def test_hubs_are_many_keys(spark, tmp_path, piece):
    """A hub's neighbours are dealt out, whoever asks; hundreds of seeds go in sets."""
    random.seed(13)
    edges = [("hub", f"n{i}") for i in range(90)] + [(f"n{random.randint(0, 89)}", f"m{random.randint(0, 30)}") for _ in range(80)]
    traverse.both_ways(spark.createDataFrame(edges, "subject string, object string")).write.parquet(str(tmp_path / "edges"))
    stored = spark.read.parquet(str(tmp_path / "edges"))
    seeds = [f"n{i}" for i in range(80)] + ["hub", "m3", "lonely"]
    seeds += [f"s{i}" for i in range(100)]
    got = traverse.khop(stored, spark.createDataFrame([(x,) for x in seeds], "seed string"), 2, piece)
    have = {(r.seed, r.node): r.distance for r in got.collect()}
    assert have == {(x, n): d for x in seeds for n, d in brute_hops(edges, x, 2).items()}
    large = {r.src: r.pieces for r in traverse.hubs(stored, piece).collect()}
    assert large.get("hub") == (30 if piece == 3 else None)


def test_a_hub_is_joined_by_piece(spark, tmp_path, monkeypatch):
    """The plan of a step: the edges meet the ring by node and piece, none by the node alone."""
    from stockloom.plans import joins

    plans = []

    def planned(df, purpose):
        if purpose == "ring":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return joins.settled(df, purpose)

    monkeypatch.setattr(traverse, "settled", planned)
    spark.range(200).selectExpr("'hub' AS src", "concat('n', id) AS dst").write.parquet(str(tmp_path / "edges"))
    stored = spark.read.parquet(str(tmp_path / "edges"))
    traverse.khop(stored, spark.createDataFrame([("hub",)], "seed string"), 1, 10)
    step = plans[-1]
    assert any("Join Inner" in line and "src#" in line and "piece#" in line for line in step.splitlines())
