import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from frames import awkward, awkward_rows, documents, empty, prose

from stockloom.llm import lexical_search


def brute(rows, items, k):
    lower = str.maketrans(lexical_search.UPPER, lexical_search.UPPER.lower())
    words = lambda t: re.findall(lexical_search.WORD, (t or "").translate(lower))
    docs = [(d, Counter(words(t))) for d, t, *_ in rows]
    n, total = sum(1 for _, c in docs if c), sum(sum(c.values()) for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for d, c in docs:
            m = 50 + (50 * sum(c.values()) * n) // max(total, 1)
            score = 0
            for w in set(words(text)) & set(c):
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                score += weight * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k], start=1)]
    return out


def same(df, want):
    got = [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def corpus():
    lucky = random.Random(3)
    rows = [(i, prose(lucky.randrange(120), i, 60), "en", "a") for i in range(260)]
    rows += [(1000 + i, prose(40, 5, 60), "en", "a") for i in range(150)]  # equal scores
    rows += [(None, prose(40, 5, 60), "en", "a")] * 3 + [(2000, prose(40, 5, 60), "en", "a")] * 3
    lucky.shuffle(rows)
    return [*rows, *awkward_rows()]


ITEMS = [
    (1, prose(30, 5, 60)),
    (2, "ONE two! 日本語 É é"),
    (3, "nothing that is known"),
    (4, None),
    (5, ""),
    (6, "w1x1 w1x1 W1X1 w2x2"),
    (6, "w1x1 w1x1 W1X1 w2x2"),  # repeated row
    (7, "w3x3"),
    (None, prose(20, 9, 60)),
]


@pytest.mark.parametrize(("k", "block", "segment", "leaf"), [(50, 1 << 20, 4096, 48), (7, 1 << 20, 16, 2), (50, 30, 64, 0)])
def test_rankings_are_the_formula(spark, monkeypatch, k, block, segment, leaf):
    search = lexical_search.Segment.search
    monkeypatch.setattr(lexical_search.Segment, "search", lambda self, a, b, c: search(self, a, b, c, leaf))
    rows = corpus()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, rows).repartition(5)
    same(lexical_search.search(docs, items, k, block, segment), brute(rows, ITEMS, k))


def test_awkward_and_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    same(lexical_search.search(awkward(spark), items), brute(awkward_rows(), ITEMS, 50))
    assert lexical_search.search(empty(spark), items).collect() == []
    assert lexical_search.search(awkward(spark), items.limit(0)).collect() == []


def test_common_words_weigh_nothing(spark):
    """A word in every document has weight 0: no score, no rank."""
    rows = [(i, "all " + ("some" if i % 2 else ""), "en", "a") for i in range(2000)]
    items = [(1, "all"), (2, "some all")]
    got = lexical_search.search(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    same(got, brute(rows, items, 50))
    assert {r.item_id for r in got.collect()} == {2}


def segment_of(lists, docs):
    terms = np.arange(len(lists), dtype=np.int32)
    starts = np.cumsum([0, *(len(p) for p in lists)]).astype(np.int32)
    places = np.concatenate([sorted(p) for p in lists]).astype(np.int32)
    tf = np.concatenate([[p[d] for d in sorted(p)] for p in lists]).astype(np.int32)
    lengths = np.full(docs, 100)
    return lexical_search.Segment(terms, starts, places, tf, np.arange(docs), np.zeros(docs, bool), lengths, docs, 100 * docs)


def test_sparse_tables_name_maxima():
    lucky = random.Random(1)
    lists = [{d: lucky.randrange(1, 40) for d in lucky.sample(range(300), n)} for n in (1, 2, 3, 17, 64, 300)]
    own = segment_of(lists, 300)
    for t in range(len(lists)):
        a, b = own.starts[t], own.starts[t + 1]
        for _ in range(50):
            i = lucky.randrange(a, b)
            j = lucky.randrange(i + 1, b + 1)
            at = own.maxima(np.array([i]), np.array([j]))[0]
            assert i <= at < j and own.impact[at] == own.impact[i:j].max()


def test_bounds_keep_most_intervals_shut():
    """Where few documents stand out, few are opened, and the best are the same."""
    lucky = random.Random(2)
    lists = [{d: 1 for d in lucky.sample(range(4096), 1500)} for _ in range(12)]
    for stands_out in range(60):
        for p in lists:
            p[stands_out * 64] = 30
    own, found = segment_of(lists, 4096), lexical_search.Best(50)
    weight = np.full(12, 900)
    opened, scored = own.search(np.arange(12), weight, found)
    scores = np.zeros(4096, np.int64)
    for t in range(12):
        a, b = own.starts[t], own.starts[t + 1]
        scores[own.place[a:b]] += 900 * own.impact[a:b]
    best = np.lexsort((np.arange(4096), -scores))[:50]
    assert list(found.ids) == list(best) and list(found.score) == list(scores[best])
    assert scored < 300 and opened < 300


def test_words_are_told_apart_beyond_their_hash():
    vocabulary = lexical_search.Vocabulary(["abc", "abcdefghij", "é", "日本語", "0"])
    import pyarrow as pa

    from stockloom.llm.arrow_text import text_bytes

    data, offsets = text_bytes(pa.array(["abcdefghij", "abc", "abd", "0", "日本語", "é", "abcdefghik", ""]))
    assert list(vocabulary.numbers(data, offsets[:-1], offsets[1:])) == [1, 0, -1, 4, 3, 2, -1, -1]
    vocabulary.hashes = np.full_like(vocabulary.hashes, vocabulary.hashes[0])  # all alike: length and first bytes tell
    assert -1 not in vocabulary.numbers(data[:0], offsets[:0], offsets[:0])
