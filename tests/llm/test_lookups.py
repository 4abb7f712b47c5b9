import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from frames import awkward, awkward_rows, documents, empty, labels, prose

from stockloom.llm import decontamination, toxicity
from stockloom.llm.edit import best_part


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def _edited(own, edits, lucky):
    own = list(own)
    for _ in range(edits):
        place, kind = lucky.randrange(len(own)), lucky.randrange(3)
        own[place : place + (kind != 1)] = [f"edit{lucky.randrange(10**6)}"] if kind < 2 else []
    return own


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_edited_items_are_found(spark, block):
    """Items at up to a fifth of edits are found, almost all at the limit; texts without one have no hit."""
    lucky = random.Random(4)
    items = [(i, prose(15 + i, 200 + i, 3000)) for i in range(30)]
    rows, planted, limit = [], set(), set()
    for n in range(300):
        text = prose(150, 10_000 + n, 3000).split()
        if n % 2:
            item, own = items[n % 30][0], items[n % 30][1].split()
            most = int(0.2 * len(own) + 1e-9)
            edits = n // 2 % (most + 1)
            text[70:70] = _edited(own, edits, lucky)
            planted.add((n, item))
            if edits == most:
                limit.add((n, item))
        rows.append((n, " ".join(text), "en", "a"))
    got = {(r.doc_id, r.item_id): r for r in decontamination.find_items(documents(spark, rows), _items(spark, items), block=block).collect()}
    truth = set()
    for n, text, *_ in rows:
        for i, item in items:
            if best_part(item.split(), text.split())[0] <= int(0.2 * len(item.split()) + 1e-9):
                truth.add((n, i))
    assert set(got) <= truth and planted <= truth
    assert len(set(got) & planted) >= 0.97 * len(planted) and len(set(got) & limit) >= 0.9 * len(limit)


@pytest.mark.parametrize("before", [0, 60])
def test_shortened_items_alone_and_at_the_end_are_found(spark, before):
    """A document may end with an item that lacks words, and be shorter than any item."""
    lucky = random.Random(6)
    items = [(i, prose(size, 70_000 + i, 10**6)) for i, size in enumerate([5, 6, 9, 10, 15, 16, 30, 33, 50])]
    rows, planted, light = [], set(), set()
    for i, text in items:
        for copy in range(20):
            own = text.split()
            most = int(0.2 * len(own) + 1e-9)
            less = 1 + copy % most
            for _ in range(less):
                del own[lucky.randrange(len(own))]
            number = 100 * i + copy
            planted.add((number, i))
            if less <= most / 2:
                light.add((number, i))
            rows.append((number, " ".join([*prose(before, number, 10**6).split(), *own]), "en", "a"))
    got = {(r.doc_id, r.item_id) for r in decontamination.find_items(documents(spark, rows), _items(spark, items)).collect()}
    assert len(got & planted) >= 0.97 * len(planted) and light <= got <= planted


def test_items_in_awkward_rows(spark):
    texts = [t for _, t, *_ in awkward_rows()]
    items = _items(spark, [(1, texts[2].upper()), (2, None), (3, ""), (4, "!!!"), (5, "one two"), (6, " ".join(texts[11].split()[20_000:20_040])), (None, texts[0])])
    got = decontamination.find_items(awkward(spark), items).collect()
    assert Counter((r.doc_id, r.item_id, r.distance) for r in got) == Counter(
        {(2, 1, 0): 1, (3, 1, 0): 1, (4, 1, 0): 1, (10, 5, 0): 1, (9, 6, 0): 1, (1, None, 0): 2}
    )
    assert decontamination.find_items(empty(spark), items).count() == 0
    assert decontamination.find_items(awkward(spark), _items(spark, [])).count() == 0


def test_walks_fall_into_step_again():
    """The embedding of a text with one word inserted agrees with the text's own in most steps."""
    lucky = np.random.default_rng(1)
    agree = []
    for _ in range(50):
        text = lucky.integers(1, 2**62, 60).astype(np.uint64)
        other = np.insert(text, 5, np.uint64(7))
        end = np.array([60]), np.array([61])
        zero = np.array([0])
        walks = [
            decontamination.walk(t, zero, e, 90, decontamination.moves(t, 90, 1))
            for t, e in zip((text, other), end, strict=True)
        ]
        agree.append((walks[0] == walks[1]).mean())
    assert np.mean(agree) > 0.5


def _index(lucky, n=300, terms=40):
    rows = sorted((e, t, int(lucky.integers(1, 4))) for e in range(n) for t in lucky.choice(terms, lucky.integers(0, 5), replace=False))
    example, term, tf = (np.array(x) for x in zip(*rows, strict=True))
    term = term * 7 + 3
    docs_with = {int(t): int((term == t).sum()) for t in set(term.tolist())}
    toxic = lucky.integers(0, 2, n)
    return toxicity.Index(np.arange(n) * 2, toxic, (example, term, tf), docs_with, {0: 3.0, 1: 1.0}), rows, docs_with


def test_nearest_is_exact_and_skips_blocks():
    lucky = np.random.default_rng(2)
    index, rows, docs_with = _index(lucky)
    terms = np.array(sorted(docs_with))
    idf = np.log((1 + 300) / (1 + np.array([docs_with[t] for t in terms]))) + 1
    dense = np.zeros((300, len(terms)))
    for e, t, tf in rows:
        at = np.searchsorted(terms, t * 7 + 3)
        dense[e, at] = (1 + np.log(tf)) * idf[at]
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
    for _ in range(200):
        term = np.sort(lucky.choice(len(terms), lucky.integers(1, 6), replace=False))
        tf = lucky.integers(1, 4, len(term))
        q = np.zeros(len(terms))
        q[term] = (1 + np.log(tf)) * idf[term]
        cosine = np.round(dense @ (q / np.linalg.norm(q)), 9)
        best = [e for e in np.lexsort((np.arange(300), -cosine)) if cosine[e] > 0][: toxicity.NEIGHBOURS]
        found, near = index.nearest(term, tf)
        assert np.allclose(near, cosine[best], atol=2e-9)
        assert (index.ids[found] // 2).tolist() == best or np.allclose(np.diff(near), 0, atol=1e-8) or len(best) == len(found)


def test_scores_are_calibrated_and_monotone():
    index, _, _ = _index(np.random.default_rng(3))
    values, rates = index.calibrate().curve
    assert (np.diff(values) > 0).all() and (np.diff(rates) >= 0).all() and rates.min() >= 0 and rates.max() <= 1


def _toxic_rows():
    rows, known = [], []
    for i in range(400):
        toxic = i % 6 == 0
        rows.append((i, prose(40, i, 400) + (f" slurone slurtwo{i % 3}" if toxic else ""), "en", "a"))
        known.append((i, 1, int(toxic)))
    return rows, known


def test_toxic_documents_are_found(spark):
    rows, known = _toxic_rows()
    got = toxicity.toxicity(documents(spark, rows), labels(spark, known)).collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.3) == int(r.doc_id % 6 == 0)
    shown = next(r for r in got if r.predicted)
    assert shown.evidence and all(e % 6 == 0 for e in shown.evidence)


def _terms(text):
    words = re.findall("[a-z0-9]+", text)
    return Counter((n, w[:n]) for w in words for n in (0, 4, 6) if len(w) > n and n) + Counter((0, w) for w in words)


def _toxicity(rows, known):
    """Scores from the definition: vocabulary, vectors, every cosine, votes and pooled rates."""
    examples = {i: (_terms(t or ""), toxic) for (i, t, *_), (_, _, toxic) in zip(rows, known, strict=True) if zlib.crc32(str(i).encode()) % 4 != 2}
    n1 = sum(y for _, y in examples.values())
    n, n0 = len(examples), len(examples) - n1
    df, pos = Counter(), Counter()
    for terms, y in examples.values():
        df.update(set(terms))
        pos.update(set(terms) if y else ())

    def chi(t):
        return (pos[t] * n0 - (df[t] - pos[t]) * n1) ** 2 * n / (n1 * n0 * df[t] * max(n - df[t], 1))

    bar = min(toxicity.ENOUGH_CHI, max(toxicity.LEAST_CHI, n / 60))
    chosen = {t for t in df if df[t] >= 3 and pos[t] * n0 > (df[t] - pos[t]) * n1 and chi(t) >= bar}
    assert 0 < len(chosen) < toxicity.TERMS

    def vector(terms):
        v = {t: (1 + math.log(k)) * (math.log((1 + n) / (1 + df[t])) + 1) for t, k in terms.items() if t in chosen}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / length for t, x in v.items()}

    vectors = {i: vector(terms) for i, (terms, _) in examples.items()}
    prior = n1 / n

    def vote(own, but=None):
        if not own:
            return -1.0
        near = [(-round(sum(x * v.get(t, 0.0) for t, x in own.items()), 9), i) for i, v in vectors.items() if i != but]
        near = sorted(x for x in near if x[0] < 0)[: toxicity.NEIGHBOURS]
        up = -sum(c for c, i in near if examples[i][1])
        return round((up + toxicity.PRIOR * prior) / (-sum(c for c, _ in near) + toxicity.PRIOR), 9)

    votes = defaultdict(list)
    for i, (_, y) in examples.items():
        votes[vote(vectors[i], i)].append(y)
    steps = []
    for v in sorted(votes):
        steps.append([v, len(votes[v]), sum(votes[v])])
        while len(steps) > 1 and steps[-2][2] / steps[-2][1] >= steps[-1][2] / steps[-1][1]:
            _, a, b = steps.pop()
            steps[-1][1] += a
            steps[-1][2] += b
    rates = np.maximum.accumulate([(b + prior) / (a + 1) for _, a, b in steps])

    def score(text):
        v = vote(vector(_terms(text or "")))
        return rates[max(0, sum(s[0] <= v for s in steps) - 1)]

    return {i: score(t) for i, t, *_ in rows}


def test_scores_are_those_of_the_definition(spark):
    lucky = random.Random(9)
    slurs = [f"slur{c}word" for c in "abcdefgh"]
    rows, known = [], []
    for i in range(500):
        toxic = lucky.random() < 0.2
        own = lucky.choices(slurs, k=lucky.randint(0, 5) if toxic else lucky.choice((0, 0, 0, 0, 1, 2)))
        text = "" if i % 57 == 1 else None if i % 57 == 3 else f"{prose(40, i, 400)} {' '.join(own)}"
        rows.append((i, text, "en", "a"))
        known.append((i, 1, int(toxic)))
    want = _toxicity(rows, known)
    assert len(set(want.values())) > 3
    for r in toxicity.toxicity(documents(spark, rows), labels(spark, known)).collect():
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-6), r


def test_toxicity_of_awkward_rows(spark):
    rows, known = _toxic_rows()
    docs = documents(spark, [*awkward_rows(), *((i + 1000, *r) for i, *r in rows)])
    odd = [*((i + 1000, q, t) for i, q, t in known), (None, 1, 1), (2, 1, None), (1000, 1, 1), (5, 0, 1), (77_777, 1, 1)]
    got = toxicity.toxicity(docs, labels(spark, odd)).collect()
    assert Counter(r.doc_id for r in got if (r.doc_id or 0) < 1000) == Counter(i for i, *_ in awkward_rows())
    assert all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(empty(spark), labels(spark, known)).count() == 0
    assert {r.score for r in toxicity.toxicity(awkward(spark), labels(spark, [])).collect()} == {0.0}


@pytest.mark.parametrize("size", [200, 400])
def test_long_items_get_the_lookups_their_recall_needs(spark, size):
    """No cap: the longer the items, the more lookups; copies with as many substitutions as the limit allows are found."""
    lucky = random.Random(size)
    items = [(i, prose(size, 900_000 + i, 10**6)) for i in range(4)]
    index = decontamination.Index([i for i, _ in items], [t for _, t in items], 0.8, 0.99)
    assert all(c.lookups > 96 for c in index.classes)
    rows, planted = [], set()
    for n in range(60):
        item, own = items[n % 4][0], items[n % 4][1].split()
        for place in lucky.sample(range(size), size // 5):
            own[place] = f"edit{lucky.randrange(10**9)}"
        rows.append((n, " ".join([prose(40, n, 3000), *own, prose(40, 99 + n, 3000)]), "en", "a"))
        planted.add((n, item))
    got = {(r.doc_id, r.item_id) for r in decontamination.find_items(documents(spark, rows), _items(spark, items)).collect()}
    assert got <= planted and len(got) >= 59


def test_items_that_no_lookups_find_are_an_error(monkeypatch):
    monkeypatch.setattr(decontamination, "LOOKUPS", 10)
    with pytest.raises(ValueError, match="10 lookups find less than 0.99 of the items of 100 words"):
        decontamination.Index([1], [prose(100, 1, 10**6)], 0.8, 0.99)
