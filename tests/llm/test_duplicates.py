import random
from collections import Counter, defaultdict

import pytest
from frames import awkward, awkward_rows, documents, empty, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockloom.llm import components as trees
from stockloom.llm import near_dedup, substring_dedup
from stockloom.llm.components import components
from stockloom.llm.edit import best_part, within


def _rows_of_distances(a, b, start):
    row = list(range(len(b) + 1)) if start else [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row


words = st.lists(st.integers(0, 3), max_size=20)


@settings(max_examples=400, deadline=None)
@given(words, words, st.integers(0, 12))
def test_edit_distance(a, b, limit):
    distance = _rows_of_distances(a, b, True)[-1]
    assert within(a, b, limit) == (distance if distance <= limit else None)
    if a:
        row = _rows_of_distances(a, b, False)
        assert best_part(a, b) == (min(row), row.index(min(row)))


def _removed(rows, width):
    """By the definition: words covered by a window that starts in a smaller document too."""
    least = {}
    for i, text, *_ in rows:
        own = (text or "").split()
        for k in range(len(own) - width + 1):
            if i is not None:
                w = tuple(own[k : k + width])
                least[w] = min(least.get(w, i), i)
    out = []
    for i, text, *_ in rows:
        own = (text or "").split()
        gone = set()
        for k in range(len(own) - width + 1):
            if i is not None and least[tuple(own[k : k + width])] < i:
                gone.update(range(k, k + width))
        out.append((i, len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone)))
    return Counter(out)


@pytest.mark.parametrize("chunk,max_bits", [(1 << 22, 30), (200, 3)])
def test_repeats_against_brute_force(spark, chunk, max_bits):
    """Also with a sketch of eight cells, where it lets everything through, and chunks of one text each."""
    lucky = random.Random(5)
    passage = prose(30, 77)
    rows = awkward_rows()[:11]
    for i in range(20, 60):
        parts = [prose(lucky.randrange(30), i)]
        if i % 3 == 0:
            parts += [passage, prose(5, i + 1000)]
        if i % 5 == 0:
            parts.append(passage.replace(" ", "\n", 4))
        rows.append((i, "  ".join(parts), "en", "a"))
    got = substring_dedup.remove_repeats(documents(spark, rows), chunk=chunk, max_bits=max_bits)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()) == _removed(rows, 13)


def test_repeats_of_nothing(spark):
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0
    short = documents(spark, [(1, None, None, None), (2, "a b", "en", "a"), (3, "a b", "en", "a")])
    assert {(r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(short).collect()} == {(0, 0), (2, 0)}


def test_components_against_union_find(spark):
    lucky = random.Random(3)
    links = [(lucky.randrange(300), lucky.randrange(300)) for _ in range(150)]
    links += [(1000 + i, 1001 + i) for i in range(40)]  # a chain
    links += [(2000, 2001 + i) for i in range(200)]  # a hub
    links = [(a, b) for a, b in links if a != b]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for x in up}


def _edited(text, edits, seed):
    lucky, own = random.Random(seed), text.split()
    for _ in range(edits):
        place, kind = lucky.randrange(len(own)), lucky.randrange(3)
        own[place : place + (kind != 1)] = [f"edit{lucky.randrange(10**6)}"] if kind < 2 else []
    return " ".join(own)


def _classes(rows):
    texts = sorted({t or "" for _, t, *_ in rows})
    up = {t: t for t in texts}

    def top(t):
        while up[t] != t:
            t = up[t]
        return t

    split = {t: t.lower().split() for t in texts}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if split[a] and split[b] and within(split[a], split[b], int(0.2 * max(len(split[a]), len(split[b])) + 1e-9)) is not None:
                a1, b1 = sorted((top(a), top(b)))
                up[b1] = a1
    return {t: top(t) for t in texts}


def test_near_duplicates_against_brute_force(spark):
    rows = awkward_rows()
    base = {k: prose(60 + 40 * k, 100 + k, 2000) for k in range(12)}
    shared = prose(25, 999)
    number = 100
    for k, text in base.items():
        for copy in range(k % 5):
            rows.append((number, _edited(text, 1 + copy * (1 + k // 4), number), "en", "a"))
            number += 1
        rows.append((number, text, "en", "b"))
        rows.append((number + 1, f"{prose(60, number + 5000)} {shared} {prose(60, number + 6000)}", "en", "b"))
        number += 2
    top = _classes(rows)
    got = near_dedup.near_duplicates(documents(spark, rows)).collect()
    members = defaultdict(list)
    for i, t, *_ in rows:
        members[top[t or ""]].append(i)
    expected = Counter()
    for i, t, *_ in rows:
        own = members[top[t or ""]]
        expected[i, min((x for x in own if x is not None), default=None), len(own)] += 1
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == expected
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


def test_a_large_group_of_near_copies_is_not_compared_all_to_all(spark, monkeypatch):
    text = prose(80, 1, 4000)
    rows = [(i, _edited(text, 2, i), "en", "a") for i in range(400)] + [(i, prose(80, i, 4000), "en", "a") for i in range(1000, 1400)]
    seen = []
    linked = near_dedup.linked

    def counted(pairs, words, similarity):
        seen.append(pairs.count())
        return linked(pairs, words, similarity)

    monkeypatch.setattr(near_dedup, "linked", counted)
    got = near_dedup.near_duplicates(documents(spark, rows)).collect()
    assert {r.class_size for r in got if r.doc_id < 400} == {400} and {r.class_size for r in got if r.doc_id >= 1000} == {1}
    assert sum(seen) < 40 * 400


def test_members_that_miss_the_first_pivot_become_pivots(spark):
    """a ~ b ~ c in one chain: a and c are too far apart to be linked directly."""
    text = prose(100, 8, 5000)
    middle = _edited(text, 14, 1)
    rows = [(1, text, "en", "a"), (2, middle, "en", "a"), (3, _edited(middle, 14, 2), "en", "a")]
    top = _classes(rows)
    got = near_dedup.near_duplicates(documents(spark, rows), sample=1).collect()
    assert len({top[t] for _, t, *_ in rows}) == len({r.class_id for r in got}) == 1


@pytest.mark.parametrize("size,share", [(5, 0.2), (9, 0.12), (12, 0.17), (30, 0.2), (36, 0.2), (100, 0.1), (100, 0.15), (100, 0.2), (400, 0.2)])
def test_copies_edited_evenly_up_to_the_limit_are_found(spark, size, share):
    """Substituted words at even distances break most runs of words that the two texts have in common."""
    rows = []
    for n in range(60):
        own = prose(size, 50_000 + 100 * size + n, 10**6).split()
        copy = list(own)
        edits = int(share * size + 1e-9)
        for e in range(edits):
            copy[(2 * e + 1) * size // (2 * edits)] = f"edit{n}x{e}"
        rows += [(2 * n, " ".join(own), "en", "a"), (2 * n + 1, " ".join(copy), "en", "a")]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(documents(spark, rows)).collect()}
    assert all(got[2 * n] == 2 * n for n in range(60))
    assert sum(got[2 * n + 1] == 2 * n for n in range(60)) >= 59


def test_texts_at_the_border_of_short_and_long_share_tuples(spark):
    rows = []
    for n in range(60):
        own = prose(40, 90_000 + n, 10**6).split()
        copy = [w for k, w in enumerate(own) if k % 5 != 2]
        rows += [(2 * n, " ".join(own), "en", "a"), (2 * n + 1, " ".join(copy[: 32 + n % 2]), "en", "a")]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(documents(spark, rows)).collect()}
    assert sum(got[2 * n + 1] == 2 * n for n in range(60)) >= 59


def test_texts_that_share_a_passage_meet_by_their_rare_words(spark, monkeypatch):
    """Buckets crowded by a common passage: copies are found all the same, and few of the other pairs are read."""
    passage = prose(24, 1, 3000)
    rows = [(i, f"{passage} {prose(10, 100 + i, 3000)}", "en", "a") for i in range(150)]
    rows += [(1000 + i, _edited(rows[i][1], 3, i), "en", "a") for i in range(0, 150, 5)]
    crowds, seen = [], []
    rarest, linked = near_dedup._rarest, near_dedup.linked

    def crowded(crowd, words, similarity):
        crowds.append(crowd.count())
        return rarest(crowd, words, similarity)

    def counted(pairs, words, similarity):
        seen.append(pairs.count())
        return linked(pairs, words, similarity)

    monkeypatch.setattr(near_dedup, "_rarest", crowded)
    monkeypatch.setattr(near_dedup, "linked", counted)
    got = near_dedup.near_duplicates(documents(spark, rows)).collect()
    top, members = _classes(rows), defaultdict(list)
    for i, t, *_ in rows:
        members[top[t]].append(i)
    assert {r.doc_id: r.class_id for r in got} == {i: min(members[top[t]]) for i, t, *_ in rows}
    assert len(crowds) == 1 and crowds[0] > 100 and sum(seen) < 10 * len(rows)


def test_any_two_texts_within_the_limit_have_a_rare_word_in_common(spark):
    rows = [(i, prose(10 + 7 * (i % 9), i // 2, 40), "en", "a") for i in range(80)]
    rows += [(100 + i, _edited(t, len(t.split()) // 5, i), "en", "a") for i, t, *_ in rows]
    texts = near_dedup.sketches(documents(spark, rows), 0.8, 6, 0.999).dropDuplicates(["node"])
    mass = F.aggregate("bag", F.lit(0), lambda total, x: total + x.cast("int"))
    crowd = texts.select("node", "n", F.col("node").alias("label"), "bag", mass.alias("mass"))
    words = near_dedup._words_of(documents(spark, rows), texts.select("node"))
    held = defaultdict(set)
    for r in near_dedup._rarest(crowd, words, 0.8).collect():
        held[r.node].add(r.h)
    split = {near_dedup._key(t): t.lower().split() for _, t, *_ in rows}
    near = 0
    for a in split:
        for b in split:
            if a < b and within(split[a], split[b], int(0.2 * max(len(split[a]), len(split[b])) + 1e-9)) is not None:
                near += 1
                assert held[a] & held[b]
    assert near >= 80 and all(len(held[x]) <= len(w) // 5 + 1 for x, w in split.items())


def test_tuples_that_nobody_shares_are_not_shuffled(spark):
    rows = [(i, prose(30 + i % 60, i, 5000), "en", "a") for i in range(300)]
    rows += [(1000 + i, _edited(rows[i][1], 3, i), "en", "a") for i in range(20)]
    found = near_dedup.sketches(documents(spark, rows), 0.8, 6, 0.999).cache()
    (_, border, _, short, _), _ = near_dedup._kinds(0.8, 6, 0.999)
    every = defaultdict(set)
    for r in found.collect():
        for at, (h, place) in enumerate(zip(r["keys"], r["places"], strict=True)):
            again = near_dedup.LONG <= r.n <= border and at >= short
            every[h].add((r.node, r.n, place, at - short * again))
    shared = {(h, *x) for h, own in every.items() if len({x[0] for x in own}) > 1 for x in own}
    got = {(r.h, r.node, r.n, r.place, r.table) for r in near_dedup._entries(found, short, border).collect()}
    assert shared and shared <= got <= {(h, *x) for h, own in every.items() for x in own}
    assert len(got) < len(shared) + 0.1 * sum(map(len, every.values()))


def test_components_read_a_link_again_only_while_it_joins_two_trees(spark, monkeypatch):
    lucky, wrote = random.Random(5), []
    keep = trees.settled

    def counted(df, purpose):
        out = keep(df, purpose)
        wrote.append(out.count())
        return out

    monkeypatch.setattr(trees, "settled", counted)
    names = lucky.sample(range(-(10**6), 10**6), 1200)
    star = [(names[0], x) for x in names[1:600]]
    chain = list(zip(names[600:900], names[601:900], strict=False))
    some = [tuple(lucky.sample(names[900:], 2)) for _ in range(200)]
    links = star + chain + some
    up = {x: x for link in links for x in link}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        up[high] = low
    frame = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.label for r in components(frame).collect()} == {x: top(x) for x in up}
    wrote.clear()
    components(spark.createDataFrame([(0, x) for x in range(1, 2000)], "a long, b long"))
    assert sum(wrote) < 4 * 2000
