import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from frames import awkward, awkward_rows, documents, empty, labels, prose

from stockloom.llm import manifest, quality_rules

# --- manifest ---------------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    values = [doc_id, source, lang, n_chars, text]
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fan):
    """(root, the siblings of every node level by level as (left, right))."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, over = [], []
        for i in range(0, len(nodes), fan):
            run = nodes[i : i + fan]
            for slot in range(len(run)):
                for leaf in under[i + slot]:
                    paths[leaf].append((run[:slot], run[slot + 1 :]))
            above.append(H(*run))
            over.append([leaf for u in under[i : i + fan] for leaf in u])
        nodes, under = above, over
    return nodes[0], paths


def brute_manifest(rows, fan):
    trees = defaultdict(list)
    for doc_id, text, lang, source in rows:
        lowered = text
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
            lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        n = len(text or "")
        own = leaf_of(doc_id, text, lang, source, n)
        trees[lang].append((doc_id is not None, doc_id or 0, own, leaf_of(doc_id, lowered, lang, source, n), doc_id))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda r: r[:3])
        built[lang] = climb([r[2] for r in trees[lang]], fan)
    root, tops = climb([built[lang][0] for lang in order], fan)
    out = []
    for lang, top in zip(order, tops, strict=True):
        for r, path in zip(trees[lang], built[lang][1], strict=True):
            fold = r[3]
            for left, right in [*path, *top]:
                fold = H(*left, fold, *right)
            proof = H(*(h for left, right in [*path, *top] for h in [*left, *right]))
            out.append((r[4], r[2], built[lang][0], root, proof, fold, fold == root))
    return out


def same(got, want):
    key = lambda r: tuple(map(repr, r))
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("fan", [2, 8])
def test_manifest_is_the_tree(spark, fan):
    rows = awkward_rows()
    rows += [(100 + i, f"Text {i} ABC" if i % 3 else None, "en", "a") for i in range(150)]
    rows += [(7_000, "Same ROW", "it", "z")] * 70  # a third of all rows, equal in all columns
    rows += [(None, f"No id {i}", "sv", None) for i in range(9)]
    rows += [(5_000 + i, "One per Language", f"l{i}", "a") for i in range(20)]
    rows += [(6_000, "empty language", "", "a")]
    want = brute_manifest(rows, fan)
    same(manifest.verified(documents(spark, rows), fan).collect(), want)
    assert {r[6] for r in want} == {True, False}


def test_manifest_of_one_row_and_of_none(spark):
    row = (3, "Only", None, "a")
    same(manifest.verified(documents(spark, [row])).collect(), brute_manifest([row], 8))
    none = manifest.verified(empty(spark))
    assert none.collect() == []
    assert none.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_every_changed_field_breaks_the_root(spark):
    """A change of any field, also from null to empty, is found; an unchanged row never is."""
    from pyspark.sql import functions as F

    docs = documents(spark, awkward_rows())
    for field, other in (("source", ""), ("lang", ""), ("text", ""), ("n_chars", 10**6), ("doc_id", 10**6)):
        rows = manifest.manifest(docs, {field: F.coalesce(F.lit(other), F.col(field))})
        rows = rows.withColumn("found", manifest.folded(F.col("other"), F.col("up")) != F.col("root"))
        assert rows.filter((F.col("other") != F.col("leaf")) != F.col("found")).count() == 0
        assert rows.filter("found").count() > 0


# --- quality rules ----------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    found = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {j for i in range(len(ws) - 2) if found[tuple(ws[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)


def odd_texts():
    lucky = random.Random(8)
    parts = ["a", "b", "ab", "é", "日本", "##", "a|b", "\n", "\n\n", " ", "\r\n", "\x0b", "\x1c", " ", "Z9", "😀"]
    made = ["".join(lucky.choice(parts) + lucky.choice(["", " "]) for _ in range(lucky.randrange(60))) for _ in range(300)]
    return [*made, "", None, "\n", "a\n", "\na", "a b c a b c", "x\nx\n x\nx", "x x x x", "a\n\n\na\n"]


def junk(seed):
    lucky = random.Random(seed)
    return " ".join(f"{w}{lucky.choice('#$%&*')*3}" for w in prose(80, seed).split())


def test_counts_are_exact(spark):
    rows = [(i, t, "en", "a") for i, t in enumerate(odd_texts())]
    rows += [(1000 + i, t, lang, s) for i, (_, t, lang, s) in enumerate(awkward_rows())]
    judged = quality_rules.judge(documents(spark, rows).repartition(3), labels(spark, [])).collect()
    got = {r.doc_id: r for r in judged}
    assert len(judged) == len(rows)
    for doc_id, text, *_ in rows:
        want = brute_counts(text)
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed)  # no label, no verdict beyond the base rules


def test_long_and_short_chunks_agree():
    texts = odd_texts()
    import pyarrow as pa

    whole = quality_rules._measured(pa.array(texts))
    for i, t in enumerate(texts):
        counts, features = quality_rules._measured(pa.array([t]))
        assert (counts[0] == whole[0][i]).all() and (features[0] == whole[1][i]).all()


def test_rules_learn_and_every_row_is_judged(spark):
    rows = [(i, prose(80, i), "en", "a") if i % 3 else (i, junk(i), "en", "a") for i in range(300)]
    known = [(i, int(i % 3 > 0), 0) for i in range(300) if zlib.crc32(str(i).encode()) % 4 != 2]
    out = quality_rules.judge(documents(spark, [*rows, *awkward_rows()]), labels(spark, [*known, (None, 1, 0), (5, None, 0)]))
    got = out.collect()
    assert len(got) == 300 + len(awkward_rows())
    right = [r.kept == bool(r.doc_id % 3) for r in got if r.n_words == 80 and r.doc_id is not None and r.doc_id > 12]
    assert sum(right) >= 0.97 * len(right)
    assert quality_rules.judge(empty(spark), labels(spark, known)).collect() == []


def test_verdicts_hold_out(spark):
    """On labels never learned from, at the largest of the test tables."""
    folder = "/root/testdata/sf0.1"
    from pyspark.sql import functions as F

    from stockloom.llm.language import held_out

    known = spark.read.parquet(f"{folder}/labels.parquet").filter(held_out(F.col("doc_id")))
    out = quality_rules.judge(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    count = {(r.quality, r.kept): r["count"] for r in out.filter("not base_failed").join(known, "doc_id").groupBy("quality", "kept").count().collect()}
    assert count[1, True] >= 0.99 * (count[1, True] + count.get((1, False), 0))
    assert count[0, False] >= 0.95 * (count[0, False] + count.get((0, True), 0))


@pytest.mark.parametrize("way", [1, -1])
def test_no_tree_goes_against_a_constraint(way):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 3))
    y = ((np.sin(3 * x[:, 0]) + x[:, 1] + rng.normal(size=2000)) > 0).astype(float)
    trees = quality_rules.grow(x, y, np.ones(2000), trees=40, monotone={0: way})
    rows = np.repeat(rng.normal(size=(50, 3)), 200, axis=0)
    rows[:, 0] = np.tile(np.linspace(-3, 3, 200), 50)
    steps = way * np.diff(trees.score(rows).reshape(50, 200), axis=1)
    assert (steps >= -1e-12).all() and steps.max() > 0
    free = quality_rules.grow(x, y, np.ones(2000), trees=40)
    steps = way * np.diff(free.score(rows).reshape(50, 200), axis=1)
    assert (steps < -1e-6).any()


def test_flat_trees_are_the_trees():
    """Node arrays walked together give what walking each tree by itself gives."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    trees = quality_rules.grow(x, y, np.full(500, 2.0), trees=25)

    def walked(row):
        total = trees.start
        for at in trees.roots:
            while trees.left[at] != at:
                at = trees.left[at] if row[trees.feature[at]] <= trees.limit[at] else trees.right[at]
            total += trees.value[at]
        return 1 / (1 + np.exp(-total))

    assert trees.score(x) == pytest.approx([walked(r) for r in x], abs=1e-12)
    assert ((trees.score(x) > 0.5) == (y > 0.5)).mean() > 0.95
    for only in (0.0, 1.0):
        assert quality_rules.grow(x, np.full(500, only), np.ones(500)).score(x) == pytest.approx(only, abs=1e-9)
