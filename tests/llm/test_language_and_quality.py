import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from frames import awkward, awkward_rows, documents, empty, labels, prose, stored

from stockloom.llm import language, quality


def _tree(texts):
    """Counts of each byte after each context of 0 to 3 bytes."""
    tree = defaultdict(Counter)
    for text in texts:
        data = b"\n\n\n" + text.encode()
        for i in range(3, len(data)):
            for k in range(4):
                tree[data[i - k : i]][data[i]] += 1
    return tree


def _ppm_bits(tree, text):
    data, bits = b"\n\n\n" + text.encode(), 0.0
    for i in range(3, len(data)):
        for k in (3, 2, 1, 0, None):
            if k is None:
                bits += 8
                break
            seen = tree.get(data[i - k : i])
            if not seen:
                continue
            n, q = sum(seen.values()), len(seen)
            if seen[data[i]]:
                bits -= math.log2(seen[data[i]] / (n + q))
                break
            bits -= math.log2(q / (n + q))
    return bits


TRAINED = [
    ("en", "the cat sat on the mat and the dog ran"),
    ("en", "a man with the hat is in the house"),
    ("de", "der hund und die katze sind im haus"),
    ("de", "ein mann mit hut geht über die straße"),
]


def test_code_lengths_are_those_of_the_trees(spark):
    rows = [(i, text, lang, "a") for i, (lang, text) in enumerate(TRAINED)]
    model = language.train(documents(spark, rows))
    trees = {lang: _tree(t for lg, t in TRAINED if lg == lang) for lang in ("de", "en")}
    asked = ["the house", "die straße über", "xyz", "日本 the", "a"]
    got = {r.doc_id: r for r in language.predict(documents(spark, [(i, t, None, None) for i, t in enumerate(asked)]), model).collect()}
    for i, text in enumerate(asked):
        bits = {lang: _ppm_bits(tree, text) for lang, tree in trees.items()}
        best = min(bits, key=lambda lang: (round(bits[lang], 3), lang))
        assert got[i].lang_pred == best and got[i].bits == pytest.approx(bits[best], abs=1e-3)
        assert got[i].score == pytest.approx(1 / sum(2 ** (bits[best] - b) for b in bits.values()), abs=1e-3)


def test_index_and_bisection_agree(spark, monkeypatch):
    rows = [(i, text, lang, "a") for i, (lang, text) in enumerate(TRAINED)]
    model = language.train(documents(spark, rows))
    grams = model.grams[3][::2]
    direct = model.ready().bits(grams)
    model.index = None
    assert (model.bits(grams) == direct).all()


def test_tables_and_the_model_sent_out_agree(spark, tmp_path):
    rows = [(i, text, lang, "a") for i, (lang, text) in enumerate(TRAINED)]
    asked = ["the house", "die straße über", "xyz", "日本 the", "a", "", "123", None, "the cat " * 2000, "the house"]
    learned = documents(spark, rows)
    docs = stored(documents(spark, [(i, t, None, None) for i, t in enumerate(asked)]), tmp_path / "docs")
    large = language.train(learned, max_grams=0)
    assert isinstance(large, language.Tables)
    want = {r.doc_id: r for r in language.predict(docs, language.train(learned)).collect()}
    got = language.predict(docs, large).collect()
    assert len(got) == len(asked)
    for r in got:
        assert r.lang_pred == want[r.doc_id].lang_pred
        assert r.bits == pytest.approx(want[r.doc_id].bits, rel=1e-5) and r.score == pytest.approx(want[r.doc_id].score, abs=1e-3)


def test_counts_handed_on_early_add_up(spark):
    rows = documents(spark, [(i, text * 3, lang, "a") for i, (lang, text) in enumerate(TRAINED * 20)]).coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = set(map(tuple, language.count_strings(rows).collect()))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        assert set(map(tuple, language.count_strings(rows, held_most=10).collect())) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_language_of_awkward_rows(spark, tmp_path):
    got = language.identify(awkward(spark)).collect()
    assert len(got) == len(awkward_rows())
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    und = Counter(r.doc_id for r in got if r.lang_pred == "und")
    assert und == Counter(i for i, t, *_ in awkward_rows() if not any(c.isalpha() for c in t or ""))
    assert language.identify(empty(spark)).count() == 0
    learned = documents(spark, [(1, TRAINED[0][1], "en", "a")])
    small, large = language.train(learned), language.train(learned, max_grams=0)
    docs = stored(awkward(spark), tmp_path / "docs")
    rows = [{(r.doc_id, r.lang_pred, round(r.score, 3)) for r in language.predict(docs, m).collect()} for m in (small, large)]
    assert rows[0] == rows[1] and language.predict(empty(spark), large).count() == 0
    nothing = language.identify(documents(spark, [(1, "text", None, "a")])).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.98 * got.count() > 100


def _kneser_ney(texts):
    """p(last byte | before) of strings up to four bytes, from the definition."""
    full = Counter()
    for text in texts:
        data = b"\n\n\n" + text.encode()
        full.update(data[i - 3 : i + 1] for i in range(3, len(data)))
    counts = {4: full}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off, total, weight = {}, {}, {}
    for k, seen in counts.items():
        m = Counter(seen.values())
        y = m[1] / (m[1] + 2 * m[2]) if m[1] else 0.5
        off[k] = [min(max(d - (d + 1) * y * m[d + 1] / m[d] if m[d] else d / 2, 0.1), d) for d in (1, 2, 3)]
        total[k], weight[k] = Counter(), Counter()
        for g, c in seen.items():
            total[k][g[:-1]] += c
            weight[k][g[:-1]] += off[k][min(c, 3) - 1]

    def p(g):
        k = len(g)
        if not k:
            return 1 / 256
        t = total[k][g[:-1]]
        if not t:
            return p(g[1:])
        c = counts[k][g]
        return (c - off[k][min(c, 3) - 1] if c else 0) / t + weight[k][g[:-1]] / t * p(g[1:])

    return p


def test_perplexity_is_that_of_the_definition(spark, tmp_path):
    texts = [prose(30, i, 40) for i in range(8)] + ["the The THE!!", "für %%% ###", "q"]
    docs = stored(documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]), tmp_path / "docs")
    got = quality.judge(docs, labels(spark, [(i, 1, 0) for i in range(8)])).collect()
    p = _kneser_ney(texts[:8])
    for r in got:
        data = b"\n\n\n" + texts[r.doc_id].encode()
        bits = -sum(math.log2(p(data[i - 3 : i + 1])) for i in range(3, len(data)))
        assert r.n_bytes == len(data) - 3 and r.perplexity == pytest.approx(2 ** (bits / r.n_bytes), rel=1e-4)


def test_probabilities_sum_to_one():
    p = _kneser_ney([prose(30, i, 40) for i in range(4)])
    for context in (b"", b"w", b" w1", b"zzz"):
        assert sum(p(context + bytes([b])) for b in range(256)) == pytest.approx(1)


def test_quality_of_awkward_rows(spark, tmp_path):
    docs = stored(awkward(spark), tmp_path / "docs")
    for rows in ([(1, 1, 0), (2, 1, 1), (10, 0, 0), (None, 1, 0), (99, 1, 0), (1, 1, 0)], []):
        got = quality.judge(docs, labels(spark, rows)).collect()
        assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in awkward_rows())
        assert Counter(r.doc_id for r in got if r.n_bytes == 0) == Counter(i for i, t, *_ in awkward_rows() if not t)
        assert not any(r.kept for r in got if r.n_bytes == 0)
    assert quality.judge(empty(spark), labels(spark, [(1, 1, 0)])).count() == 0
    assert quality.judge(empty(spark), labels(spark, [])).count() == 0


def test_quality_keeps_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{folder}/labels.parquet")
    got = quality.judge(spark.read.parquet(f"{folder}/documents.parquet"), known).join(known, "doc_id")
    clean, junk = got.filter("quality = 1"), got.filter("quality = 0")
    assert clean.filter("kept").count() >= 0.99 * clean.count() and junk.filter("not kept").count() >= 0.9 * junk.count()


def test_threshold_is_the_quantile_of_each_language(spark, tmp_path):
    """Scores, limits and verdicts, from the definition, with a language of few trusted documents and one without any."""
    rows = [(i, prose(30 + i, i, 60), "en", "a") for i in range(30)]
    rows += [(30 + i, prose(30 + i, i, 60).replace("x", "ö"), "de", "a") for i in range(4)]
    rows += [(40, prose(50, 90, 60), "fr", "a"), (41, "%%% ### @@@ " * 20, "en", "a"), (42, "%%% ### @@@ " * 20, "de", "a")]
    docs = stored(documents(spark, rows), tmp_path / "docs")
    got = quality.judge(docs, labels(spark, [(i, 1, 0) for i in range(34)]), quantile=0.9).collect()
    bits = {r.doc_id: math.log2(r.perplexity) * r.n_bytes for r in got}
    size = {r.doc_id: r.n_bytes for r in got}
    trusted = {"en": range(30), "de": range(30, 34), "fr": []}
    overall = sum(bits[i] for i in range(34)) / sum(size[i] for i in range(34))
    weight = quality.SHRINK_DOCS * quality.SHRINK
    mean = {
        lang: (sum(bits[i] for i in ids) + weight * overall) / (sum(size[i] for i in ids) + weight) for lang, ids in trusted.items()
    }

    def score(i, lang):
        return (bits[i] + quality.SHRINK * mean[lang]) / (size[i] + quality.SHRINK)

    excess = {lang: [score(i, lang) - mean[lang] for i in ids] for lang, ids in trusted.items()}
    pooled = np.quantile([e for own in excess.values() for e in own], 0.9)
    for r in got:
        own, k = excess[r.lang], quality.SHRINK_DOCS
        above = (len(own) * np.quantile(own, 0.9) + k * pooled) / (len(own) + k) if own else pooled
        assert r.score == pytest.approx(score(r.doc_id, r.lang), abs=2e-4)
        assert r.threshold == pytest.approx(mean[r.lang] + above, abs=5e-4)
        assert r.kept == (r.score <= r.threshold)
    assert {r.doc_id for r in got if not r.kept} >= {41, 42}
