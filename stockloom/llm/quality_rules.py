"""Quality verdicts by gradient-boosted trees over document statistics.

Tasks compute a row of statistics for each whole text, a megabyte of text at a time. Trees are grown
on the driver from a bounded sample of labelled rows (`SAMPLE` for each label): statistics are cut into
quantile bins, each split is read off histograms of gradients, and for features in `MONOTONE`
no split may go against the stated direction, within the bounds its ancestors set. The trees are then flattened
into arrays of nodes, and all rows of a batch walk all trees together, one level a step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.arrow_text import runs, text_bytes
from stockloom.llm.language import held_out
from stockloom.llm.word_windows import UNSPACED, mix, windows, word_hashes, words
from stockloom.plans.joins import settled

SAMPLE = 16384  # labelled rows of each label that trees are grown on, at most
TREES = 80
DEPTH = 4
RATE = 0.15
BINS = 64
SHRINK = 1.0  # added to a leaf's curvature
LEAST_WEIGHT = 1.0  # curvature of a leaf, at least
THRESHOLD = 0.5
CHUNK = 1 << 20  # bytes of text handled at a time

# The base rules (fixed values).
SYMBOLS = "#*$%&|<>"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "words",
    "word_length",
    "symbols",
    "dup_lines",
    "repeated",
    "upper",
    "digits",
    "marks",
    "distinct",
    "words_per_line",
    "wordless",
    "beyond_ascii",
    "longest",
    "commonest",
    "short",
)
# More of these never makes a text better.
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeated": -1}


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


_SYMBOL = _class(SYMBOLS)
_UPPER, _DIGIT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789")
_LETTER = _class("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | (np.arange(256) >= 128)
_MARK = UNSPACED & ~_LETTER & ~_DIGIT & (np.arange(256) > 32)
_FIRST = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point


def _sums(flags: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many of the flags are set in each slice."""
    upto = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=upto[1:])
    return upto[end] - upto[begin]


def _alike(keys: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item its number among equal items of its text, and how many those are."""
    both = mix(keys + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(both, kind="stable")
    ordered = both[order]
    new = np.ones(len(both), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(both)))
    number, size = np.empty(len(both), np.int64), np.empty(len(both), np.int64)
    number[order] = np.arange(len(both)) - np.repeat(starts, sizes)
    size[order] = np.repeat(sizes, sizes)
    return number, size


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts x `COUNTS` integers, texts x `FEATURES` floats) of the texts bounded by `offsets`."""
    n, lo, hi = len(offsets) - 1, offsets[:-1], offsets[1:]
    begin, end, of = words(data, offsets)
    hashes = word_hashes(data, begin, end)
    count = lambda at, weights=None: np.bincount(at, weights, n)
    n_words = count(of)
    chars = _sums(UNSPACED[data] & _FIRST[data], lo, hi)

    cuts = np.flatnonzero(data == 10)
    line_begin = np.sort(np.concatenate([lo, cuts + 1]))
    # a text's end also ends its last line; a cut at a text's last byte opens an empty line there
    line_of = np.concatenate([np.arange(n), np.searchsorted(offsets, cuts, side="right") - 1])
    line_of = np.sort(line_of)
    line_begin = np.concatenate([[], line_begin]).astype(np.int64)
    line_end = np.append(line_begin[1:] - 1, len(data)) if len(line_begin) else line_begin
    last = np.append(line_of[1:] != line_of[:-1], True)
    line_end = np.where(last, hi[line_of], line_end) if n else line_end
    worded = _sums(UNSPACED[data], line_begin, line_end) > 0
    line_begin, line_end, line_of = line_begin[worded], line_end[worded], line_of[worded]
    earlier, _ = _alike(word_hashes(data, line_begin, line_end), line_of)
    dup_lines, lines = count(line_of[earlier > 0]), count(line_of)

    at, keys, _ = windows(hashes, of, WINDOW)
    _, times = _alike(keys, of[at])
    again = at[times > 1]
    cover = np.zeros(len(of) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    repeated = count(of[np.cumsum(cover[:-1]) > 0])

    number, times = _alike(hashes, of)
    length = _sums(_FIRST[data], begin, end)
    longest, commonest = np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.maximum.at(longest, of, length)
    np.maximum.at(commonest, of, times)
    symbols = _sums(_SYMBOL[data], lo, hi)
    some_words, some_chars = np.maximum(n_words, 1), np.maximum(chars, 1)
    share = lambda of_bytes: _sums(of_bytes[data], lo, hi) / some_chars
    features = [
        np.log1p(n_words),
        chars / some_words,
        symbols / some_chars,
        dup_lines / np.maximum(lines, 1),
        repeated / some_words,
        share(_UPPER),
        share(_DIGIT),
        share(_MARK),
        count(of[number == 0]) / some_words,
        n_words / np.maximum(lines, 1),
        count(of[_sums(_LETTER[data], begin, end) == 0]) / some_words,
        share((np.arange(256) >= 192)),
        np.log1p(longest),
        commonest / some_words,
        count(of[length <= 3]) / some_words,
    ]
    counts = np.stack([n_words, chars, symbols, dup_lines, repeated], axis=1).astype(np.int64)
    return counts, np.stack(features, axis=1).astype(np.float64)


def _measured(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    parts = [statistics(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in runs(offsets, CHUNK)]
    if not parts:
        return np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate([c for c, _ in parts]), np.concatenate([f for _, f in parts])


# --- trees --------------------------------------------------------------------------


@dataclass
class Trees:
    """All trees as one table of nodes. A leaf leads to itself."""

    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def score(self, features: np.ndarray, block: int = 4096) -> np.ndarray:
        """The probability of the label, for every row."""
        margin = np.full(len(features), self.start)
        for i in range(0, len(features) if len(self.roots) else 0, block):
            rows = features[i : i + block]
            at = np.tile(self.roots, (len(rows), 1))
            own = np.arange(len(rows))[:, None]
            for _ in range(self.depth):
                at = np.where(rows[own, self.feature[at]] <= self.limit[at], self.left[at], self.right[at])
            margin[i : i + block] += self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def grow(
    features: np.ndarray,
    label: np.ndarray,
    weight: np.ndarray,
    trees: int = TREES,
    depth: int = DEPTH,
    rate: float = RATE,
    monotone: dict[int, int] | None = None,
) -> Trees:
    """Boosted trees for the log-loss of `label`. Without both labels they say the only one's share."""
    total = weight.sum()
    share = float((weight * label).sum() / total) if total else 1.0
    nodes: dict[str, list] = {k: [] for k in ("feature", "limit", "left", "right", "value")}

    def node(value: float) -> int:
        at = len(nodes["value"])
        for name, of in (("feature", 0), ("limit", np.inf), ("left", at), ("right", at), ("value", value)):
            nodes[name].append(of)
        return at

    roots: list[int] = []
    start = float(np.log(share / (1 - share))) if 0 < share < 1 else (40.0 if share else -40.0)
    if 0 < share < 1:
        steps = [np.unique(np.quantile(f, np.arange(1, BINS) / BINS)) for f in features.T]
        binned = np.stack([np.searchsorted(s, f, side="left") for s, f in zip(steps, features.T, strict=True)], axis=1)
        margin = np.full(len(label), start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            gradient, curve = weight * (p - label), weight * p * (1 - p)
            roots.append(node(0.0))
            grown = [(roots[-1], np.arange(len(label)), -np.inf, np.inf)]
            for _ in range(depth):
                grown = [
                    child
                    for at, rows, low, high in grown
                    for child in _split(nodes, node, at, rows, low, high, binned, steps, gradient, curve, monotone or {})
                ]
            _settle(nodes, roots[-1], binned, steps, gradient, curve, rate, margin, features)
    arrays = {k: np.array(v, np.float64 if k in ("limit", "value") else np.int64) for k, v in nodes.items()}
    return Trees(np.array(roots, np.int64), **arrays, start=start, depth=depth)


def _weight(g, h):
    return -g / (h + SHRINK)


def _split(nodes, node, at, rows, low, high, binned, steps, gradient, curve, monotone):
    """The two children of a node that gains most by one, with the bounds of their values; none where nothing gains."""
    g, h = gradient[rows], curve[rows]
    value = float(np.clip(_weight(g.sum(), h.sum()), low, high))
    nodes["value"][at] = value
    gain = lambda g, h, w: -(2 * g * w + (h + SHRINK) * w * w)  # noqa: E731  what a value takes off the loss
    own = gain(g.sum(), h.sum(), value)
    best = (1e-9, None)
    for f, limits in enumerate(steps):
        if not len(limits):
            continue
        left_g = np.cumsum(np.bincount(binned[rows, f], g, len(limits) + 1))[:-1]
        left_h = np.cumsum(np.bincount(binned[rows, f], h, len(limits) + 1))[:-1]
        right_g, right_h = g.sum() - left_g, h.sum() - left_h
        lw, rw = np.clip(_weight(left_g, left_h), low, high), np.clip(_weight(right_g, right_h), low, high)
        gains = gain(left_g, left_h, lw) + gain(right_g, right_h, rw) - own
        gains[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = -np.inf
        way = monotone.get(f, 0)
        if way:
            gains[way * (rw - lw) < 0] = -np.inf
        cut = int(np.argmax(gains))
        if gains[cut] > best[0]:
            best = (gains[cut], (f, cut, lw[cut], rw[cut], way))
    if best[1] is None:
        return []
    f, cut, lw, rw, way = best[1]
    goes = binned[rows, f] <= cut
    children = [node(0.0), node(0.0)]
    nodes["feature"][at], nodes["limit"][at] = f, steps[f][cut]
    nodes["left"][at], nodes["right"][at] = children
    middle = (lw + rw) / 2
    bounds = [(low, high), (low, high)]
    if way > 0:
        bounds = [(low, middle), (middle, high)]
    elif way < 0:
        bounds = [(middle, high), (low, middle)]
    found = [(children[0], rows[goes], *bounds[0]), (children[1], rows[~goes], *bounds[1])]
    for child, own_rows, lo, hi in found:  # of use where no further level is grown
        nodes["value"][child] = float(np.clip(_weight(gradient[own_rows].sum(), curve[own_rows].sum()), lo, hi))
    return found


def _settle(nodes, root, binned, steps, gradient, curve, rate, margin, features):
    """Scale a finished tree's values by the rate and add them to the rows' margins."""
    for at in range(root, len(nodes["value"])):
        nodes["value"][at] *= rate
    at = np.full(len(margin), root)
    feature, limit = np.array(nodes["feature"]), np.array(nodes["limit"])
    left, right, value = np.array(nodes["left"]), np.array(nodes["right"]), np.array(nodes["value"])
    while True:
        go = np.where(features[np.arange(len(at)), feature[at]] <= limit[at], left[at], right[at])
        if (go == at).all():
            break
        at = go
    margin += value[at]


# --- the operator -------------------------------------------------------------------


def examples(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, label, weight) of at most `sample` documents of each label.

    Ids are drawn by hash among those whose CRC is not held out; an id with several labels has the least, one with
    several documents is one of them. Weights restore the labels' true shares.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    known = settled(known.join(docs.select("doc_id"), "doc_id", "left_semi"), "rule-labels")
    count = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    luck = [F.xxhash64("doc_id", F.lit("quality rules")), F.col("doc_id")]
    drawn = [known.filter(F.col("quality") == y).orderBy(*luck).limit(sample) for y in (0, 1)]
    drawn = F.broadcast(settled(drawn[0].unionByName(drawn[1]), "rule-sample"))  # at most 2 x `sample` short rows

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, features = _measured(batch.column("text"))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(features.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.record_batch([batch.column("doc_id"), batch.column("quality"), rows], names=["doc_id", "quality", "f"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(drawn, "doc_id")
    rows = texts.mapInArrow(measure, "doc_id long, quality int, f array<double>")
    table = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("f").alias("f")).orderBy("doc_id").toArrow()
    label = table.column("quality").to_numpy()
    features = np.array(table.column("f").to_pylist(), np.float64).reshape(len(label), len(FEATURES))
    own = np.bincount(label, minlength=2) if len(label) else np.zeros(2)
    weight = np.array([count.get(int(y), 0) / own[y] for y in label], np.float64)
    return features, label.astype(np.float64), weight


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    monotone = {FEATURES.index(name): way for name, way in MONOTONE.items()}
    return grow(*examples(docs, labels, sample), monotone=monotone)


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id`, the five counts, `base_failed`, `kept` and `score` (the trees' probability of good quality) of every row.

    Null and empty texts, and those without a word, have counts of 0 and fail the base rules, as all texts
    of under `LEAST_WORDS` words do. Rows with null ids or ids that repeat are judged each by its own text. Equal
    texts have equal verdicts. Where one label has no document the verdict is that of the base rules or, without any good
    one, false. An empty table gives no rows. Further columns are not read.
    """
    trees = train(docs, labels, sample)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features = _measured(batch.column("text"))
            failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
            p = trees.score(features)
            columns = [batch.column("doc_id"), *(pa.array(c) for c in counts.T)]
            columns += [pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p)]
            yield pa.record_batch(columns, names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    integers = ", ".join(f"{c} long" for c in COUNTS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, f"doc_id long, {integers}, base_failed boolean, kept boolean, score double")
