"""Benchmark decontamination by CGK embedding and bit-sampling LSH, verified by edit distance.

The random walk of Chakraborty, Goldenberg and Koucky copies a word per step and moves
on to the next word or stays, as a random bit of (step, word) says. Two walks
with the same bits fall into step again after an edit, so a small edit distance becomes
a small Hamming distance, and equal samples of a few steps become likely.

Items are dealt into size classes. In every document, windows of the class's size
(shorter where the document ends) walk along with the items and are looked up by their sampled steps, often enough that
an item at the edit limit is found with probability `recall`: how often is measured on
random copies of the items, edited up to the limit. Windows that hold too few words of
any item cannot be within the limit and do not walk; nor can those with too few of their pairs of neighbours. Each hit is verified by the
edit distance of the item to its best place around the window.

Items are read in blocks of `BLOCK_WORDS` words at most, so what a task holds of them does
not grow with their number; each block passes over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.arrow_text import runs, spans, text_bytes
from stockloom.llm.edit import best_part
from stockloom.llm.word_windows import LETTERS, mix, word_hashes, words
from stockloom.plans.joins import settled

SIMILARITY = 0.8
RECALL = 0.99
SAMPLED = 3  # steps per lookup
WALKS = 12  # independent embeddings, taken in turn
LOOKUPS = 1 << 16  # more than this for one class of sizes is an error
RATIO = 1.2  # of the sizes in a class
STEPS = 1.6  # of the walk per word: its sampled part seldom leaves the item
BLOCK_WORDS = 1 << 20
CHUNK = 1 << 20
FILTER_BITS = 20
COPIES = 400  # edited copies measured per class
SCHEMA = "doc_id long, item_id long, distance int, item_words int, first_word int, end_word int, evidence string"


def _hashed(column: pa.Array, i: int | None = None, j: int | None = None):
    data, offsets = text_bytes(column if i is None else column.slice(i, j - i))
    begin, end, text = words(data, offsets, LETTERS)
    return data, begin, end, text, word_hashes(data, begin, end)


def _pair(values: np.ndarray) -> np.ndarray:
    """A hash of each word with its next."""
    return mix(values[:-1] + (values[1:] << np.uint64(1)), 9)


def moves(values: np.ndarray, steps: int, seed: int) -> list[np.ndarray]:
    """Random bits of every word, 64 steps to an array: whether a walk that stands on it moves on."""
    return [mix(values, 1000 * seed + block) for block in range(-(-steps // 64))]


def walk(values: np.ndarray, at: np.ndarray, end: np.ndarray, steps: int, bits: list[np.ndarray]) -> np.ndarray:
    """(step, window): the word copied at each step by walks from `at`; 0 beyond `end`."""
    out = np.zeros((steps, len(at)), np.uint64)
    at = at.copy()
    for j in range(steps):
        place = np.minimum(at, len(values) - 1)
        inside = at < end
        out[j] = np.where(inside, values[place], np.uint64(0))
        at += ((bits[j // 64][place] >> np.uint64(j % 64)) & inside).astype(at.dtype)
    return out


class SizeClass:
    """Items of similar size, and the lookups of their walks."""

    def __init__(self, items: list[np.ndarray], which: list[int], similarity: float, recall: float):
        self.which = np.array(which)
        sizes = [len(items[i]) for i in which]
        self.size = min(sizes)
        self.slack = int((1 - similarity) * max(sizes) + 1e-9)  # edits allowed
        self.steps = max(1, round(STEPS * self.size))
        values = np.concatenate([items[i] for i in which])
        end = np.cumsum(sizes)
        self.lookups = self._enough(values, end, sizes, similarity, recall)
        lucky = np.random.default_rng(self.size)
        self.samples = [
            np.sort(lucky.choice(self.steps, min(SAMPLED, self.steps), replace=False)) for _ in range(self.lookups)
        ]
        walks = [walk(values, end - sizes, end, self.steps, moves(values, self.steps, w)) for w in range(WALKS)]
        self.tables = []
        for n, steps in enumerate(self.samples):
            keys = self.key(walks[n % WALKS], n, steps)
            order = np.argsort(keys, kind="stable")
            self.tables.append((keys[order], order))

    @staticmethod
    def key(path: np.ndarray, n: int, steps: np.ndarray) -> np.ndarray:
        out = np.full(path.shape[1], n, np.uint64)
        for step in steps:
            out = mix(out ^ path[step], 7)
        return out

    def _enough(self, values, end, sizes, similarity, recall) -> int:
        """Lookups that find the share `recall` of random copies with as many edits as the limit allows."""
        lucky = np.random.default_rng(len(values))
        texts = []
        picks = lucky.integers(0, len(sizes), COPIES)
        for pick in picks:
            text = list(values[end[pick] - sizes[pick] : end[pick]])
            for _ in range(int((1 - similarity) * len(text) + 1e-9)):
                place, kind = int(lucky.integers(0, max(1, len(text)))), int(lucky.integers(0, 3))
                word = int(lucky.integers(1, 2**62))
                text[place : place + (kind != 1)] = [word] if kind < 2 else []
            texts.append(np.array(text, np.uint64))
        length = np.array([len(t) for t in texts])
        stop = np.cumsum(length)
        copies = np.concatenate(texts)
        if not len(copies):
            return 1
        missed = np.ones(COPIES)
        per_walk = []
        for w in range(WALKS):
            ours = walk(values, (end - sizes)[picks], end[picks], self.steps, moves(values, self.steps, w))
            theirs = walk(copies, stop - length, stop, self.steps, moves(copies, self.steps, w))
            equal = (ours == theirs).mean(axis=0)
            per_walk.append(1 - equal ** min(SAMPLED, self.steps))
        for n in range(LOOKUPS):
            missed *= per_walk[n % WALKS]
            if missed.mean() <= 1 - recall:
                return n + 1
        raise ValueError(f"{LOOKUPS} lookups find less than {recall} of the items of {max(sizes)} words")

    def near(self, known: np.ndarray, pairs: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Starts of windows of the class's size, in one document, with words and pairs of the items enough.

        Before a document's end also those that it cuts off, down to the words an item keeps at the limit.

        An edit leaves at most one word of the window, and two pairs of neighbours, without
        their like in the item. `known` and `pairs` count those found in some item, up to each word.
        """
        n, least, joined = len(known) - self.size, self.size - self.slack, self.size - 1 - 2 * self.slack
        cut = ends[1:, None] - np.arange(max(1, least), self.size)
        which, _ = np.nonzero(inside := cut >= ends[:-1, None])
        cut, stop = cut[inside], ends[1:][which]
        cut = cut[(known[stop] - known[cut] >= least) & (pairs[stop - 1] - pairs[cut] >= joined)]
        if n <= 0:
            return np.sort(cut)
        enough = known[self.size :] - known[:n] >= least
        enough &= pairs[self.size - 1 : -1] - pairs[:n] >= joined
        whole = np.flatnonzero(enough & (doc[:n] == doc[self.size - 1 :]))
        return np.sort(np.concatenate([whole, cut])) if len(cut) else whole

    def find(self, values: np.ndarray, at: np.ndarray, end: np.ndarray, bits: list) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (window, item) pairs with an equal sample."""
        walks = [walk(values, at, end, self.steps, bits[w]) for w in range(min(WALKS, self.lookups))]
        pairs = []
        for n, steps in enumerate(self.samples):
            keys = self.key(walks[n % WALKS], n, steps)
            table, order = self.tables[n]
            low, high = np.searchsorted(table, keys), np.searchsorted(table, keys, side="right")
            hit = np.flatnonzero(high > low)
            times = (high - low)[hit]
            inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            pairs.append(np.repeat(hit, times) * len(self.which) + order[np.repeat(low[hit], times) + inner])
        found = np.unique(np.concatenate(pairs))
        return found // len(self.which), self.which[found % len(self.which)]


class Index:
    """The lookups of one block of items."""

    def __init__(self, ids: list[int], texts: list[str], similarity: float, recall: float):
        _, _, _, text, hashes = _hashed(pa.array(texts, pa.string()))
        cuts = np.searchsorted(text, np.arange(len(texts) + 1))
        self.items = [hashes[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
        self.ids = np.array(ids, dtype=object)
        self.limits = [int((1 - similarity) * len(x) + 1e-9) for x in self.items]
        self.lists = [x.tolist() for x in self.items]
        order = sorted((i for i in range(len(ids)) if len(self.items[i])), key=lambda i: len(self.items[i]))
        self.classes: list[SizeClass] = []
        while order:
            least = len(self.items[order[0]])
            own = [i for i in order if len(self.items[i]) <= RATIO * least]
            self.classes.append(SizeClass(self.items, own, similarity, recall))
            order = order[len(own) :]
        bits = max(FILTER_BITS, min(24, int(16 * len(hashes)).bit_length()))
        self.words, self.pairs, self.shift = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool), np.uint64(64 - bits)
        self.words[hashes >> self.shift] = True
        self.pairs[_pair(hashes)[text[1:] == text[:-1]] >> self.shift] = True

    def hits(self, values: np.ndarray, doc: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
        """(document, item) -> (distance, end word) of the item's best place, for those within the limit."""
        found: dict[tuple[int, int], tuple[int, int]] = {}
        if not len(values):
            return found
        known = np.concatenate([[0], np.cumsum(self.words[values >> self.shift], dtype=np.int32)])
        pairs = np.concatenate([[0], np.cumsum(self.pairs[_pair(values) >> self.shift], dtype=np.int32), [0]])
        ends = np.searchsorted(doc, np.arange(doc[-1] + 2))
        near = [(group, at) for group in self.classes if len(at := group.near(known, pairs, doc, ends))]
        longest = max((group.steps for group, _ in near), default=0)
        bits = [moves(values, longest, w) for w in range(WALKS if near else 0)]
        for group, at in near:
            where, item = group.find(values, at, ends[doc[at] + 1], bits)
            start = at[where]
            order = np.lexsort((start, item))
            start, item = start[order], item[order]
            # windows of an item that overlap in a document are verified together
            apart = (item[1:] != item[:-1]) | (doc[start[1:]] != doc[start[:-1]]) | (np.diff(start) > group.size)
            for i, j in spans(np.cumsum(np.concatenate([[False], apart]))[: len(start)]):
                own, d = int(item[i]), int(doc[start[i]])
                limit, size = self.limits[own], len(self.items[own])
                low = max(int(ends[d]), int(start[i]) - size - limit)
                high = min(int(ends[d + 1]), int(start[j - 1]) + 2 * size + limit)
                distance, end = best_part(self.lists[own], values[low:high].tolist())
                if distance <= limit and (distance, low + end) < found.get((d, own), (limit + 1, 0)):
                    found[d, own] = (distance, low + end)
        return found


def find_items(
    docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, block: int = BLOCK_WORDS
) -> DataFrame:
    """One row per document and item that it holds: `doc_id`, `item_id`, `distance`, `item_words`,
    `first_word`, `end_word`, `evidence`.

    Words are runs of letters and digits, in lower case. A document holds an item when
    some part of it is at most (1 - similarity) x (words of the item) word edits away;
    `evidence` is about that part. Of several places the nearest counts, then the first.
    Null texts and items, and items without words, match nothing; items under five
    words only match exactly. Rows repeated are searched each for itself, null ids
    included. An empty table on either side gives no rows. Extra columns are not read.
    """
    spark = docs.sparkSession
    known = items.select("item_id", F.lower("text").alias("text")).filter("text IS NOT NULL AND text <> ''")
    total = known.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * block)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    found = spark.createDataFrame([], SCHEMA)
    for n in range(blocks):
        own = known.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == n).orderBy("item_id", "text").collect()
        if not own:
            continue
        index = Index([r["item_id"] for r in own], [r["text"] for r in own], similarity, recall)
        shared = spark.sparkContext.broadcast(index)
        part = texts.mapInArrow(_search(shared), SCHEMA)
        if blocks > 1:  # one block's index at a time
            part = settled(part, f"items-{n}")
            shared.destroy()
        found = part if blocks == 1 else found.unionByName(part)
    return found


def _search(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            column = batch.column("text")
            _, offsets = text_bytes(column)
            ids = batch.column("doc_id").to_pylist()
            for i, j in runs(offsets, CHUNK):
                data, begin, end, doc, values = _hashed(column, i, j)
                rows = []
                for (d, own), (distance, stop) in sorted(index.hits(values, doc).items()):
                    first = int(np.searchsorted(doc, d))
                    size = len(index.items[own])
                    start = max(first, stop - size)
                    part = data[begin[start] : end[stop - 1]].tobytes().decode("utf-8", "replace") if stop > start else ""
                    rows.append((ids[i + d], index.ids[own], distance, size, start - first, stop - first, part))
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
                    names = [field.split()[0] for field in SCHEMA.split(", ")]
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.record_batch(columns, names=names)

    return search
