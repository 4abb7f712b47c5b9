"""Ranked lexical search by best-first document intervals over range-maximum sparse tables.

One pass over the documents writes an index: segments of `SEGMENT` documents, each with the posting lists
of the words that a block of items asks for. Counts of documents and words, summed over
segments, fix every posting's impact. A second pass searches the segments: each posting list gets a sparse
table that names the largest impact of any stretch in two reads. An interval of documents is bounded by the
sum of its lists' maxima; the interval with the largest bound is split at the
document that holds the largest impact in it, that document is scored, and what is left on either side is bounded
again. Short intervals are scored outright. Nothing with a bound below the k-th score found so far is opened.

A task keeps its best `k` per item over all its segments; only those leave it. Items are worked off in
blocks of at most `BLOCK` (item, word) pairs, so what a task is sent has a bound, whatever the number of items.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.llm.arrow_text import runs, text_bytes
from stockloom.llm.word_windows import LETTERS, word_hashes, words
from stockloom.plans.joins import settled

K = 50
SEGMENT = 4096  # documents
BLOCK = 1 << 20  # (item, word) pairs searched for in one pass
LEAF = 64  # documents an interval is scored at outright
OPEN = 32  # intervals opened at a time at most,
NEAR = 0.8  # and of those only the ones bounded by so much of the largest bound
CHUNK = 1 << 20  # bytes of text handled at a time

# The words and the weights of the ranking (fixed values).
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SEGMENTS = (
    "docs int, total long, terms binary, starts binary, places binary, tf binary, ids binary, no_id binary, lengths binary"
)


def item_words(text: str | Column) -> Column:
    """The distinct words of a text; none for null."""
    lowered = F.translate(text, UPPER, UPPER.lower())
    return F.array_distinct(F.regexp_extract_all(F.coalesce(lowered, F.lit("")), F.lit(WORD), F.lit(0)))


class Vocabulary:
    """The words asked for, numbered; looked up by hash, length and first bytes."""

    def __init__(self, asked: list[str]) -> None:
        data, offsets = text_bytes(pa.array(asked, pa.string()))
        begin, end = offsets[:-1], offsets[1:]
        hashes = word_hashes(data, begin, end)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.length = (end - begin)[self.order]
        self.head = _heads(data, begin, end)[self.order]

    def numbers(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words nobody asked for."""
        if not len(self.hashes) or not len(begin):
            return np.full(len(begin), -1)
        hashes = word_hashes(data, begin, end)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = np.flatnonzero((self.hashes[at] == hashes) & (self.length[at] == end - begin))
        found = found[self.head[at[found]] == _heads(data, begin[found], end[found])]
        numbers = np.full(len(begin), -1)
        numbers[found] = self.order[at[found]]
        return numbers


def _heads(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first eight bytes of each word as a number."""
    out = np.zeros(len(begin), np.uint64)
    for i in range(8):
        some = np.flatnonzero(begin + i < end)
        out[some] |= data[begin[some] + i].astype(np.uint64) << np.uint64(8 * i)
    return out


def build_index(docs: DataFrame, vocabulary: Vocabulary, segment: int = SEGMENT) -> DataFrame:
    """Segments with the postings of the vocabulary's words over all rows of (`doc_id`, `text`)."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = vocabulary.value
        size = len(asked.hashes)
        held: list[tuple] = []  # (number of documents, ids, no_id, lengths, place, term, tf)
        total = counted = 0

        def emit() -> pa.RecordBatch:
            shift = np.cumsum([0, *(h[0] for h in held)])
            place = np.concatenate([h[4] + s for h, s in zip(held, shift, strict=False)])
            term, tf = (np.concatenate([h[c] for h in held]) for c in (5, 6))
            order = np.lexsort((place, term))
            place, term, tf = place[order], term[order], tf[order]
            terms, starts = np.unique(term, return_index=True)
            parts = [
                terms.astype(np.int32),
                np.append(starts, len(term)).astype(np.int32),
                place.astype(np.int32),
                tf.astype(np.int32),
                np.concatenate([h[1] for h in held]),
                np.concatenate([h[2] for h in held]),
                np.concatenate([h[3] for h in held]),
            ]
            columns = [pa.array([counted], pa.int32()), pa.array([total], pa.int64())]
            columns += [pa.array([p.tobytes()], pa.binary()) for p in parts]
            return pa.record_batch(columns, names=[c.split()[0] for c in SEGMENTS.split(", ")])

        for batch in batches:
            ids = batch.column("doc_id")
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = text_bytes(batch.column("text"))
            for i, j in runs(offsets, CHUNK):
                lowered = _LOWER[data[offsets[i] : offsets[j]]]
                begin, end, of = words(lowered, offsets[i : j + 1] - offsets[i], LETTERS)
                lengths = np.bincount(of, minlength=j - i).astype(np.int64)
                numbers = asked.numbers(lowered, begin, end)
                known = numbers >= 0
                pairs, tf = np.unique(of[known] * max(size, 1) + numbers[known], return_counts=True)
                of, term = np.divmod(pairs, max(size, 1))
                for low in range(0, j - i, segment):  # short texts: more of them in a chunk than a segment takes
                    high = min(low + segment, j - i)
                    a, b = np.searchsorted(of, [low, high])
                    some, places = np.unique(of[a:b], return_inverse=True)
                    if sum(h[0] for h in held) + len(some) > segment:
                        yield emit()
                        held, total, counted = [], 0, 0
                    total += int(lengths[low:high].sum())
                    counted += int((lengths[low:high] > 0).sum())
                    held.append((len(some), ids[i:j][some], no_id[i:j][some], lengths[some], places, term[a:b], tf[a:b]))
        if held:
            yield emit()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return settled(rows.mapInArrow(write, SEGMENTS), "lexical-segments")


def statistics(segments: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(documents with a word, all their words, documents by word), summed over the segments."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for terms, starts in zip(batch.column("terms"), batch.column("starts"), strict=True):
                df[np.frombuffer(terms.as_py(), np.int32)] += np.diff(np.frombuffer(starts.as_py(), np.int32))
        some = np.flatnonzero(df)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["term", "df"])

    whole = segments.agg(F.sum("docs").alias("n"), F.sum("total").alias("l")).first()
    rows = segments.select("terms", "starts").mapInArrow(count, "term int, df long")
    table = rows.groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # at most a row per word asked for
    df = np.zeros(size, np.int64)
    df[table.column("term").to_numpy()] = table.column("df").to_numpy()
    return whole["n"] or 0, whole["l"] or 0, df


class Segment:
    """The posting lists of a segment, end to end in one array, with one sparse table of places of maxima."""

    def __init__(self, terms, starts, places, tf, ids, no_id, lengths, n: int, total: int) -> None:
        self.terms, self.starts, self.ids, self.no_id = terms, starts.astype(np.int64), ids, no_id
        self.docs = len(ids)
        self.place = places.astype(np.int64)
        self.key = np.repeat(np.arange(len(terms)), np.diff(self.starts)) * self.docs + self.place
        m = 50 + (50 * lengths * n) // max(total, 1)
        tf = tf.astype(np.int64)
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[self.place])
        longest = int(np.diff(self.starts).max()) if len(terms) else 0
        self.log = np.zeros(longest + 2, np.int64)
        for i in range(2, longest + 2):
            self.log[i] = self.log[i >> 1] + 1
        size = len(self.impact)
        levels = int(self.log[longest]) + 1 if longest else 1
        self.best = np.zeros((levels, size), np.int32)  # [j, i]: where the maximum of the 2^j impacts from i on is
        self.best[0] = np.arange(size)
        for j in range(1, levels):
            half, upto = 1 << (j - 1), size - (1 << j) + 1
            if upto <= 0:
                break
            a, b = self.best[j - 1, :upto], self.best[j - 1, half : half + upto]
            self.best[j, :upto] = np.where(self.impact[b] > self.impact[a], b, a)

    def maxima(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where the largest impact of each stretch is; any place for an empty one."""
        size = end - begin
        j = self.log[np.maximum(size, 1)]
        top = len(self.impact) - 1
        a = self.best[j, np.minimum(begin, top)]
        b = self.best[j, np.clip(end - (1 << j), 0, top)]
        return np.where(self.impact[b] > self.impact[a], b, a)

    def bounds(self, weight: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(what each list can add at most, where that is) by interval and list."""
        at = self.maxima(begin, end)
        return np.where(end > begin, weight * self.impact[at], 0), at

    def search(self, lists: np.ndarray, weight: np.ndarray, found: Best, leaf: int = LEAF) -> tuple[int, int]:
        """Add the segment's best documents for the words `lists` (places in `terms`). (Intervals opened, documents scored.)"""
        begin, end = self.starts[lists][None], self.starts[lists + 1][None]
        base = lists * self.docs
        low, high = np.zeros(1, np.int64), np.full(1, self.docs)
        gains, at = self.bounds(weight, begin, end)
        heap: list[tuple] = []
        opened = scored = count = 0

        def push(low, high, begin, end, gains, at) -> None:
            nonlocal count
            bound = gains.sum(axis=1)
            most = gains.argmax(axis=1)
            cut = self.place[at[np.arange(len(at)), most]]
            for i in np.flatnonzero((bound > 0) & (bound >= found.bar)):
                count += 1
                heapq.heappush(heap, (-int(bound[i]), count, int(low[i]), int(high[i]), int(cut[i]), begin[i], end[i]))

        push(low, high, begin, end, gains, at)
        while heap and -heap[0][0] >= found.bar:
            batch, near = [], max(found.bar, int(-heap[0][0] * NEAR))
            while heap and len(batch) < OPEN and -heap[0][0] >= near:
                batch.append(heapq.heappop(heap))
            opened += len(batch)
            short = [b for b in batch if b[3] - b[2] <= leaf]
            if short:
                scored += self._score(short, weight, found)
            long_ = [b for b in batch if b[3] - b[2] > leaf]
            if not long_:
                continue
            low, high, cut = (np.array([b[c] for b in long_]) for c in (2, 3, 4))
            begin, end = np.stack([b[5] for b in long_]), np.stack([b[6] for b in long_])
            middle = np.searchsorted(self.key, base[None] + cut[:, None])
            own = np.minimum(middle, len(self.key) - 1)
            there = (middle < end) & (self.key[own] == base[None] + cut[:, None])
            scores = np.where(there, weight * self.impact[own], 0).sum(axis=1)
            scored += len(cut)
            found.add(scores, self.ids[cut], self.no_id[cut])
            sides = [
                np.concatenate([low, cut + 1]),
                np.concatenate([cut, high]),
                np.concatenate([begin, middle + there]),
                np.concatenate([middle, end]),
            ]
            push(*sides, *self.bounds(weight, sides[2], sides[3]))
        return opened, scored

    def _score(self, intervals: list[tuple], weight: np.ndarray, found: Best) -> int:
        """Score all documents of some intervals."""
        begin = np.concatenate([b[5] for b in intervals])
        size = np.concatenate([b[6] for b in intervals]) - begin
        weight = np.tile(weight, len(intervals))
        some = size > 0
        begin, size, weight = begin[some], size[some], weight[some]
        first = np.cumsum(size) - size
        at = np.repeat(begin - first, size) + np.arange(int(size.sum()))
        docs, of = np.unique(self.place[at], return_inverse=True)
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, of, np.repeat(weight, size) * self.impact[at])
        found.add(scores, self.ids[docs], self.no_id[docs])
        return len(docs)


class Best:
    """The best `k` of an item so far: score descending, then id, null ids last. `bar`: what a score must reach."""

    def __init__(self, k: int) -> None:
        self.k, self.bar = k, 1
        self.score, self.ids, self.no_id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        some = score >= self.bar
        if not some.any():
            return
        score = np.concatenate([self.score, score[some]])
        ids, no_id = np.concatenate([self.ids, ids[some]]), np.concatenate([self.no_id, no_id[some]])
        order = np.lexsort((ids, no_id, -score))[: self.k]
        self.score, self.ids, self.no_id = score[order], ids[order], no_id[order]
        if len(order) == self.k:
            self.bar = int(self.score[-1])


def weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n + 2) / (2.0 * df + 1))).astype(np.int64)


def best_per_task(segments: DataFrame, items: list[np.ndarray], n: int, total: int, df: np.ndarray, k: int) -> DataFrame:
    """(`item`, `doc_id`, `score`): the best `k` of every task for every item, items by number."""
    sent = segments.sparkSession.sparkContext.broadcast((items, weights(n, df), n, total))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, n, total = sent.value
        found = [Best(k) for _ in items]
        for batch in batches:
            for row in range(batch.num_rows):
                raw = lambda c, kind: np.frombuffer(batch.column(c)[row].as_buffer(), kind)  # noqa: B023,E731
                terms = raw("terms", np.int32)
                if not len(terms):
                    continue
                numbers = [raw(c, np.int32) for c in ("starts", "places", "tf")]
                own = Segment(terms, *numbers, raw("ids", np.int64), raw("no_id", bool), raw("lengths", np.int64), n, total)
                place = np.full(len(weight), -1)
                place[terms] = np.arange(len(terms))
                for number, asked in enumerate(items):
                    lists = place[asked]
                    some = (lists >= 0) & (weight[asked] > 0)
                    if some.any():
                        own.search(lists[some], weight[asked][some], found[number])
        for number, best in enumerate(found):
            if len(best.score):
                ids = pa.array(best.ids, mask=best.no_id)
                columns = [pa.array(np.full(len(best.score), number, np.int32)), ids, pa.array(best.score)]
                yield pa.record_batch(columns, names=["item", "doc_id", "score"])

    return segments.mapInArrow(search, "item int, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK, segment: int = SEGMENT
) -> DataFrame:
    """`item_id`, `rank`, `doc_id`, `score`: the `k` documents of the highest scores above 0 for every item.

    Equal scores go by ascending doc_id, null ids last. Documents are told apart by row: an id that repeats can be
    in a ranking more than once, equal rows as well. Null and empty texts have no word and no rank. Items
    that repeat in id and text are one; an id with two texts has two rankings, a null id is an id. An item
    without a word that some document has gives no rows, like an empty table on either side. Further columns are not read.
    """
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = asked.distinct().select("item_id", F.xxhash64("item_id", "text").alias("key"), item_words("text").alias("words"))
    asked = settled(asked.filter(F.size("words") > 0), "lexical-items")
    pairs = asked.agg(F.sum(F.size("words"))).first()[0] or 0
    passes = -(-pairs // block)
    hits = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for number in range(passes):
        own = asked.filter(F.pmod("key", F.lit(passes)) == number).orderBy("item_id", "key").toArrow()
        if len(own):
            hits = hits.unionByName(_pass(docs, own, k, segment))
    return hits


def _pass(docs: DataFrame, own: pa.Table, k: int, segment: int) -> DataFrame:
    """The rankings of one block of items (`item_id`, `words`)."""
    flat = own.column("words").combine_chunks()
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    coded = flat.flatten().dictionary_encode()
    cuts = np.asarray(flat.offsets)
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    items = [numbers[a - cuts[0] : b - cuts[0]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    segments = build_index(docs, Vocabulary(coded.dictionary.to_pylist()), segment)
    n, total, df = statistics(segments, len(coded.dictionary))
    best = settled(best_per_task(segments, items, n, total, df, k), "lexical-best")
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    ids = pa.table({"item": pa.array(np.arange(len(items), dtype=np.int32)), "item_id": own.column("item_id")})
    names = F.broadcast(docs.sparkSession.createDataFrame(ids))  # a row per item of the block
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


_TERMS = f"regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{WORD}')"

ORACLE = f"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS doc, doc_id, {_TERMS} AS words FROM documents),
lengths AS (SELECT doc, doc_id, len(words) AS n FROM texts WHERE len(words) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS word FROM benchmark),
tf AS MATERIALIZED (
  SELECT doc, word, count(*) AS tf FROM (SELECT doc, unnest(words) AS word FROM texts)
  WHERE word IN (SELECT word FROM asked) GROUP BY ALL),
weights AS (
  SELECT word, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, totals GROUP BY word, docs),
impacts AS MATERIALIZED (
  SELECT doc, doc_id, word, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))) AS impact
  FROM tf JOIN lengths USING (doc) JOIN weights USING (word), totals),
scores AS (
  SELECT item_id, doc, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM asked JOIN impacts USING (word) GROUP BY ALL)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= {K}
"""
