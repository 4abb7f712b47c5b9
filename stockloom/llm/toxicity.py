"""Toxicity by the nearest labelled examples, in exact TF-IDF cosine over block-max inverted indexes.

The examples are a bounded sample of the labelled documents (`EXAMPLES`, half of each
label while there are enough). Terms are words and their beginnings of 4 and 6 bytes.
The vocabulary is the `TERMS` terms that speak for the label most clearly
(chi-squared); its weights are (1 + log tf) x idf, vectors of length one. Examples that share their strongest terms stand together in
blocks, and each term knows its largest weight in each block: a block whose bound lies
below the k-th similarity found so far is not read. The k nearest vote by
similarity, and isotonic regression over the examples' own votes, each left out of its
neighbours, turns votes into probabilities at the labels' true shares.

The index is sent to the tasks: at most `EXAMPLES` vectors over `TERMS` terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.arrow_text import runs, spans, text_bytes
from stockloom.llm.language import held_out
from stockloom.llm.word_windows import LETTERS, mix, word_hashes, words
from stockloom.plans.joins import settled

EXAMPLES = 8192
TERMS = 1024
LEAST_CHI = 10.83  # one in a thousand by chance: few examples
ENOUGH_CHI = 40.0  # asked of a term as soon as 60 examples for each unit make it possible
LEAST_DOCS = 3
STEMS = (4, 6)  # bytes
NEIGHBOURS = 15
BLOCK = 64
FIRST = 4  # blocks read before any is skipped
PRIOR = 0.25  # similarity's worth of votes at the labels' share
THRESHOLD = 0.3
FILTER_BITS = 18
CHUNK = 1 << 20


def terms_of(batch_column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, terms, row of each term) by chunks.

    Terms are runs of letters and digits, in lower case already, and their beginnings.
    """
    _, offsets = text_bytes(batch_column)
    for i, j in runs(offsets, CHUNK):
        data, cuts = text_bytes(batch_column.slice(i, j - i))
        begin, end, row = words(data, cuts, LETTERS)
        terms, rows = [word_hashes(data, begin, end)], [row]
        for n in STEMS:
            long = end - begin > n
            terms.append(mix(word_hashes(data, begin[long], begin[long] + n), n))
            rows.append(row[long])
        yield i, j - i, np.concatenate(terms), np.concatenate(rows)


def _counted(terms: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) pairs in order, and their counts."""
    order = np.lexsort((terms, row))
    terms, row = terms[order], row[order]
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], terms[at], np.diff(np.append(at, len(terms)))


def sampled(docs: DataFrame, labels: DataFrame, limit: int) -> tuple[DataFrame, dict[int, int]]:
    """(`doc_id`, `toxic`, `term`, `tf`) of the examples, and how many labelled documents there are by label.

    Each example also has a row with a null term, so that one without any word is an example too.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = settled(known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "toxic-labels")
    count = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    least = min(limit // 2, *(count.get(y, 0) for y in (0, 1)))
    room = {y: min(count.get(y, 0), limit - least) if count.get(y, 0) >= limit // 2 else count.get(y, 0) for y in (0, 1)}
    luck = [F.xxhash64("doc_id", F.lit("example")), F.col("doc_id")]
    own = [known.filter(F.col("toxic") == y).orderBy(*luck).limit(room[y]) for y in (0, 1)]
    chosen = F.broadcast(own[0].unionByName(own[1]))  # at most `limit` rows
    texts = (
        docs.select("doc_id", F.lower("text").alias("text"))
        .join(chosen, "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))  # rows under one id make one example
    )

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, toxic = batch.column("doc_id"), batch.column("toxic")
            none = [pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int32())]
            yield pa.record_batch([ids, toxic, *none], names=["doc_id", "toxic", "term", "tf"])
            for i, _, terms, row in terms_of(batch.column("text")):
                row, terms, tf = _counted(terms, row)
                at = pa.array(row + i)
                columns = [ids.take(at), toxic.take(at), pa.array(terms.view(np.int64)), pa.array(tf.astype(np.int32))]
                yield pa.record_batch(columns, names=["doc_id", "toxic", "term", "tf"])

    return settled(texts.mapInArrow(count_terms, "doc_id long, toxic int, term long, tf int"), "examples"), count


def vocabulary(examples: DataFrame, sizes: dict[int, int], terms: int, least_docs: int) -> dict[int, int]:
    """Term -> number of examples that have it, for those commoner among toxic ones that depend on the label most."""
    n1, n0 = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    n, a = n0 + n1, F.col("toxic")
    table = examples.filter("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("toxic").alias("toxic"))
    off = a * n0 - (F.col("df") - a) * n1
    chi = off * off * n / (F.lit(max(n0 * n1, 1.0)) * F.col("df") * F.greatest(F.lit(n) - F.col("df"), F.lit(1.0)))
    best = (
        table.filter(F.col("df") >= least_docs)
        .filter(a * n0 > (F.col("df") - a) * n1)
        .withColumn("chi", chi)
        .filter(F.col("chi") >= min(ENOUGH_CHI, max(LEAST_CHI, n / 60)))
        .orderBy(F.desc("chi"), "term")
        .limit(terms)
    )
    return {r["term"]: r["df"] for r in best.collect()}


class Index:
    """Examples as unit vectors, by term, in blocks."""

    def __init__(self, ids: np.ndarray, toxic: np.ndarray, rows: tuple, docs_with: dict[int, int], shares: dict[int, float]):
        """`rows`: (example, term, tf); `shares`: true count per example of each label."""
        example, term, tf = rows
        self.terms = np.array(sorted(docs_with), np.int64)
        df = np.array([docs_with[t] for t in self.terms], float)
        self.idf = np.log((1 + len(ids)) / (1 + df)) + 1
        where = np.searchsorted(self.terms, term)
        weight = (1 + np.log(tf)) * self.idf[where] if len(tf) else np.zeros(0)
        length = np.sqrt(np.bincount(example, weight**2, len(ids))) if len(tf) else np.zeros(len(ids))
        weight = weight / np.maximum(length[example], 1e-12) if len(tf) else weight
        # neighbours in the index share their strongest term
        lead = np.full(len(ids), -1)
        order = np.argsort(weight, kind="stable")
        lead[example[order]] = where[order]
        place = np.lexsort((ids, -length, lead))
        rank = np.empty(len(ids), np.int64)
        rank[place] = np.arange(len(ids))
        self.ids, self.toxic = ids[place], toxic[place]
        self.vote = np.where(self.toxic == 1, shares.get(1, 1.0), shares.get(0, 1.0))
        positive = float(self.vote[self.toxic == 1].sum())
        self.prior = positive / max(1e-12, float(self.vote.sum()))
        example = rank[example]
        order = np.lexsort((example, where))
        self.example, self.weight, where = example[order], weight[order], where[order]
        self.blocks = max(1, -(-len(ids) // BLOCK))
        cell = where * self.blocks + self.example // BLOCK
        self.begin = np.searchsorted(cell, np.arange(len(self.terms) * self.blocks + 1))
        self.most = np.zeros(len(self.terms) * self.blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(len(self.terms), self.blocks)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.terms.view(np.uint64) >> np.uint64(64 - FILTER_BITS)] = True
        self.curve = (np.array([0.0]), np.array([self.prior]))

    def _read(self, term: np.ndarray, q: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = (term[:, None] * self.blocks + blocks[None, :]).ravel()
        begin, size = self.begin[cell], self.begin[cell + 1] - self.begin[cell]
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        found, where = np.unique(self.example[at], return_inverse=True)
        return found, np.bincount(where, self.weight[at] * np.repeat(np.repeat(q, len(blocks)), size), len(found))

    def nearest(self, term: np.ndarray, tf: np.ndarray, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The most similar examples, ties by id: (place, cosine)."""
        q = (1 + np.log(tf)) * self.idf[term]
        q = q / np.sqrt((q**2).sum())
        bound = q @ self.most[term]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        found, cosine = self._read(term, q, order[:FIRST])
        known = cosine[found != but]
        least = np.partition(known, -NEIGHBOURS)[-NEIGHBOURS] if len(known) >= NEIGHBOURS else 0.0
        rest = order[FIRST:]
        rest = rest[bound[rest] >= least - 1e-9]
        if len(rest):
            more = self._read(term, q, rest)
            found, cosine = np.append(found, more[0]), np.append(cosine, more[1])
        keep = found != but
        found, cosine = found[keep], np.round(cosine[keep], 9)
        best = np.lexsort((self.ids[found], -cosine))[:NEIGHBOURS]
        return found[best], cosine[best]

    def votes(self, found: np.ndarray, cosine: np.ndarray) -> float:
        """Share of similarity on the toxic side, at the labels' true shares."""
        pull = cosine * self.vote[found]
        base = PRIOR * float(self.vote.mean()) if len(self.vote) else 1.0
        share = (pull[self.toxic[found] == 1].sum() + base * self.prior) / (pull.sum() + base)
        return round(float(share), 9)  # equal neighbours make equal votes

    def calibrate(self) -> Index:
        """Isotonic regression of the examples' labels on their own votes, each left out of its neighbours."""
        order = np.lexsort((self.example,))
        example, weight = self.example[order], self.weight[order]
        term = (np.searchsorted(self.begin, order, side="right") - 1) // self.blocks
        cuts = np.searchsorted(example, np.arange(len(self.ids) + 1))
        vote = np.full(len(self.ids), -1.0)  # without a term: no evidence, a class of its own
        for k in range(len(self.ids)):
            i, j = cuts[k], cuts[k + 1]
            if j > i:
                own = weight[i:j] / self.idf[term[i:j]]  # proportional to 1 + log tf
                tf = np.exp(own / own.min() - 1)
                vote[k] = self.votes(*self.nearest(term[i:j], tf, k))
        value, at = np.unique(vote, return_inverse=True)
        n, y = np.bincount(at, self.vote), np.bincount(at, self.vote * self.toxic)
        blocks: list[list[float]] = []
        for v, a, b in zip(value, n, y, strict=True):
            blocks.append([v, a, b])
            while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
                _, a, b = blocks.pop()
                blocks[-1][1] += a
                blocks[-1][2] += b
        rate = np.array([(b + self.prior) / (a + 1) for _, a, b in blocks]).clip(0, 1)
        self.curve = (np.array([v for v, _, _ in blocks]), np.maximum.accumulate(rate))
        return self

    def probability(self, vote: float) -> float:
        return float(self.curve[1][max(0, np.searchsorted(self.curve[0], vote, side="right") - 1)])


def learn(docs: DataFrame, labels: DataFrame, limit: int = EXAMPLES, terms: int = TERMS) -> Index | None:
    """The index of the examples; None if no labelled document may be learned from."""
    examples, count = sampled(docs, labels, limit)
    # documents, not terms: an example without any term is one too
    kept = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.countDistinct("doc_id").alias("n")).collect()}
    if not kept:
        return None
    known = vocabulary(examples, kept, terms, LEAST_DOCS)
    chosen = examples.sparkSession.createDataFrame([(t,) for t in known], "term long")
    people = examples.select("doc_id", "toxic").distinct().orderBy("doc_id").toArrow()  # at most `limit` rows
    own = examples.join(F.broadcast(chosen), "term").select("doc_id", "term", "tf").orderBy("doc_id", "term").toArrow()
    ids = people["doc_id"].to_numpy()
    example = np.searchsorted(ids, own["doc_id"].to_numpy())
    shares = {y: count.get(y, 0) / kept[y] for y in kept}
    rows = (example, own["term"].to_numpy(), own["tf"].to_numpy())
    return Index(ids, people["toxic"].to_numpy(), rows, known, shares).calibrate()


def score(docs: DataFrame, index: Index | None) -> DataFrame:
    """`doc_id`, `score`, `predicted`, `votes`, `evidence` (nearest examples' ids, the nearest first) of every document.

    Whole texts are read. A document without any term of the vocabulary, an empty or a
    null one, has no evidence and the score of examples like it. Without anything
    learned all scores are 0. Null ids and repeated rows are documents like
    others; an empty table gives no rows; extra columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, score double, predicted int, votes double, evidence array<long>"
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            n = batch.num_rows
            found = np.zeros(n) if index is None else np.full(n, index.probability(-1.0))
            votes, evidence = np.full(n, -1.0), [[] for _ in range(n)]
            for i, _, terms, row in terms_of(batch.column("text")) if index is not None and len(index.terms) else ():
                maybe = index.filter[terms >> np.uint64(64 - FILTER_BITS)]
                terms, row = terms[maybe].view(np.int64), row[maybe]
                at = np.minimum(np.searchsorted(index.terms, terms), len(index.terms) - 1)
                sure = index.terms[at] == terms
                row, term, tf = _counted(at[sure], row[sure])
                for a, b in spans(row):
                    near, cosine = index.nearest(term[a:b], tf[a:b])
                    d = i + int(row[a])
                    votes[d] = index.votes(near, cosine)
                    found[d] = index.probability(votes[d])
                    evidence[d] = index.ids[near].tolist()
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "score": pa.array(found),
                    "predicted": pa.array((found >= THRESHOLD).astype(np.int32)),
                    "votes": pa.array(votes),
                    "evidence": pa.array(evidence, pa.list_(pa.int64())),
                }
            )

    return docs.select("doc_id", F.lower("text").alias("text")).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`score` of every document, learned from the labels of those not held out."""
    return score(docs, learn(docs, labels)).withColumn("held_out", held_out(F.col("doc_id")))
