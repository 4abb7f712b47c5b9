"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A document's words are each labelled with their occurrence in the text (k-mers of one
word: a longer run is broken by each edit within it). Each hash function samples the
`sample` words with the least values and keeps them in text order; documents with the
same tuple in some table meet in a bucket. Unlike a set's MinHash, the tuple also sees
order and repeats. How many tables that takes follows from the similarity, wherever the
edits lie (`tables_for`). Short texts have shorter tuples; texts of sizes
at the border have both, so that any two within the limit have one kind in common.

In a bucket, members are compared with a pivot, not with each other. Links join
documents to components, and a bucket is done when the members that were not yet
pivot all belong to one component; until then further members become pivots, `GROWTH`
times as many each round. So a bucket of n copies costs n comparisons, and no pair that a
bucket proposes is given up unless its two sides are already linked, or their lengths
and the sampled places are further apart than the band.

Tables propose in waves (`WAVES`): the first few join most copies, and a later table's
buckets count only where they still hold several components. In a wave a bucket has one
pivot, out of its largest component, so only what is outside is compared. Further
pivots come after the last wave, in the buckets that are still open. Where more than
`GROWTH` members wait for that, and more than a text has rare words (texts that share a passage or have few different words),
their texts meet by their rarest words instead, which leaves out no pair within the limit.

Tuples that nobody shares are found by 44 bits of their hash and never shuffled as rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.llm import bitmaps
from stockloom.llm.arrow_text import runs, text_bytes
from stockloom.llm.components import merged
from stockloom.llm.edit import within
from stockloom.llm.word_windows import mix, word_hashes, words
from stockloom.plans.joins import settled

SAMPLE = 6  # words per tuple
SHORT_SAMPLE = 3  # the same for texts of fewer than LONG words
LONG = 32
RECALL = 0.999  # of pairs at the limit, for texts that repeat no word
BINS = 128
SIMILARITY = 0.8  # 1 - word edits / words of the longer text
CHUNK = 1 << 20  # bytes of text handled at once
GROWTH = 16  # of the number of pivots per round
CELL_BITS = 44  # of a tuple's hash, by which those that may be shared are found
MOST_BITS = 28  # of the filter of these: 32 MB
MOST_OWN = 256  # buckets by words that a text's rows list; of a text with more, a pair may be made more than once
WORD_BITS = 16  # bins in which words of crowded buckets are counted
WAVES = (4, 16)  # tables that have proposed after each wave but the last


MEMBER = ["h", "node", "n", "place", "label", "bag", "mass"]
STATE = [*MEMBER, "now", "served", "own"]


def tables_for(sample: int, similarity: float, least: int, most: int, recall: float = RECALL) -> int:
    """Tables by which two texts at the limit meet with probability `recall`, at the worst size from `least` to `most` words.

    With d of n words substituted, n - d words are shared out of n + d in all. A table's
    tuples are equal if its least values are all among the shared ones. Other edits leave more.
    """
    meet = 1.0
    for n in range(least, most + 1):
        d = int((1 - similarity) * n + 1e-9)
        take = min(sample, n)
        meet = min(meet, math.comb(n - d, take) / math.comb(n + d, take))
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-meet))) if meet < 1 else 1


def _seeds(tables: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.arange(tables, dtype=np.uint64)
    return mix(numbers, 21)[:, None], (mix(numbers, 22) | np.uint64(1))[:, None]


def _labelled(kmers: np.ndarray) -> np.ndarray:
    """K-mers told apart by how often each has occurred before."""
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    new = np.ones(len(kmers), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if new.all():
        return kmers
    at = np.arange(len(kmers))
    times = np.empty(len(kmers), np.uint64)
    times[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.where(times > 0, mix(kmers + times * np.uint64(0x9E3779B97F4A7C15), 23), kmers)


def sketch(kmers: np.ndarray, sample: int, tables: int, salt: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """(tuple's hash, place of its first k-mer) per table. Tuples of different `salt` never meet."""
    labelled = _labelled(kmers)
    take = min(sample, len(kmers))
    xor, times = _seeds(tables)
    step = max(1, (1 << 19) // len(kmers))
    at = np.concatenate(
        [
            np.argpartition((labelled ^ xor[i : i + step]) * times[i : i + step], take - 1, axis=1)[:, :take]
            for i in range(0, tables, step)
        ]
    )
    at.sort(axis=1)
    keys = np.arange(tables, dtype=np.uint64)
    for i in range(take):
        keys = mix(keys ^ labelled[at[:, i]], salt)
    return keys, at[:, 0]


def _key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, end, hashes of lower-case words, first word of each text, text of each word), some texts at a time."""
    _, offsets = text_bytes(column)
    for i, j in runs(offsets, CHUNK):
        data, cuts = text_bytes(pc.utf8_lower(column.slice(i, j - i)))
        begin, end, text = words(data, cuts)
        yield i, j, word_hashes(data, begin, end), np.searchsorted(text, np.arange(j - i + 1)), text


def _kinds(similarity: float, sample: int, recall: float) -> list[tuple[int, int, int, int, int]]:
    """Least and most words, words per tuple, tables and salt, of short texts and of long ones."""
    border = int(LONG / similarity)  # texts of more words are within the limit of none below LONG
    few = min(sample, SHORT_SAMPLE)
    if few > 1 and similarity <= (few - 1) / few:  # a text of fewer words than a tuple could be linked to one with more
        raise ValueError(f"similarity {similarity} is too low for tuples of {few} words")
    return [
        (1, border, few, tables_for(few, similarity, 1, border, recall), 25),
        (LONG, 1 << 62, sample, tables_for(sample, similarity, LONG, 64 * LONG, recall), 24),
    ]


def sketches(docs: DataFrame, similarity: float, sample: int, recall: float) -> DataFrame:
    """(`doc_id`, `node`, `n`, `keys`, `places`, `bag`): `node` stands for the text, `n` counts its words.

    `bag` counts them by hash, up to 127 each.

    A text without words has no keys.
    """
    kinds = _kinds(similarity, sample, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, n, keys, places, bags = [], [], [], [], []
            for i, j, values, first, text in _texts(batch.column("text")):
                nodes += [_key(t) for t in batch.column("text").slice(i, j - i).to_pylist()]
                bins = (values % np.uint64(BINS)).astype(np.int64)
                for d in range(len(first) - 1):
                    size = int(first[d + 1] - first[d])
                    n.append(size)
                    bags.append(np.bincount(bins[first[d] : first[d + 1]], minlength=BINS).clip(max=127).astype(np.int8))
                    own = values[first[d] : first[d + 1]]
                    found = [sketch(own, take, tables, salt) for low, high, take, tables, salt in kinds if low <= size <= high]
                    keys.append(np.concatenate([np.zeros(0, np.uint64), *(x for x, _ in found)]).view(np.int64))
                    places.append(np.concatenate([np.zeros(0, np.int32), *(x for _, x in found)]).astype(np.int32))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "node": pa.array(nodes, pa.int64()),
                    "n": pa.array(n, pa.int32()),
                    "keys": pa.array(keys, pa.list_(pa.int64())),
                    "places": pa.array(places, pa.list_(pa.int32())),
                    "bag": pa.array(bags, pa.list_(pa.int8())),
                }
            )

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node long, n int, keys array<long>, places array<int>, bag array<tinyint>"
    return rows.mapInArrow(run, schema)


def _cells(rows: DataFrame) -> DataFrame:
    """(`cell`): the first 44 bits of the tuples that occur twice or more, four bytes sent for each tuple.

    The first 12 bits are the group, the other 32 are what is sent. Copies of a text count
    too and tuples may agree in 44 bits by chance, so what is found is more than the
    shared tuples, never less.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys").flatten().to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - CELL_BITS)
            cells, times = np.unique(keys, return_counts=True)
            cells = np.repeat(cells, np.minimum(times, 2))
            groups = (cells >> np.uint64(32)).astype(np.int32)
            spans = np.searchsorted(groups, np.arange((1 << CELL_BITS - 32) + 1))
            low = cells.astype(np.uint32)
            own = np.flatnonzero(spans[1:] > spans[:-1])
            sent = [low[spans[g] : spans[g + 1]].tobytes() for g in own]
            yield pa.record_batch({"part": pa.array(own, pa.int32()), "sent": pa.array(sent, pa.binary())})

    def meet(part: pa.Table) -> pa.Table:
        low = np.sort(np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in part.column("sent")]))
        low = np.unique(low[1:][low[1:] == low[:-1]]).astype(np.int64)
        return pa.table({"cell": pa.array((part.column("part")[0].as_py() << 32) + low, pa.int64())})

    return rows.select("keys").mapInArrow(deal, "part int, sent binary").groupBy("part").applyInArrow(meet, "cell long")


def _entries(rows: DataFrame, short: int, border: int) -> DataFrame:
    """(`h`, `node`, `n`, `place`, `table`) of the tuples that may be shared. Others meet nobody and are not shuffled."""
    cells = settled(_cells(rows), "shared-cells")
    bits = bitmaps.bits_for(cells.count(), MOST_BITS)
    wanted = rows.sparkSession.sparkContext.broadcast(bitmaps.bitmap(cells, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("keys")
            sizes = np.diff(column.offsets.to_numpy())
            keys = column.flatten().to_numpy(zero_copy_only=False)
            places = batch.column("places").flatten().to_numpy(zero_copy_only=False)
            n = np.repeat(batch.column("n").to_numpy(), sizes)
            at = np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at -= np.where((n >= LONG) & (n <= border) & (at >= short), short, 0)  # long tuples after the short ones
            cell = (keys.view(np.uint64) >> np.uint64(64 - CELL_BITS)).view(np.int64)
            own = np.flatnonzero(bitmaps.has(wanted.value, cell, bits)) if len(keys) else []
            if len(own):
                node = np.repeat(batch.column("node").to_numpy(), sizes)
                out = {"h": keys[own], "node": node[own], "n": n[own], "place": places[own], "table": at[own].astype(np.int32)}
                yield pa.record_batch({k: pa.array(v) for k, v in out.items()})

    return rows.select("node", "n", "keys", "places").mapInArrow(run, "h long, node long, n int, place int, table int")


def _words_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(`node`, `words`) of the texts in `nodes`: 32 bits per word. A filter thins the texts before they are joined."""
    bits = bitmaps.bits_for(nodes.count())
    wanted = docs.sparkSession.sparkContext.broadcast(bitmaps.bitmap(nodes, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            keys = np.array([_key(t.as_py()) for t in column], np.int64)
            rows = np.flatnonzero(bitmaps.has(wanted.value, keys, bits)) if len(keys) else []
            if not len(rows):
                continue
            out = []
            for _, _, values, first, _ in _texts(column.take(pa.array(rows))):
                short = (values >> np.uint64(32)).astype(np.uint32)
                out += [short[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)]
            yield pa.record_batch({"node": pa.array(keys[rows]), "words": pa.array(out, pa.binary())})

    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    found = rows.mapInArrow(run, "node long, words binary")
    return found.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("words").alias("words"))


def _aligned(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """The pairs within the limit. Words that the two texts do not share are edits: that bound comes first."""
    for batch in batches:
        rows = []
        for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
            x, y = np.frombuffer(x.as_py(), np.uint32), np.frombuffer(y.as_py(), np.uint32)
            limit = int((1 - similarity) * max(len(x), len(y)) + 1e-9)
            u, v = np.sort(x), np.sort(y)
            nth = np.arange(len(u)) - np.searchsorted(u, u)
            shared = (nth < np.searchsorted(v, u, side="right") - np.searchsorted(v, u)).sum()
            if max(len(x), len(y)) - shared <= limit and within(x.tolist(), y.tolist(), limit) is not None:
                rows.append(i)
        if rows:
            yield batch.select(["a", "b"]).take(pa.array(rows))


def linked(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Those of (`a`, `b`) whose texts are within the limit. Only the texts they name are shuffled."""
    named = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    words = settled(words.join(settled(named, "pair-nodes"), "node", "left_semi"), "pair-words")
    both = pairs.join(words.select(F.col("node").alias("a"), F.col("words").alias("x")), "a").join(
        words.select(F.col("node").alias("b"), F.col("words").alias("y")), "b"
    )
    return both.select("a", "b", "x", "y").mapInArrow(lambda batches: _aligned(batches, similarity), "a long, b long")


def _rarest(crowd: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Members of buckets by single words, for the texts of (`node`, `n`, `label`, `bag`, `mass`).

    Of n words, a text within the limit lacks at most limit(n) (a repeat counts as a word of
    its own). So in any one order of all words, the first limit(n) + 1 of two such texts have one in
    common: no pair within the limit is left out. The order is by how often a word occurs in
    these texts, counted in 65536 bins; the rarest come first, so texts that share
    a passage or usual words do not meet for that.
    """
    texts = settled(crowd.join(words, "node"), "crowd-words")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(1 << WORD_BITS, np.int64)
        for batch in batches:
            for x in batch.column("words"):
                times += np.bincount(bitmaps.slot(_repeats(x), WORD_BITS), minlength=len(times))
        at = np.flatnonzero(times)
        yield pa.record_batch({"bin": pa.array(at, pa.int64()), "times": pa.array(times[at], pa.int64())})

    often = np.zeros(1 << WORD_BITS, np.int64)
    bins = texts.select("words").mapInArrow(counted, "bin long, times long").groupBy("bin").agg(F.sum("times").alias("times"))
    for r in bins.collect():
        often[r["bin"]] = r["times"]
    order = texts.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x in batch.column("words"):
                own = _repeats(x)
                limit = int((1 - similarity) * len(own) + 1e-9)
                times = order.value[bitmaps.slot(own, WORD_BITS)]
                first = np.lexsort((own, times))[: limit + 1]
                found.append(own[first[times[first] > 1]])  # a word that occurs once is shared by nobody
            if sum(map(len, found)):
                at = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
                rows = {c: batch.column(c).take(at) for c in ("node", "n", "label", "bag", "mass")}
                yield pa.record_batch({"h": pa.array(np.concatenate(found).view(np.int64)), **rows})

    rows = texts.select("node", "n", "label", "bag", "mass", "words")
    found = rows.mapInArrow(run, "h long, node long, n int, label long, bag array<tinyint>, mass int")
    return found.withColumn("place", F.lit(0))


def _repeats(words: pa.Scalar) -> np.ndarray:
    """The words of a text, each told apart by how often it has occurred before."""
    return _labelled(np.frombuffer(words.as_py(), np.uint32).astype(np.uint64))


def text_classes(
    docs: DataFrame, similarity: float = SIMILARITY, sample: int = SAMPLE, recall: float = RECALL
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Sketches of all documents; links (`a`, `b`) between nodes; (`node`, `label`) of linked nodes."""
    rows_of = settled(sketches(docs, similarity, sample, recall), "order-minhash")
    (_, border, _, short, _), _ = _kinds(similarity, sample, recall)
    entries = settled(_entries(rows_of, short, border), "bucket-entries")
    shared = entries.groupBy("h").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    members = settled(entries.join(shared.select("h"), "h").distinct(), "buckets")
    if members.isEmpty():
        return rows_of, None, None
    nodes = members.select("node").distinct()
    words = settled(_words_of(docs, nodes), "bucket-words")
    mass = F.aggregate("bag", F.lit(0), lambda total, x: total + x.cast("int"))
    bags = rows_of.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("bag").alias("bag"))
    bags = settled(bags.withColumn("mass", mass), "bucket-bags")
    found, begin, state = Found(words, similarity), 0, None
    for end in (*WAVES, None):
        own = members.filter(F.col("table") >= begin if end is None else F.col("table").between(begin, end - 1))
        own = _open(_labelled_by(own, found.labels), bags)
        found.add(own)
        state, begin = own if state is None else state.unionByName(own), end  # a bucket that is closed once stays closed
    many, parted = GROWTH, False
    while not state.isEmpty():
        state = settled(_labelled_by(state.drop("label"), found.labels), "bucket-labels")
        # members that were not yet pivot, outside the component that most of those belong to
        waiting = state.groupBy("h", "label").agg(F.sum((~F.col("served")).cast("int")).alias("m"), F.max("n").alias("n"))
        main = waiting.groupBy("h").agg(F.max_by("label", "m").alias("main"), F.max("m").alias("most"), F.sum("m").alias("all"), F.max("n").alias("n"))
        main = main.filter("all > most").select("h", "main", (F.col("all") - F.col("most") > F.greatest(F.lit(GROWTH), F.col("n") * (1 - similarity) + 1)).alias("crowded"))
        state = settled(state.join(main, "h"), "bucket-state")
        crowded = F.col("crowded") & F.lit(not parted)
        waits = ~F.col("served") & (F.col("label") != F.col("main"))
        turn = F.row_number().over(Window.partitionBy("h").orderBy("node"))
        ahead = state.filter(~crowded & waits).withColumn("now", turn <= many).withColumn("served", F.col("now"))
        rest = state.filter(~crowded & ~waits).withColumn("now", F.lit(False))
        if not parted:
            crowd = settled(state.filter(crowded).select("node", "n", "label", "bag", "mass").dropDuplicates(["node"]), "crowd")
        state = ahead.select(STATE).unionByName(rest.select(STATE))
        if not parted and not crowd.isEmpty():
            state = state.unionByName(_open(_rarest(crowd, words, similarity), None))
        state, parted = settled(state, "bucket-state"), True
        found.add(state)
        many *= GROWTH
    return rows_of, found.links, found.labels


def _labelled_by(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Adds `label`, the component of `node`; a node without links is its own."""
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _open(members: DataFrame, bags: DataFrame | None) -> DataFrame:
    """Buckets that hold several components, each with one pivot out of its largest.

    With no `bags`, the members are those of `_rarest`: they have their bags, and
    `own`, all such buckets of a text, so that a pair is made in one of them only.
    """
    members = settled(members, "wave")
    several = members.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    members = settled(members.join(settled(several.select("h"), "open"), "h"), "wave")
    luck = F.struct(F.xxhash64("node", "h").alias("luck"), "node")
    parts = members.groupBy("h", "label").agg(F.struct(F.count(F.lit(1)).alias("m"), F.min(luck).alias("first")).alias("part"))
    chosen = parts.groupBy("h").agg(F.max("part")["first"]["node"].alias("pivot"))
    pivot = F.col("node") == F.col("pivot")
    state = members.join(chosen, "h").withColumn("now", pivot).withColumn("served", pivot)
    if bags is None:
        state = state.withColumn("own", F.collect_list("h").over(Window.partitionBy("node")))
        state = state.withColumn("own", F.when(F.size("own") <= MOST_OWN, F.col("own")))
    else:
        state = state.join(bags, "node").withColumn("own", F.lit(None).cast("array<long>"))
    return settled(state.select(STATE), "bucket-state")


class Found:
    """Links between nodes, the pairs compared for them, and the components they make so far."""

    def __init__(self, words: DataFrame, similarity: float):
        self.words, self.similarity = words, similarity
        self.links, self.compared, self.labels = None, None, None

    def add(self, state: DataFrame) -> None:
        """Compares the present pivots of `state` with their buckets."""
        pairs = _pairs(state, 1 - self.similarity)
        pairs = settled(pairs if self.compared is None else pairs.join(self.compared, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            return
        self.compared = pairs if self.compared is None else self.compared.unionByName(pairs)
        new = settled(linked(pairs, self.words, self.similarity), "links")
        if not new.isEmpty():
            self.links = new if self.links is None else self.links.unionByName(new)
            self.labels = merged(self.labels, new)


def _pairs(state: DataFrame, gap: float) -> DataFrame:
    """Distinct (`a`, `b`) of each bucket's present pivots with its members in other components.

    At least as many words must be edited before the sampled word, and after it, as
    the two texts differ there; and at least as many as one bag lacks of the other.
    Pairs for which that is more than the band are left out, before any text is read.
    Members that were pivots before have been compared with the whole bucket, and of two
    present pivots only one looks at the other.
    """
    pivots = state.filter("now").select(*[F.col(c).alias(f"p_{c}") for c in STATE])
    # of the buckets by words where p is pivot and that hold both, the first makes the pair
    turns = F.when(F.col("p_own").isNotNull(), F.collect_list("p_h").over(Window.partitionBy("p_node", F.col("p_own").isNull())))
    pivots = pivots.withColumn("p_own", turns)
    ahead = F.abs(F.col("place") - F.col("p_place"))
    behind = F.abs((F.col("n") - F.col("place")) - (F.col("p_n") - F.col("p_place")))
    apart = F.zip_with("bag", "p_bag", lambda x, y: F.abs(x.cast("int") - y.cast("int")))
    apart = F.aggregate(apart, F.lit(0), lambda total, x: total + x) + F.abs(F.col("mass") - F.col("p_mass"))
    limit = gap * F.greatest("n", "p_n") + 1e-9
    near = (F.col("label") != F.col("p_label")) & (ahead + behind <= limit) & (apart / 2 <= limit)
    fresh = ~F.col("served") | (F.col("now") & (F.col("node") < F.col("p_node")))
    once = F.coalesce(F.array_min(F.array_intersect("own", "p_own")) == F.col("h"), F.lit(True))
    joined = state.filter("now or not served").join(pivots, (F.col("h") == F.col("p_h")) & near & fresh & once)
    return joined.select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, **params) -> DataFrame:
    """One row per document: `doc_id`, `node`, `class_id`, `class_size`, `kept`.

    Documents are in one class when links join their texts: links of at least
    `similarity`, one minus the word edits over the words of the longer text. Words are
    `[^\\x20\\x09-\\x0D]+`, in lower case; equal texts always share a class. `class_id`
    is the least doc_id, null only where all ids are; the document that has it is `kept`
    (rows repeated under it all say so). Null texts count as empty; texts without words
    are linked to none but their equals. An empty table gives no rows. Extra
    columns are not read. `node` stands for the text.
    """
    rows, _, labels = text_classes(docs, similarity, **params)
    rows = _labelled_by(rows.select("doc_id", "node"), labels)
    classes = settled(
        rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "classes"
    )
    return rows.join(classes, "label").select(
        "doc_id", "node", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
    )

