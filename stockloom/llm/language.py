"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of the last 0 to 3 bytes. A byte seen c times
after a context with n bytes, q of them distinct, costs -log2 c / (n + q); an
unseen one costs the escape -log2 q / (n + q) and is tried in the next shorter
context, at last as one of 256. The counts are frozen, so a text's code length
under a language is the sum of its bytes' costs, and the shortest wins.

Counting covers all texts learned from: tasks count 4-byte strings, a shuffle
adds them up, and no string is left out. While there are at most `MAX_GRAMS` distinct
strings, the costs of all are sent to the tasks (`Model`); beyond, they stay in tables and
chunks of documents ask for theirs (`Tables`). Both give the same code lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.arrow_text import PAD, STRING, byte_strings
from stockloom.llm.string_costs import sum_costs
from stockloom.plans.joins import settled

ORDER = STRING - 1
DENSE = 1 << 25  # cells of a direct index; a larger one gives way to bisection
MAX_GRAMS = 1 << 22  # distinct strings in a model that is sent out: 16 bytes each for four languages
HELD = 1 << 23  # distinct strings a counting task holds before it hands them on
UNKNOWN = "und"


def count_strings(texts: DataFrame, held_most: int = HELD) -> DataFrame:
    """(`lang`, `gram`, `n`) over all rows of (`text`, `lang`), texts padded."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts):
            grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            return grams, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)

        def handed(held):
            for lang, parts in held.items():
                grams, n = merged(parts)
                yield pa.record_batch(
                    {"lang": pa.array([lang] * len(grams)), "gram": pa.array(grams.astype(np.int64)), "n": pa.array(n)}
                )

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for i, j, grams, starts in byte_strings(batch.column("text")):
                ends = [*starts[1:], len(grams)]
                own = np.array(langs[i:j], dtype=object)
                for lang in set(langs[i:j]):
                    at = [grams[starts[k] : ends[k]] for k in np.flatnonzero(own == lang)]
                    parts = held.setdefault(lang, [])
                    parts.append(np.unique(np.concatenate(at), return_counts=True))
                    if len(parts) > 16:
                        held[lang] = [merged(parts)]
            if sum(len(g) for parts in held.values() for g, _ in parts) > held_most:
                yield from handed(held)
                held = {}
        yield from handed(held)

    return texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Costs in bits, by order: of strings seen (`gram` -> row) and of escapes (`context` -> row)."""

    def __init__(self, langs: list[str], grams: np.ndarray, counts: np.ndarray):
        """`counts` has a row for each of the sorted `grams`, a column per language."""
        self.langs = langs
        self.grams: list[np.ndarray] = []
        self.costs: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []
        below = None
        for order in range(ORDER + 1):
            mask = (1 << 8 * (order + 1)) - 1
            keys, where = np.unique(grams & mask, return_inverse=True)
            seen = np.zeros((len(keys), len(langs)), np.int64)
            np.add.at(seen, where, counts)
            contexts, of = np.unique(keys >> 8, return_inverse=True)
            n = np.zeros((len(contexts), len(langs)))
            q = np.zeros((len(contexts), len(langs)))
            np.add.at(n, of, seen)
            np.add.at(q, of, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escapes = np.where(n > 0, -np.log2(q / (n + q)), 0.0)
                own = -np.log2(seen / (n + q)[of])
            shorter = below[np.searchsorted(self.grams[-1], keys & (mask >> 8))] if order else np.full(seen.shape, 8.0)
            below = np.where(seen > 0, own, escapes[of] + shorter)
            self.grams.append(keys)
            self.costs.append(below.astype(np.float32))
            self.contexts.append(contexts)
            self.escapes.append(escapes.astype(np.float32))
        self.index = None

    def ready(self) -> Model:
        """Builds the direct index of the longest strings, in the task that uses it."""
        keys = self.grams[ORDER]
        highs, lows = np.unique(keys >> 16), np.unique(keys & 0xFFFF)
        if self.index is None and 0 < (len(highs) + 1) * (len(lows) + 1) <= DENSE:
            high = np.full(1 << 16, len(highs), np.int32)
            high[highs] = np.arange(len(highs))
            low = np.full(1 << 16, len(lows), np.int32)
            low[lows] = np.arange(len(lows))
            rows = np.full((len(highs) + 1, len(lows) + 1), -1, np.int32)
            rows[high[keys >> 16], low[keys & 0xFFFF]] = np.arange(len(keys))
            self.index = (high * np.int32(len(lows) + 1), low, rows.ravel())
        return self

    def _rows(self, order: int, grams: np.ndarray) -> np.ndarray:
        if order == ORDER and self.index:
            high, low, rows = self.index
            return rows[high[grams >> 16] + low[grams & 0xFFFF]]
        return _find(self.grams[order], grams)

    def bits(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Cost of each string's last byte after the bytes before it, a column per language."""
        if order < 0:
            return np.full((len(grams), len(self.langs)), 8.0, np.float32)
        rows = self._rows(order, grams)
        out = self.costs[order][rows]
        missed = np.flatnonzero(rows < 0)
        if len(missed):
            left = grams[missed]
            context = _find(self.contexts[order], left >> 8)
            escape = np.where((context >= 0)[:, None], self.escapes[order][context], np.float32(0))
            out[missed] = escape + self.bits(left & np.uint32((1 << 8 * order) - 1), order - 1)
        return out


def _find(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


def held_out(doc_id: Column) -> Column:
    """Documents kept out of all learning; a null id is neither learned from nor held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


class Tables:
    """The same costs in tables, per order: (`key`, `own`) of strings seen, (`context`, `escape`), maps by language number."""

    def __init__(self, langs: list[str], counts: DataFrame):
        """`counts`: (`lang`, `gram`, `n`) of all strings."""
        self.langs = langs
        number = (F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1).cast("int").alias("lang")
        counts = counts.select(number, "gram", "n")
        self.orders = []

        def wide(rows: DataFrame, key: str, cost: Column, name: str) -> DataFrame:
            rows = rows.select(key, F.struct("lang", cost.alias("cost")).alias("e"))
            return rows.groupBy(key).agg(F.map_from_entries(F.collect_list("e")).alias(name))  # an entry per language

        for order in range(ORDER + 1):
            seen = counts.groupBy("lang", _last(F.col("gram"), order + 1).alias("key")).agg(F.sum("n").alias("c"))
            seen = settled(seen.withColumn("context", F.shiftright("key", 8)), f"seen-{order}")
            contexts = seen.groupBy("lang", "context").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("q"))
            all_of = F.col("n") + F.col("q")
            own = wide(seen.join(contexts, ["lang", "context"]), "key", -F.log2(F.col("c") / all_of), "own")
            escapes = wide(contexts, "context", -F.log2(F.col("q") / all_of), "escape")
            self.orders.append((settled(own, f"own-{order}"), settled(escapes, f"escapes-{order}")))

    def resolve(self, grams: DataFrame) -> DataFrame:
        """(`gram`, `costs`): of each string's last byte after the bytes before it, by language."""
        below = F.array_repeat(F.lit(8.0), len(self.langs))
        for order, (own, escapes) in enumerate(self.orders):
            key = _last(F.col("gram"), order + 1)
            grams = grams.withColumn("_below", below).join(own, key == F.col("key"), "left")
            grams = grams.join(escapes, F.shiftright(key, 8) == F.col("context"), "left")
            cost = F.transform(
                "_below",
                lambda b, i: F.coalesce(
                    F.try_element_at("own", i), b + F.coalesce(F.try_element_at("escape", i), F.lit(0.0))
                ),
            )
            grams = grams.select("gram", cost.alias("_costs"))
            below = F.col("_costs")
        return grams.select("gram", F.col("_costs").cast("array<float>").alias("costs"))


def _last(gram: Column, size: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << 8 * size) - 1))


def train(docs: DataFrame, max_grams: int = MAX_GRAMS) -> Model | Tables | None:
    """The model of (`text`, `lang`); rows without either are left out. None if nothing is left."""
    counts = count_strings(
        docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("text") != "")).select(
            F.concat(F.lit(PAD), "text").alias("text"), "lang"
        )
    )
    counts = settled(counts, "language-strings")
    wide = counts.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    if counts.select("gram").distinct().count() > max_grams:
        names = [r["lang"] for r in counts.select("lang").distinct().collect()]  # languages, not documents
        return Tables(sorted(names), counts)
    table = wide.select("gram", F.map_keys("by").alias("langs"), F.map_values("by").alias("counts")).toArrow()
    if not table.num_rows:
        return None
    sizes = np.array([len(x) for x in table["langs"].to_pylist()])
    names = np.array(table["langs"].combine_chunks().flatten().to_pylist(), dtype=object)
    langs = sorted(set(names))
    keys, where = np.unique(table["gram"].to_numpy().astype(np.uint32), return_inverse=True)
    matrix = np.zeros((len(keys), len(langs)), np.int64)
    column = np.searchsorted(np.array(langs, dtype=object), names)
    matrix[np.repeat(where, sizes), column] = table["counts"].combine_chunks().flatten().to_numpy()
    return Model(langs, keys, matrix)


def _from_sums(sums: DataFrame, langs: list[str]) -> DataFrame:
    """The prediction of every row of (`doc_id`, `n`, `costs`)."""
    least = F.array_min("costs")
    share = F.aggregate("costs", F.lit(0.0), lambda s, b: s + F.pow(F.lit(2.0), F.greatest(least - b, F.lit(-1000.0))))
    best = F.element_at(F.array(*map(F.lit, langs)), F.array_position("costs", least).cast("int"))
    filled = F.col("n") > 0
    return sums.select(
        "doc_id",
        F.when(filled, best).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(filled, 1 / share).otherwise(0.0).alias("score"),
        F.when(filled, least).otherwise(0.0).alias("bits"),
    )


def predict(docs: DataFrame, model: Model | Tables | None) -> DataFrame:
    """`doc_id`, `lang_pred`, `score`, `bits` (shortest code length) of every document's whole text.

    `score` is the winner's share of 2^-bits over all languages; ties go to the
    first language by code point. A null text, or one without a letter, is `und`
    with score 0, as is everything when nothing was learned. Null ids and repeated
    rows are documents like others; an empty table gives no rows; extra columns
    are not read.
    """
    spoken = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", F.concat(F.lit(PAD), F.when(spoken, F.col("text")).otherwise("")).alias("text"))
    schema = "doc_id long, lang_pred string, score double, bits double"
    if model is None:
        nothing = F.lit(0.0)
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), nothing.alias("score"), nothing.alias("bits"))
    if isinstance(model, Tables):
        return _from_sums(sum_costs(rows, model.resolve, len(model.langs)), model.langs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value.ready()
        names = np.array([*model.langs, UNKNOWN], dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            length = np.zeros((batch.num_rows, len(model.langs)))
            empty = np.zeros(batch.num_rows, bool)
            for i, j, grams, starts in byte_strings(batch.column("text")):
                filled = np.diff([*starts, len(grams)]) > 0
                empty[i:j] = ~filled
                if filled.any():
                    at = starts[filled]
                    length[i:j][filled] = np.add.reduceat(model.bits(grams), at, axis=0, dtype=np.float64)
            best = length.argmin(axis=1)
            least = length.min(axis=1)
            share = 1 / np.exp2(np.maximum(least[:, None] - length, -1000)).sum(axis=1)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "lang_pred": pa.array(names[np.where(empty, len(model.langs), best)], pa.string()),
                    "score": pa.array(np.where(empty, 0.0, share)),
                    "bits": pa.array(np.where(empty, 0.0, least)),
                }
            )

    return rows.mapInArrow(score, schema)


def identify(docs: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred`, `score`: learned from the documents not held out."""
    learned = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    found = predict(docs, train(learned))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
