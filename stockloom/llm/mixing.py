"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

Blocks of equal size are the seats and a source's target words its votes. The
seats of a source with t votes have the quotients t/1, t/3, t/5 ...; the
highest quotients win. Only the seats whose rank is in doubt, at most three
per source, are ranked (`quotas`); no row is made per block.

A source's documents stand in a seeded order, cut in blocks of equal size. A
quota takes the whole source as often as its words go into the quota's, and for the
rest a run of blocks from a seeded block on, back to the first after the last. Positions within a source come from
prefix sums over buckets of the seeded order, so a source with a third of all
rows is spread over its buckets. The order is seeded by id and text, and rows equal in
both stand there once with their number.

The mix is cut in shards of equal numbers of blocks. Every shard has its own integer quota of
each source (`shard_quotas`), and takes the blocks that follow those of the shard before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.plans.joins import settled

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5  # all targets together, of all sizes
REPEATS = 2  # no source is taken more often
BLOCK = 64  # words
SEED = 17
SHARDS = 40
BUCKET_ROWS = 1 << 12
COPIES = 1 << 12  # equal rows made at a time


def _source_key(source: Column) -> Column:
    """Never null: '' stands for a null source, any other starts with 's'."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), source))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Adds `weight` and `target` to (`key`, `source_size`), one row per source.

    All targets make `share` of all sizes, in proportion to the weights, given
    in turn by code point, the null source last; where a target would exceed
    `repeats` times its source, it stops there and the excess goes to the others
    by weight. That is one water level: with sources in order of
    cap / weight, the level is found at the first source that it does not fill.
    """
    by_point = Window.orderBy((F.col("key") == "").cast("int"), "key")
    turn = (F.row_number().over(by_point) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    rows = rows.withColumn("cap", F.lit(float(repeats)) * F.col("source_size"))
    all_rows = Window.partitionBy()
    full = Window.orderBy(F.col("cap") / F.col("weight"), "key").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("total", F.sum("source_size").over(all_rows) * F.lit(share))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(full), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(full), F.lit(0.0)))
        .withColumn("fits", F.col("left") * F.col("weight") <= F.col("cap") * F.col("open"))
        .withColumn("level", F.max(F.when(F.col("fits"), F.col("left") / F.col("open"))).over(all_rows))
    )
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return rows.select("key", "source_size", "weight", target.alias("target"))


def quotas(rows: DataFrame, seats: Column, by: list[str] | None = None) -> DataFrame:
    """Adds `quota` to (`key`, `target`): Sainte-Laguë seats out of `seats`; `by` names separate houses.

    With votes t of T, house size N and n sources, the seats of a source lie
    between round(t (N - n) / T) and round(t (N + n) / T); those between are
    ranked by quotient, ties by source.
    """
    by = by or []
    house = Window.partitionBy(*by)
    rows = (
        rows.withColumn("_seats", seats)
        .withColumn("_votes", F.sum("target").over(house))
        .withColumn("_n", F.count(F.lit(1)).over(house))
    )

    def rounded(size: Column) -> Column:
        share = F.when(F.col("_votes") > 0, F.col("target") * size / F.col("_votes")).otherwise(F.lit(0.0))
        return F.floor(F.greatest(share, F.lit(0.0)) + 0.5)

    rows = rows.withColumn("_sure", rounded(F.col("_seats") - F.col("_n"))).withColumn(
        "_most", rounded(F.col("_seats") + F.col("_n"))
    )
    rows = rows.withColumn("_open", F.col("_seats") - F.sum("_sure").over(house))
    doubtful = rows.filter("_most > _sure").withColumn(
        "_k", F.explode(F.sequence(F.col("_sure"), F.col("_most") - 1))
    )
    best = Window.partitionBy(*by).orderBy((F.col("target") / (2 * F.col("_k") + 1)).desc(), (F.col("key") == ""), "key")
    won = (
        doubtful.withColumn("_rank", F.row_number().over(best))
        .filter("_rank <= _open")
        .groupBy(*by, "key")
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    joined = rows.join(won, [*by, "key"], "left")
    return joined.withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0))).drop(
        "_seats", "_votes", "_n", "_sure", "_most", "_open", "_won"
    )


def shard_quotas(sources: DataFrame, shards: int, block: int = BLOCK) -> DataFrame:
    """(`key`, `shard`, `quota`): blocks of each source in each shard of the mix.

    The apportionment is monotone in the house size, so a shard holds the seats
    that its part of the house adds; the shards add up to the whole quota.
    """
    total = F.sum("target").over(Window.partitionBy())
    houses = sources.withColumn("_all", F.round(total / block)).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards)))
    )
    upto = quotas(houses, F.floor(F.col("_all") * F.col("shard") / shards), ["shard"])
    before = F.lag("quota").over(Window.partitionBy("key").orderBy("shard"))
    return (
        upto.withColumn("quota", F.col("quota") - before)
        .filter("shard > 0")
        .select("key", (F.col("shard") - 1).alias("shard"), "quota")
    )


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    block: int = BLOCK,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
    shards: int = SHARDS,
) -> DataFrame:
    """One row per document: `doc_id`, `source`, `size`, `source_size`, `target`, `quota`, `taken`, `text_md5`, `mix_shard`.

    `size` counts words (null or wordless text: 0). `taken` is what the mix takes
    of the document, repeats counted, at most `repeats` times its size.
    `mix_shard` is the shard of its first word taken (null: none), by the shards' own quotas.
    A source's words come within one block of its target. Null ids and repeated
    rows are documents like others; rows of equal id and text are counted before they are
    placed, each gets its own place. No words at all: nothing is taken. An
    empty table gives no rows. Extra columns are not read. Single rows per
    source are ranked in one task; documents never are.
    """
    digest = F.md5(F.coalesce("text", F.lit("")))
    seeded = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), digest))
    words = settled(
        docs.select(
            "doc_id",
            "source",
            _source_key(F.col("source")).alias("key"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            seeded.alias("at"),
            digest.alias("text_md5"),
        )
        .groupBy("doc_id", "source", "key", "size", "at", "text_md5")
        .agg(F.count(F.lit(1)).alias("copies")),
        "mix-words",
    )
    buckets = max(1, words.count() // bucket_rows)
    place = F.conv(F.substring("at", 1, 8), 16, 10).cast("long")
    words = words.withColumn("bucket", F.floor(place * buckets / F.lit(2**32)).cast("int"))
    parts = settled(words.groupBy("key", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("part")), "mix-parts")
    sizes = parts.groupBy("key").agg(F.sum("part").alias("source_size"))
    sources = targets(sizes, weights, share, repeats)
    house = F.round(F.sum("target").over(Window.partitionBy()) / block)
    sources = settled(quotas(sources, house), "mix-sources")
    own = shard_quotas(sources.select("key", "target"), shards, block).groupBy("key")
    own = own.agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "quota"))), lambda x: x["quota"]).alias("own"))
    # where each shard's blocks of the source end, in the order they are taken
    ends = F.transform("own", lambda _, i: F.aggregate(F.slice("own", 1, i + 1), F.lit(0).cast("long"), lambda n, q: n + q))
    sources = sources.join(own.select("key", ends.alias("ends")), "key")
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"start{seed}"), "key")), 1, 8), 16, 10).cast("long")

    size = F.greatest("source_size", F.lit(1))
    sources = (
        sources.withColumn("words", F.least(F.col("quota") * block, F.col("source_size") * repeats))
        .withColumn("every", F.floor(F.col("words") / size))
        .withColumn("once", F.col("words") - F.col("every") * F.col("source_size"))
        .withColumn("run_from", F.pmod(start, F.greatest(F.ceil(F.col("source_size") / block), F.lit(1))) * block)
        .withColumn("run_to", F.least(F.col("run_from") + F.col("once"), "source_size"))
        .withColumn("wrap_to", F.greatest(F.col("run_from") + F.col("once") - F.col("source_size"), F.lit(0)))
    )
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = parts.withColumn("offset", F.coalesce(F.sum("part").over(before), F.lit(0))).join(
        sources.select("key", "source_size", "target", "quota", "every", "once", "run_from", "run_to", "wrap_to", "ends"), "key"
    )
    within = Window.partitionBy("key", "bucket").orderBy("at", "doc_id", "text_md5")
    held = F.col("size") * F.col("copies")
    placed = words.join(plan.drop("part"), ["key", "bucket"]).withColumn(
        "begin", F.col("offset") + F.sum(held).over(within.rowsBetween(Window.unboundedPreceding, 0)) - held
    )
    far = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES)))
    near = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(COPIES), F.col("copies") - F.col("far") * COPIES) - 1))
    placed = placed.withColumn("far", far).withColumn("near", near)
    placed = placed.withColumn("begin", F.col("begin") + (F.col("far") * COPIES + F.col("near")) * F.col("size"))
    end = F.col("begin") + F.col("size")

    def overlap(a: Column, b: Column) -> Column:
        return F.greatest(F.least(end, b) - F.greatest(F.col("begin"), a), F.lit(0))

    taken = (
        F.col("every") * F.col("size")
        + overlap(F.col("run_from"), F.col("run_to"))
        + overlap(F.lit(0).cast("long"), F.col("wrap_to"))
    )
    # the run is taken first, then what it goes on with from the first block, then the whole source
    first = (
        F.when(overlap(F.col("run_from"), F.col("run_to")) > 0, F.greatest("begin", "run_from") - F.col("run_from"))
        .when(overlap(F.lit(0).cast("long"), F.col("wrap_to")) > 0, F.col("run_to") - F.col("run_from") + F.col("begin"))
        .when((F.col("every") > 0) & (F.col("size") > 0), F.col("once") + F.col("begin"))
    )
    passed = F.size(F.filter("ends", lambda e: e <= F.floor(first / block)))
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "quota",
        taken.cast("long").alias("taken"),
        "text_md5",
        F.when(first.isNotNull(), passed).alias("mix_shard"),
    )


ORACLE = """
WITH words AS (
  SELECT doc_id, text, source,
         CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS key,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS seeded
  FROM documents
), sized AS (
  SELECT key, sum(size)::BIGINT AS source_size FROM words GROUP BY key
), weighed AS (
  SELECT key, source_size, 2.0::DOUBLE * source_size AS cap,
         [3, 1, 2][((row_number() OVER (ORDER BY (key = '')::INT, key) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         1.5::DOUBLE * sum(source_size) OVER () AS total
  FROM sized
), level AS (  -- the water level: the share per weight of the first source, by cap per weight, that it does not fill
  SELECT max(lvl) AS lvl FROM (
    SELECT (a.total - coalesce(sum(b.cap), 0)) / (any_value(w.weights) - coalesce(sum(b.weight), 0)) AS lvl, a.cap / a.weight AS own
    FROM weighed a CROSS JOIN (SELECT sum(weight) AS weights FROM weighed) w
    LEFT JOIN weighed b ON b.cap / b.weight < a.cap / a.weight OR (b.cap / b.weight = a.cap / a.weight AND b.key < a.key)
    GROUP BY a.key, a.total, a.cap, a.weight)
  WHERE lvl <= own
), aimed AS (
  SELECT key, source_size, least(cap, coalesce(lvl * weight, cap)) AS target,
         ceil(source_size / 64)::BIGINT AS blocks
  FROM weighed, level
), seats AS (  -- every seat with its quotient; the highest win
  SELECT key, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, (key = '')::INT, key) AS rank,
         (SELECT round(sum(target) / 64) FROM aimed) AS house
  FROM (SELECT key, target, unnest(range(0, 3 * blocks + 2)) AS k FROM aimed WHERE target > 0)
), quotas AS (
  SELECT a.*, least(coalesce(won, 0) * 64, 2 * source_size) AS words
  FROM aimed a LEFT JOIN (SELECT key, count(*) AS won FROM seats WHERE rank <= house GROUP BY key) USING (key)
), runs AS (
  SELECT *, words // greatest(source_size, 1) AS every,
         ('0x' || substr(md5('start17:' || key), 1, 8))::BIGINT % greatest(blocks, 1) * 64 AS run_from
  FROM quotas
), cuts AS (
  SELECT *, least(run_from + words - every * source_size, source_size) AS run_to,
         greatest(run_from + words - every * source_size - source_size, 0) AS wrap_to
  FROM runs
), placed AS (
  SELECT w.*, c.* EXCLUDE (key, words),
         sum(size) OVER (PARTITION BY w.key ORDER BY seeded, doc_id NULLS FIRST, md5(coalesce(text, ''))
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS begin
  FROM words w JOIN cuts c ON c.key = w.key
), met AS (
  SELECT *, greatest(least(begin + size, run_to) - greatest(begin, run_from), 0) AS in_run,
         greatest(least(begin + size, wrap_to) - begin, 0) AS in_wrap
  FROM placed
), firsts AS (  -- the block of a document's first word taken
  SELECT *, CASE WHEN in_run > 0 THEN greatest(begin, run_from) - run_from
                 WHEN in_wrap > 0 THEN run_to - run_from + begin
                 WHEN every > 0 AND size > 0 THEN words - every * source_size + begin END // 64 AS block
  FROM (SELECT m.*, c.words FROM met m JOIN cuts c ON c.key = m.key)
)
SELECT doc_id, size, source_size, target, (every * size + in_run + in_wrap)::BIGINT AS taken,
       ((40 * rank + house::BIGINT - 1) // house::BIGINT - 1)::INT AS mix_shard  -- the first with rank <= house * (shard + 1) / 40
FROM firsts f LEFT JOIN seats s ON s.key = f.key AND s.k = f.block
"""
