"""Merkle manifest of a table: one tree per language, their subroots in one tree above them.

Every level is a table of nodes, numbered without gaps inside their tree. A level is
lifted by an equijoin with itself: the first node of each run of `FAN` asks for the
numbers that follow its own, the nodes answer by their number, and the first node
emits the run's digests and their parent. No task holds more than a range of
the leaves, and a tree with most of the rows is as many ranges as it needs.

Proofs come down again: a run joins the run of its parent, so each step moves an eighth of
the rows of the one below, and leaves join the lowest runs once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockloom.plans.joins import settled

FAN = 8
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SIDES = "array<struct<left:binary,right:binary>>"
SCHEMA = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _field(value: Column) -> Column:
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row's five fields, some of them changed."""
    values = [changed.get(c, F.col(c)).cast("string") for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*[_field(v) for v in values]), 256))


def numbered(rows: DataFrame, group: str, order: list[str], copies: str) -> DataFrame:
    """`first`: how many rows of the group stand before a row in `order`, each counted `copies` times; `size`: all of them.

    Rows are dealt out by ranges of (group, order), and a range counts on from the ones before it, so a
    group is never in one task. What is summed up per group is one row for each of its ranges.
    """
    ranged = rows.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id())
    ranged = settled(ranged, "manifest-ranges")
    within = W.partitionBy(group, "_range")
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranged.groupBy(group, "_range").agg(F.sum(copies).alias("_n"))
    ranges = ranges.select(
        group,
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(W.partitionBy(group)).alias("size"),
    )
    own = F.sum(copies).over(within.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - F.col(copies)
    counted = ranged.withColumn("_own", own).join(settled(ranges, "manifest-counts"), [group, "_range"])
    return counted.withColumn("first", F.col("_before") + F.col("_own")).drop("_range", "_own", "_before")


def lifted(nodes: DataFrame, fan: int) -> DataFrame:
    """The runs of a level's nodes (`tree`, `idx`, `size`, `h`), as nodes of the next level with their members' digests."""
    heads = nodes.filter(F.col("idx") % fan == 0)
    asked = heads.select(
        "tree", "size", F.col("idx").alias("head"), F.explode(F.sequence("idx", F.least(F.col("idx") + fan, "size") - 1)).alias("idx")
    )
    met = asked.join(nodes.select("tree", "idx", "h"), ["tree", "idx"])
    runs = met.groupBy("tree", "size", "head").agg(F.sort_array(F.collect_list(F.struct("idx", "h"))).alias("run"))
    hashes = F.col("run.h")
    return runs.select(
        "tree",
        (F.col("head") / fan).cast("long").alias("idx"),
        F.ceil(F.col("size") / fan).cast("long").alias("size"),
        F.unhex(F.sha2(F.array_join(F.transform(hashes, _hex), ""), 256)).alias("h"),
        hashes.alias("run"),
    )


def tree(leaves: DataFrame, fan: int) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, lowest first, and the root (`tree`, `h`) of each tree."""
    most = leaves.agg(F.max("size")).first()[0] or 0
    level, runs = leaves.select("tree", "idx", "size", "h"), []
    roots = level.filter("size = 1")
    while most > 1:
        level = settled(lifted(level.filter("size > 1"), fan), "manifest-level")
        runs.append(level)
        roots = roots.unionByName(level.filter("size = 1").select("tree", "idx", "size", "h"))
        most = -(-most // fan)
    return runs, roots.select("tree", "h")


def _sides(run: Column, slot: Column) -> Column:
    """The digests of a run before and after a slot, joined."""

    def joined(part: Column) -> Column:
        return F.aggregate(part, F.lit(b""), lambda all_, h: F.concat(all_, h))

    after = F.slice(run, slot + 2, F.size(run) - slot - 1)
    return F.struct(joined(F.slice(run, F.lit(1), slot)).alias("left"), joined(after).alias("right"))


def with_paths(leaves: DataFrame, runs: list[DataFrame], tops: DataFrame, fan: int) -> DataFrame:
    """`leaves` with `up`: what stands left and right of each node on the way up, and then `tops` (`tree`, `up`) of its root."""

    def above(nodes: DataFrame, parents: DataFrame | None) -> DataFrame:
        ended = nodes.filter("size = 1").join(tops, "tree")
        if parents is None:
            return ended
        slot = (F.col("idx") % fan).cast("int")
        up = F.concat(F.array(_sides(F.col("_run"), slot)), F.col("_up"))
        own = nodes.filter("size > 1").withColumn("_parent", (F.col("idx") / fan).cast("long"))
        joined = own.join(parents, ["tree", "_parent"]).withColumn("up", up)
        return joined.select(ended.columns).unionByName(ended)

    parents = None
    for level in reversed(runs):
        rows = above(level.select("tree", "idx", "size", "run"), parents)
        parents = rows.select("tree", F.col("idx").alias("_parent"), F.col("run").alias("_run"), F.col("up").alias("_up"))
        parents = settled(parents, "manifest-paths")
    return above(leaves, parents)


def folded(leaf: Column, up: Column) -> Column:
    """The root, as text, that a leaf and its path lead to."""
    return F.aggregate(
        up, _hex(leaf), lambda acc, s: F.sha2(F.concat(_hex(s["left"]), acc, _hex(s["right"])), 256)
    )


def leaves_of(docs: DataFrame, fields: dict[str, Column] | None = None) -> DataFrame:
    """(`tree`, `doc_id`, `leaf`, `other`, `idx`, `size`): every row's leaf and place in the tree of its language.

    `other` is the leaf of the row with `fields` changed. A tree's name is empty for a null language and starts
    with `=` else, so that names order as languages do, null first. Rows equal in all fields are counted
    before they are numbered.
    """
    lang = F.col("lang").cast("string")
    named = F.when(lang.isNull(), "").otherwise(F.concat(F.lit("="), lang))
    rows = docs.select(
        named.alias("tree"), "doc_id", leaf_digest().alias("leaf"), leaf_digest(**(fields or {})).alias("other")
    )
    rows = rows.groupBy("tree", "doc_id", "leaf", "other").agg(F.count(F.lit(1)).alias("copies"))
    counted = numbered(rows, "tree", ["doc_id", "leaf"], "copies")
    places = F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1))
    return settled(counted.select("tree", "doc_id", "leaf", "other", places.alias("idx"), "size"), "manifest-leaves")


def manifest(docs: DataFrame, fields: dict[str, Column] | None = None, fan: int = FAN) -> DataFrame:
    """`doc_id`, `leaf`, `other` (binary), `subroot`, `root` (text) and `up` of every row.

    `up` holds what stands left and right of the row's node at each level, so that `folded` leads to the root.
    """
    leaves = leaves_of(docs, fields)
    runs, subroots = tree(leaves.withColumn("h", F.col("leaf")), fan)
    subroots = settled(subroots, "manifest-subroots").withColumn("all", F.lit("")).withColumn("copies", F.lit(1))
    trunk = numbered(subroots, "all", ["tree"], "copies").select(
        F.col("all").alias("tree"), F.col("first").alias("idx"), "size", "h", F.col("tree").alias("_lang")
    )
    trunk = settled(trunk, "manifest-trunk")
    trunk_runs, roots = tree(trunk, fan)
    root = roots.first()
    spark = docs.sparkSession
    end = spark.range(1).select(F.lit("").alias("tree"), F.array().cast(SIDES).alias("up"))
    tops = with_paths(trunk, trunk_runs, end, fan)
    tops = settled(tops.select(F.col("_lang").alias("tree"), "up", _hex(F.col("h")).alias("subroot")), "manifest-tops")
    placed = with_paths(leaves, runs, tops.select("tree", "up"), fan)
    return placed.join(tops.select("tree", "subroot"), "tree").withColumn("root", _hex(F.lit(bytes(root["h"]) if root else None)))


def verified(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """`doc_id`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root`, `verified` for every row.

    The root is folded again from the row's own leaf, or, where 3 divides the CRC of the id, from that of the
    row with A-Z in its text lower-cased, and the untouched digests beside its path. A text without A-Z
    stays as it is and is verified.

    Rows of one language stand by doc_id, null ids first, then by leaf; equal rows side by side, each with
    its own proof. Null and empty values have leaves of their own, a null language a tree of its own. A
    tree with one row is its leaf; a table with one language has that subroot as its root. An empty table
    gives no rows. Further columns are not read.
    """
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    text = F.when(tampered, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))
    rows = manifest(docs, {"text": text}, fan)
    around = F.flatten(F.transform("up", lambda s: F.array(_hex(s["left"]), _hex(s["right"]))))
    found = rows.select(
        "doc_id",
        _hex(F.col("leaf")).alias("leaf"),
        "subroot",
        "root",
        F.sha2(F.array_join(around, ""), 256).alias("proof_sha256"),
        folded(F.col("other"), F.col("up")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _sql_leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(_sql_field(v) for v in values)})"


_LOWERED = f"translate(text, '{UPPER}', '{UPPER.lower()}')"

# CRC-32 of a decimal number, bit by bit: DuckDB has no such function.
_CRC = """
list_reduce(
  list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda crc, c: list_reduce(list_prepend(xor(crc, c), list_transform(range(8), lambda i: CAST(0 AS BIGINT))),
                          lambda b, i: CASE WHEN b % 2 = 1 THEN xor(b // 2, CAST(3988292384 AS BIGINT)) ELSE b // 2 END))
"""

ORACLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_sql_leaf("text")} AS leaf,
         CASE WHEN xor({_CRC}, CAST(4294967295 AS BIGINT)) % 3 = 0 THEN {_sql_leaf(_LOWERED)} ELSE {_sql_leaf("text")} END AS other
  FROM documents),
leaves AS (
  SELECT *, coalesce('=' || lang, '') AS tree, count(*) OVER (PARTITION BY lang) AS size,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM hashed),
nodes AS (
  SELECT tree, 0 AS level, idx, size, leaf AS h FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 8, (size + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM nodes WHERE size > 1 GROUP BY tree, level, idx // 8, size),
subroots AS (
  SELECT tree, h, count(*) OVER () AS size, row_number() OVER (ORDER BY tree) - 1 AS idx FROM nodes WHERE size = 1),
trunk AS (
  SELECT 0 AS level, idx, size, h FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, (size + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM trunk WHERE size > 1 GROUP BY level, idx // 8, size),
folds AS (
  SELECT tree, idx AS leaf_idx, 0 AS level, idx, size, other AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT f.tree, f.leaf_idx, f.level + 1, f.idx // 8, (f.size + 7) // 8,
         sha256(string_agg(CASE WHEN n.idx = f.idx THEN f.h ELSE n.h END, '' ORDER BY n.idx)),
         any_value(f.proof) || coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (n.idx <> f.idx), '')
  FROM folds f JOIN nodes n ON n.tree = f.tree AND n.level = f.level AND n.idx // 8 = f.idx // 8
  WHERE f.size > 1 GROUP BY f.tree, f.leaf_idx, f.level, f.idx, f.size),
upper_folds AS (
  SELECT f.tree, f.leaf_idx, 0 AS level, s.idx, s.size, f.h, f.proof FROM folds f JOIN subroots s ON s.tree = f.tree
  WHERE f.size = 1
  UNION ALL
  SELECT f.tree, f.leaf_idx, f.level + 1, f.idx // 8, (f.size + 7) // 8,
         sha256(string_agg(CASE WHEN n.idx = f.idx THEN f.h ELSE n.h END, '' ORDER BY n.idx)),
         any_value(f.proof) || coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (n.idx <> f.idx), '')
  FROM upper_folds f JOIN trunk n ON n.level = f.level AND n.idx // 8 = f.idx // 8
  WHERE f.size > 1 GROUP BY f.tree, f.leaf_idx, f.level, f.idx, f.size)
SELECT l.doc_id, l.leaf, s.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root,
       f.h = t.h AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN trunk t ON t.size = 1
JOIN upper_folds f ON f.tree = l.tree AND f.leaf_idx = l.idx AND f.size = 1
"""
