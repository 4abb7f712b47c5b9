"""Boilerplate lines by their spread over sites, in DataFrame functions only.

Every line's sites go into a HyperLogLog sketch, merged map-side by aggregation,
so a line on a third of all pages costs one sketch per task. A sketch decides
alone where its estimate is clear of the threshold by `BAND`, six times the
standard error and more; lines nearer to it are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.plans.joins import settled

SITES = 10  # a line on so many sites is boilerplate
LG_K = 12  # 4096 registers: standard error 1.04 / 64 = 1.6 %
BAND = 0.1


def _lines() -> Column:
    return F.split(F.coalesce("text", F.lit("")), "\n", -1)


def lines_of(docs: DataFrame, site: Column) -> DataFrame:
    """(`doc`, `text_key`, `pos`, `line`, `line2`, `site`) of every line that is not blank; 128 bits stand for a line."""
    text_key = F.xxhash64("text")
    return (
        docs.select(F.col("doc_id").alias("doc"), text_key.alias("text_key"), F.xxhash64(site).alias("site"), F.posexplode(_lines()).alias("pos", "l"))
        .filter(F.trim("l") != "")
        .select("doc", "text_key", "pos", F.xxhash64("l").alias("line"), F.xxhash64(F.lit("2"), "l").alias("line2"), "site")
    )


def spread_lines(lines: DataFrame, sites: int = SITES, lg_k: int = LG_K, band: float = BAND) -> DataFrame:
    """(`line`, `line2`) of every line found on at least `sites` distinct sites."""
    sketches = settled(
        lines.groupBy("line", "line2")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("estimate"))
        .filter(F.col("estimate") >= min(sites * (1 - band), sites - 1)),
        "line-sketches",
    )
    clear = F.col("estimate") > max(sites * (1 + band), sites + 1)
    near = lines.join(sketches.filter(~clear), ["line", "line2"], "left_semi")
    exact = near.select("line", "line2", "site").distinct()  # spreads a hot line by its sites
    counted = exact.groupBy("line", "line2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= sites)
    return sketches.filter(clear).select("line", "line2").unionByName(counted.select("line", "line2"))


def remove_spread_lines(docs: DataFrame, site: Column, sites: int = SITES) -> DataFrame:
    """`doc_id`, `text` (without boilerplate), `n_lines`, `n_removed` for every document.

    Lines end at a newline and are equal when their text is; blank lines are never
    boilerplate. A null site is a site of its own. A null text has no lines and
    stays null. Rows repeated are judged alike, null ids included. An empty table
    gives no rows. Extra columns are not read.
    """
    lines = settled(lines_of(docs, site), "lines")
    spread = settled(spread_lines(lines, sites), "spread-lines")
    gone = (
        lines.join(spread, ["line", "line2"], "left_semi")
        .groupBy("doc", "text_key")
        .agg(F.collect_set("pos").alias("gone"))
    )
    numbered = F.transform(_lines(), lambda line, i: F.struct(i.alias("i"), line.alias("line")))
    left = F.filter(numbered, lambda x: ~F.array_contains("gone", x["i"]))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left["line"], "\n"))
    rows = docs.select("doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    same = rows["doc_id"].eqNullSafe(gone["doc"]) & (rows["text_key"] == gone["text_key"])
    return rows.join(gone, same, "left").select(
        "doc_id",
        text.alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines())).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


ORACLE = """
WITH lines AS (
  SELECT row, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM (SELECT row_number() OVER () AS row, * FROM documents)
), spread AS (
  SELECT line FROM lines WHERE trim(line) <> ''
  GROUP BY line HAVING count(DISTINCT coalesce('s' || source, '')) >= 10
), kept AS (
  SELECT row, count(*) AS n_lines, count(s.line) AS n_removed,
         string_agg(l.line, chr(10) ORDER BY pos) FILTER (s.line IS NULL) AS text
  FROM lines l LEFT JOIN spread s ON s.line = l.line GROUP BY row
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM (SELECT row_number() OVER () AS row, * FROM documents) d LEFT JOIN kept k USING (row)
"""
