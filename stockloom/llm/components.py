"""Connected components of a table of links: trees of least neighbours, contracted until no link is left between two."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.plans.joins import settled


def components(links: DataFrame) -> DataFrame:
    """(`node`, `label`) for every node of (`a`, `b`): the least node of its component.

    Each round hooks a node onto its least neighbour and follows the hooks to their
    roots, so a chain of n hooks takes about log n steps. Then a link joins the roots of
    its two ends; links within one tree are dropped and equal ones become one, so a
    link is read again only while it still joins two trees. Every step is
    written, nothing is collected, and a node with very many links is only
    ever the one row that many rows look up.
    """
    edges, labels = settled(links.select("a", "b").distinct(), "edges"), None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
        trees = _rooted(settled(hooks.withColumn("label", F.least("node", "label")), "hooks"))
        if labels is None:
            labels = trees
        else:
            least = trees.select(F.col("node").alias("label"), F.col("label").alias("least"))
            labels = settled(
                labels.join(least, "label", "left").select("node", F.coalesce("least", "label").alias("label")), "labels"
            )
        ends = [trees.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b")]
        edges = edges.join(ends[0], "a").join(ends[1], "b").filter("la <> lb")
        edges = edges.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
        edges = settled(edges.distinct(), "edges")
        if edges.isEmpty():
            return labels


def _rooted(hooks: DataFrame) -> DataFrame:
    """(`node`, `label`) with each node's label followed up to the node that is its own."""
    while True:
        far = hooks.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = settled(hooks.join(far, "label").select("node", "label", "far"), "hooks")
        if step.filter("far <> label").isEmpty():
            return step.select("node", "label")
        hooks = step.select("node", F.col("far").alias("label"))


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(`node`, `label`) after further links: only the labels that these join are worked on."""
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    if labels is None:
        return components(links)
    ends = [labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b")]
    joined = links.join(ends[0], "a", "left").join(ends[1], "b", "left")
    joined = joined.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).filter("a <> b")
    joined = settled(joined.distinct(), "label-links")
    if joined.isEmpty():
        return labels
    least = components(joined).select(F.col("node").alias("label"), F.col("label").alias("least"))
    every = labels.unionByName(
        nodes.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    )
    return settled(
        every.join(least, "label", "left").select("node", F.coalesce("least", "label").alias("label")), "labels"
    )
