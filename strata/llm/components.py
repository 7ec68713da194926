"""Connected components of a link table, by alternating large-star and
small-star steps: every round joins the links with each node's least
neighbour, so paths shorten by about half and hubs never gather their
neighbours in one task (the least neighbour is a map-side minimum, the join
is one that Spark can split). Each round is written to the shared folder; a
count by node tells when every node points to its root, so no round is run
only to see that nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("least"))


def _round(links: DataFrame) -> DataFrame:
    """``links``: distinct (u, v) with u > v."""
    both = links.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low = _least(large)
    small = large.join(low, "u")
    # the least neighbour gives the node's own link, each other one points to it
    return small.select(F.when(F.col("v") == F.col("least"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("least").alias("v")).distinct()


def _settled(links: DataFrame) -> bool:
    """Does every node have one link, to a node that has none?"""
    ends = links.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("out")), F.struct(F.col("v").alias("node"), F.lit(0).alias("out")))))
    each = ends.groupBy("node").agg(F.sum("out").alias("out"), F.min("out").alias("aim"))
    return each.where((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("aim") == 0))).isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link to another one; the root is
    the least node of its component."""
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = staged(links.where(F.col(a) != F.col(b)).select(u, v).distinct(), "links")
    while not _settled(now):
        now = staged(_round(now), "links")
    # at the end every node points to its root and roots point nowhere
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())


def with_root(rows: DataFrame, root: DataFrame, node: str) -> DataFrame:
    """``rows`` with the ``root`` of ``node``: itself where it has no link."""
    names = root.select(F.col("node").alias("__n"), "root")
    return rows.join(names, rows[node] == names["__n"], "left").withColumn("root", F.coalesce("root", node)).drop("__n")


def grown(root: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The components of ``root`` (as :func:`components` gives them) joined
    by further ``links``: only links between different ones are looked at,
    and only their roots take part in the rounds."""
    ends = with_root(links.select(F.col(a).alias("x"), F.col(b).alias("y")), root, "x").select(F.col("root").alias("a"), "y")
    over = components(with_root(ends, root, "y").select("a", F.col("root").alias("b")))
    low, up = root.select("node", F.col("root").alias("__r")), over.select(F.col("node").alias("__m"), "root")
    moved = low.join(up, low["__r"] == up["__m"], "left").select("node", F.coalesce("root", "__r").alias("root"))
    new = over.join(root.select("node"), "node", "left_anti").select("node", "root")
    return staged(moved.union(new), "roots")
