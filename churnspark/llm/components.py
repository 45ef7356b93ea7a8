"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(low, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(low, "u")
    return (linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))))


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and no larger end is a smaller one elsewhere."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
        "up > 1 OR (up > 0 AND down > 0)").isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; the root is the smallest node reachable.

    Loops and repeated edges are ignored, null ends are refused by the inner joins. Each round
    is written to the shared folder; the loop ends when only stars are left, after about log(n)
    rounds. A hub's edges are only joined with its minimum, which AQE may split.
    """
    clean = edges.select("u", "v").where("u <> v")
    now = stored(clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), name)
    while not _stars(now):
        now = stored(_small_star(_large_star(now)).where("u <> v").distinct(), name)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def merged(roots: DataFrame | None, links: DataFrame, name: str = "roots") -> DataFrame:
    """(node, root) after ``links(u, v)`` join the components of ``roots``.

    Only links between different components are followed, each component being one node; so a few
    links cost a few rounds over a few rows. Roots are names here, not always the smallest node.
    """
    if roots is None:
        return stored(components(stored(links, name)), name)
    ends = stored(
        links.join(roots.toDF("u", "root_u"), "u", "left")
        .join(roots.toDF("v", "root_v"), "v", "left")
        .select(F.coalesce("root_u", "u").alias("u"), F.coalesce("root_v", "v").alias("v"))
        .where("u <> v"), name)
    if ends.isEmpty():
        return roots
    above = stored(components(ends), name)
    known = (roots.join(above.toDF("root", "top"), "root", "left")
             .select("node", F.coalesce("top", "root").alias("root")))
    return stored(known.union(above.join(roots.select("node"), "node", "left_anti")), name)
