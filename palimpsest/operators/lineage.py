"""Graphs of commits and renames: reachability, lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut


def reachable(tips: DataFrame, edges: DataFrame, node: str, parent: str, position: str | None = None) -> DataFrame:
    """Nodes that the tips reach over edges, tips included: a row each.

    ``position`` tells a node's first parent from others (the smallest one is the first; without it the parent's name decides).
    Two nodes joined over pointers that double in length: of each node the first parent's 2^k-th ancestor is kept, one
    row a node, so whole chains of first parents are marked in as many rounds as the logarithm of the longest one. Edges to
    other parents begin chains of their own: rounds over them go on until no node is new. Rows are at most nodes
    times the rounds of doubling, never the transitive closure. Lineage is cut by tables in the shared folder.
    """
    at = F.col(position) if position else F.lit(0)
    pairs = edges.select(F.col(node).alias("_a"), F.col(parent).alias("_b"), at.alias("_at")).where("_a IS NOT NULL AND _b IS NOT NULL")
    pairs = cut(pairs.groupBy("_a", "_b").agg(F.min("_at").alias("_at")))
    levels = [cut(pairs.groupBy("_a").agg(F.min(F.struct("_at", "_b"))["_b"].alias("_b")))]
    pairs = pairs.drop("_at")
    while True:
        jump = levels[-1]
        ahead = jump.select(F.col("_a").alias("_b"), F.col("_b").alias("_c"))
        further = cut(jump.join(ahead, "_b").select("_a", F.col("_c").alias("_b")))
        if further.isEmpty():
            break
        levels.append(further)
        if len(levels) > 40:  # longer than any chain: the edges have a cycle
            break
    seen = cut(tips.select(node).where(F.col(node).isNotNull()).distinct())
    fresh = seen
    while not fresh.isEmpty():
        # From the longest pointers to the shortest, all ancestors over first parents are marked.
        chain = fresh
        for jump in reversed(levels):
            step = chain.join(jump, chain[node] == jump["_a"]).select(F.col("_b").alias(node))
            chain = chain.unionByName(step).distinct()
        chain = cut(chain)
        others = chain.join(pairs, chain[node] == pairs["_a"]).select(F.col("_b").alias(node))
        both = chain.unionByName(others).distinct()
        fresh = cut(both.join(seen, node, "left_anti"))
        begin = others.distinct().join(chain, node, "left_anti").join(seen, node, "left_anti")
        begin = cut(begin)
        seen = cut(seen.unionByName(fresh))
        fresh = begin
    return seen


def current_names(renames: DataFrame, old: str = "old", new: str = "new", order: str = "ord") -> DataFrame:
    """The last name of every renamed path: (old, ord) to name, following later renames only.

    Each rename points to the next rename of its new name; pointers are doubled until they are at the end.
    """
    from pyspark.sql.window import Window

    rows = renames.select(F.col(old).alias("old"), F.col(new).alias("new"), F.col(order).alias("ord"))
    starts = rows.select(F.col("old").alias("name"), "ord", F.lit(1).alias("k"), "new").unionByName(rows.select(F.col("new").alias("name"), "ord", F.lit(0).alias("k"), "new"))
    # The next rename away from a name after it was taken: order by (ord, k), look ahead for the first k = 1.
    ahead = Window.partitionBy("name").orderBy("ord", "k").rowsBetween(1, Window.unboundedFollowing)
    nexts = starts.withColumn("next", F.min(F.when(F.col("k") == 1, F.col("ord"))).over(ahead)).where("k = 0")
    link = rows.join(nexts.select("ord", F.col("name").alias("new"), "next"), ["ord", "new"], "left").select("old", "ord", "new", "next")
    link = cut(link)
    while link.where("next IS NOT NULL").count():
        later = link.select(F.col("ord").alias("next"), F.col("old").alias("new"), F.col("new").alias("_n"), F.col("next").alias("_x"))
        link = cut(link.join(later, ["next", "new"], "left").select("old", "ord", F.coalesce("_n", "new").alias("new"), F.col("_x").alias("next")))
    return link.select("old", "ord", F.col("new").alias("name"))
