"""Values over a graph without cycles: each node's value follows from those of its parents, however long the paths are.

An edge carries how a child's value follows from a parent's; a node combines what its edges give. What a node has from the source is
kept apart. Nodes with at most one parent besides are taken out: their pointers are doubled until they lead to a node that stays, or
to the source, and their children's edges are redirected there; edges that then run side by side are combined. So chains go at once,
however long, also those that are merged into again and again from something known, and a branch that is merged back becomes one
edge. Rounds are counted by merges of unknown with unknown that lie behind one another, not by commits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, dealt, numbered

#: Nodes up to which Spark may choose how a table is joined; larger ones never go whole through the driver.
FEW = 50_000


@dataclass
class Weight:
    """A column of an edge: how it goes on along two edges, and how edges side by side are combined, as an aggregate and of two.

    ``along`` gets the weights of the edge nearer to the source and of the further one, as functions from names to columns. It has to
    give the same before and after combining: what a node adds to a sum by itself is an edge from the source, not a part of another edge.
    """

    name: str
    along: Callable[[Callable[[str], Column], Callable[[str], Column]], Column]
    beside: Callable[[Column], Column]
    either: Callable[[Column, Column], Column]


def values(edges: DataFrame, weights: list[Weight]) -> DataFrame:
    """(node, weights): what each node has from the source, over all paths.

    ``edges`` are node, parent and the weights; a null parent is the source, whose edge gives a node's value alone. Every node needs
    an edge. Nodes on a cycle, or behind one, get no row. All tables have at most two rows for each edge.
    """
    names = [w.name for w in weights]
    packed = lambda cols: F.struct(*[c.alias(n) for c, n in zip(cols, names, strict=True)])
    along = lambda near, far: F.when(F.col(near).isNotNull(), packed([w.along(lambda c: F.col(near)[c], lambda c: F.col(far)[c]) for w in weights]))

    def either(a: Column, b: Column) -> Column:
        both = packed([w.either(a[w.name], b[w.name]) for w in weights])
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)

    def combined(rows: DataFrame) -> DataFrame:
        return cut(rows.groupBy("node", "parent").agg(packed([w.beside(F.col("w")[w.name]) for w in weights]).alias("w")))

    spread = lambda df, rows: dealt(df) if rows > FEW else df
    # Rows without a parent, in the end all of them, are dealt out by their node, not as one null key.
    meets = (F.coalesce("parent", "node") == F.col("_n")) & F.col("parent").isNotNull()
    upper = lambda df: df.select(F.col("node").alias("_n"), F.col("parent").alias("_p"), F.col("c").alias("_c"), F.col("w").alias("_w"))
    left = combined(edges.select("node", "parent", packed([F.col(n) for n in names]).alias("w")))
    gone: list[tuple[DataFrame, int]] = []
    while True:
        # c: from the source; w: from the one parent.
        own = left.groupBy("node").agg(
            F.count("parent").alias("_k"), F.max("parent").alias("parent"),
            *[F.first(F.when(F.col("parent").isNull() == known, F.col("w")), ignorenulls=True).alias(c) for known, c in ((True, "c"), (False, "w"))],
        )
        single = cut(own.where("_k < 2").drop("_k"))
        # As many doublings as the longest chain of so many nodes needs.
        n = single.count()
        for _ in range(n.bit_length() + 1):
            met = single.join(spread(upper(single), n), meets, "left")
            there = F.col("_n").isNotNull()
            met = met.select("node", F.when(there, F.col("_p")).otherwise(F.col("parent")).alias("parent"), F.when(there, either(F.col("c"), along("_c", "w"))).otherwise(F.col("c")).alias("c"), F.when(there, along("_w", "w")).otherwise(F.col("w")).alias("w"), there.alias("_moved"))
            moved = cut(met)
            single = moved.drop("_moved")
            if moved.where("_moved AND parent IS NOT NULL").isEmpty():
                break
        else:  # what still leads to a single node is on a cycle, or behind one
            single = cut(single.join(spread(single.select(F.col("node").alias("parent")), n), "parent", "left_anti").select("node", "parent", "c", "w"))
        if single.isEmpty():
            break
        gone.append((single, n))
        rest = left.join(spread(single, n), "node", "left_anti").join(spread(upper(single), n), meets, "left")
        staying = rest.where("_n IS NULL").select("node", "parent", "w")
        above = rest.where("_p IS NOT NULL").select("node", F.col("_p").alias("parent"), along("_w", "w").alias("w"))
        known = rest.where("_c IS NOT NULL").select("node", F.lit(None).cast(left.schema["parent"].dataType).alias("parent"), along("_c", "w").alias("w"))
        left = combined(staying.unionByName(above).unionByName(known))
    # Back from the last nodes taken out: what they lead to has its value by then.
    out, total = None, 0
    for single, n in reversed(gone):
        found = single.where("parent IS NULL").select("node", F.col("c").alias("v"))
        if out is not None:
            met = single.join(spread(out.select(F.col("node").alias("_n"), F.col("v").alias("_v")), max(n, total)), F.col("parent") == F.col("_n"))
            found = found.unionByName(met.select("node", either(F.col("c"), along("_v", "w")).alias("v"))).unionByName(out)
        out, total = cut(found), total + n
    out = out if out is not None else left.select("node", F.col("w").alias("v")).limit(0)
    return out.select("node", *[F.col("v")[n].alias(n) for n in names])


def _parents(commits: DataFrame, edges: DataFrame, node: str, parent: str) -> tuple[DataFrame, DataFrame]:
    """The distinct commits, and their edges to parents that are there."""
    nodes = commits.select(F.col(node).alias("node")).where("node IS NOT NULL").distinct()
    pairs = edges.select(F.col(node).alias("node"), F.col(parent).alias("parent")).where("parent IS NOT NULL").distinct()
    pairs = pairs.join(dealt(nodes), "node", "left_semi").join(dealt(nodes.withColumnRenamed("node", "parent")), "parent", "left_semi")
    return nodes, pairs.select("node", "parent")


def generations(commits: DataFrame, edges: DataFrame, node: str = "commit", parent: str = "parent") -> DataFrame:
    """(node, generation): edges on the longest way to a commit without parents. Parents that are not there do not count."""
    nodes, pairs = _parents(commits, edges, node, parent)
    roots = nodes.join(dealt(pairs), "node", "left_anti").select("node", F.lit(None).cast(pairs.schema["parent"].dataType).alias("parent"), F.lit(0).cast("long").alias("generation"))
    longest = Weight("generation", lambda near, far: near("generation") + far("generation"), F.max, F.greatest)
    rows = values(roots.unionByName(pairs.withColumn("generation", F.lit(1).cast("long"))), [longest])
    return rows.withColumnRenamed("node", node)


def commit_order(commits: DataFrame, edges: DataFrame, unit: list[str], date: str, node: str = "commit", parent: str = "parent") -> DataFrame:
    """The commits with ``ord``, from 1 in each unit: every parent before its children; among commits that are free to choose the
    generation, then the date, then the name decide. Commits on a cycle get no row. No unit is sorted in one task.
    """
    rows = commits.dropDuplicates([node]).join(dealt(generations(commits, edges, node, parent)), node)
    return numbered(rows, unit, [F.col("generation").asc(), F.col(date).asc(), F.col(node).asc()], "ord").drop("generation")


#: Tips in a word of a bitmap, and words that go over the graph at once.
BITS, WORDS = 64, 16


def tip_numbers(tips: DataFrame, unit: list[str], name: str) -> DataFrame:
    """The tips with ``tip``: their number from 0 in their unit, by name."""
    return numbered(tips, unit, [F.col(name).asc()], "_n").withColumn("tip", F.col("_n") - 1).drop("_n")


def bit(number: Column, word: int) -> Column:
    """A word of a bitmap in which only this number is set."""
    return F.when(F.floor(number / BITS) == word, F.call_function("shiftleft", F.lit(1).cast("long"), (number % BITS).cast("int"))).otherwise(F.lit(0).cast("long"))


def n_set(bitmap: Column) -> Column:
    """How many numbers are in a bitmap."""
    return F.aggregate(bitmap, F.lit(0).cast("long"), lambda a, w: a + F.bit_count(w))


def members(bitmap: Column) -> Column:
    """The numbers in a bitmap, in order."""
    numbers = F.transform(bitmap, lambda w, i: F.transform(F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.call_function("shiftrightunsigned", w, b).bitwiseAND(F.lit(1).cast("long")) == 1), lambda b: b + i * BITS))
    return F.flatten(numbers)


def has(bitmap: Column, number: Column) -> Column:
    """Whether a number is in a bitmap."""
    word = F.coalesce(F.get(bitmap, F.floor(number / BITS).cast("int")), F.lit(0).cast("long"))
    return F.call_function("shiftrightunsigned", word, (number % BITS).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def named(state: DataFrame, tips: DataFrame, unit: list[str], path: list[str], name: str) -> DataFrame:
    """(path, tips, names): how many tips each bitmap has and their names in the tips' order, of ``tips`` with the unit, tip and name. Bitmaps of a path are joined.

    A bitmap meets its tips by words, so a row holds at most BITS names, and no row is expanded for each tip.
    """
    bits = tips.groupBy(*unit, F.floor(F.col("tip") / BITS).cast("int").alias("_i")).agg(F.sort_array(F.collect_list(F.struct((F.col("tip") % BITS).cast("int").alias("b"), F.col(name).alias("n")))).alias("_names"))
    words = state.select(*path, F.posexplode("bitmap").alias("_i", "_w")).where("_w <> 0").groupBy(*path, "_i").agg(F.bit_or("_w").alias("_w")).join(dealt(bits), [*unit, "_i"])
    held = F.transform(F.filter("_names", lambda t: F.call_function("shiftrightunsigned", F.col("_w"), t["b"]).bitwiseAND(F.lit(1).cast("long")) == 1), lambda t: t["n"])
    words = words.select(*path, "_i", held.alias("_held"))
    names = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_held"))), lambda x: x["_held"]))
    return words.groupBy(*path).agg(names.alias("names")).select(*path, F.size("names").cast("long").alias("tips"), "names")


def tips_of_commits(commits: DataFrame, edges: DataFrame, tips: DataFrame, node: str = "commit", parent: str = "parent", number: str = "tip") -> DataFrame:
    """(commit, bitmap): which tips reach each commit, themselves included, as an array of longs with BITS tips each: a row a commit.

    ``tips`` are commits with their numbers from 0. Bitmaps go from children to parents as columns, WORDS of them at a time, so any number of
    tips may be there. Commits that no tip reaches have zeros.
    """
    nodes, pairs = _parents(commits, edges, node, parent)
    most = tips.agg(F.max(number)).first()[0]
    words = 1 + (most if most is not None else 0) // BITS
    out = None
    for first in range(0, words, WORDS):
        names = [f"w{k}" for k in range(first, min(words, first + WORDS))]
        own = tips.groupBy(F.col(node).alias("node")).agg(*[F.bit_or(bit(F.col(number), int(c[1:]))).alias(c) for c in names])
        own = nodes.join(dealt(own), "node", "left").na.fill(0, names)
        ends = own.join(dealt(pairs.select(F.col("parent").alias("node"))), "node", "left_anti").withColumn("parent", F.lit(None).cast(pairs.schema["node"].dataType))
        down = pairs.select(F.col("parent").alias("node"), F.col("node").alias("parent")).join(dealt(own), "node")
        either = [Weight(c, lambda near, far, c=c: near(c).bitwiseOR(far(c)), F.bit_or, Column.bitwiseOR) for c in names]
        part = values(ends.select("node", "parent", *names).unionByName(down.select("node", "parent", *names)), either)
        out = part if out is None else out.join(dealt(part), "node")
    return out.select(F.col("node").alias(node), F.array(*[F.col(f"w{k}") for k in range(words)]).alias("bitmap"))


def state_at_tips(changes: DataFrame, path: list[str], order: str, bitmap: str = "bitmap", status: str = "status", keep: list[str] | None = None) -> DataFrame:
    """Of each path the changes that some tip still shows: the columns of ``path`` and ``keep``, and the bitmap of those tips.

    Every change has the bitmap of the tips that reach its commit. A later change hides an earlier one from the tips that both have; a
    deletion shows nothing. ``order`` is that of commits, parents first; a struct, as (generation, date, name), orders them as numbers do.
    Windows are by path.
    """
    words = changes.agg(F.max(F.size(bitmap))).first()[0] or 0
    later = Window.partitionBy(*path).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    seen = [F.col(bitmap)[k].bitwiseAND(F.bitwise_not(F.coalesce(F.bit_or(F.col(bitmap)[k]).over(later), F.lit(0).cast("long")))).alias(f"_w{k}") for k in range(words)]
    rows = changes.select(*path, *(keep or []), F.col(status).alias("_status"), *seen).where("_status <> 'D'")
    rows = rows.select(*path, *(keep or []), (F.array(*[F.col(f"_w{k}") for k in range(words)]) if words else F.array().cast("array<bigint>")).alias("bitmap"))
    return rows.where(n_set(F.col("bitmap")) > 0)


def only_at_tips(state: DataFrame, ever: DataFrame, path: list[str]) -> DataFrame:
    """The paths that tips show and that the default branch never had: its own tip's paths and all that it ever added are ``ever``."""
    return state.join(dealt(ever.select(*path).distinct()), path, "left_anti")
