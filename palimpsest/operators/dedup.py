"""Keeping one of equal things: contents, copies of files, roots, packs, signatures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import cut


def originals(rows: DataFrame, content: list[str], order: list[str]) -> DataFrame:
    """The first occurrence of each content, with the number of occurrences. Partial aggregates: hot contents cost one row a task."""
    return rows.groupBy(*content).agg(F.min(F.struct(*order)).alias("_o"), F.count("*").alias("copies")).select(*content, "_o.*", "copies")


def duplicates(rows: DataFrame, content: str, vendored: Column) -> DataFrame:
    """Contents by band of copies: 1, 2-10, 11-100, over 100; vendored only if every copy is."""
    per = rows.groupBy(content).agg(F.count("*").alias("copies"), F.bool_and(vendored).alias("vendored"), F.max("bytes").alias("bytes"))
    band = F.when(F.col("copies") == 1, "1").when(F.col("copies") <= 10, "2-10").when(F.col("copies") <= 100, "11-100").otherwise(">100")
    return per.groupBy(band.alias("band"), "vendored").agg(
        F.count("*").alias("contents"), F.sum("copies").alias("files"), F.sum(F.col("bytes") * (F.col("copies") - 1)).alias("spare_bytes")
    )


def pack_coverage(packs: DataFrame, pack: str = "pack", obj: str = "object", size: str = "bytes") -> DataFrame:
    """Largest pack first: how many of a pack's objects no larger pack holds, and which pack covers most of the others.

    An object belongs to the largest pack that has it; equal sizes go to the smaller name.
    """
    members = packs.groupBy(pack, obj).agg(F.sum(size).alias("_b"))
    sizes = members.groupBy(pack).agg(F.sum("_b").alias("pack_bytes"), F.count("*").alias("objects"))
    ranked = cut(members.join(sizes, pack))  # read for the owners, and again with them
    owners = ranked.groupBy(obj).agg(F.max(F.struct("pack_bytes", (-F.col(pack)).alias("_m"))).alias("_o")).select(obj, (-F.col("_o._m")).alias("owner"))
    per = ranked.join(owners, obj).groupBy(pack, "pack_bytes", "objects", "owner").agg(F.count("*").alias("n"))
    best = F.max(F.when(F.col("owner") != F.col(pack), F.struct("n", (-F.col("owner")).alias("m"))))
    return per.groupBy(pack, "pack_bytes", "objects").agg(
        F.coalesce(F.sum(F.when(F.col("owner") == F.col(pack), F.col("n"))), F.lit(0)).alias("new_objects"), best.alias("_b")
    ).select(
        pack, "pack_bytes", "objects", "new_objects", (-F.col("_b.m")).alias("best_match"),
        F.round(100.0 * (F.col("objects") - F.col("new_objects")) / F.col("objects"), 2).alias("pct_covered"),
    )


def winner_roots(rows: DataFrame, repo: str, root: str, preferred: list[str]) -> DataFrame:
    """The root of each repository with most rows; ties by preference, then by name."""
    counts = rows.groupBy(repo, root).agg(F.count("*").alias("rows"))
    rank = F.coalesce(*[F.when(F.col(root) == p, i) for i, p in enumerate(preferred)], F.lit(len(preferred)))
    best = Window.partitionBy(repo).orderBy(F.desc("rows"), rank, root)
    return counts.withColumn("_rn", F.row_number().over(best)).where("_rn = 1").drop("_rn")


def root_dedup(rows: DataFrame, winners: DataFrame, repo: str, root: str, path: str, order: str) -> DataFrame:
    """Rows as kept, duplicate (the winner has the path), loser_only, or same_root_duplicate."""
    win = winners.select(repo, F.col(root).alias("_win"))
    tagged = rows.join(win, repo).withColumn("_own", F.col(root) == F.col("_win"))
    nth = F.row_number().over(Window.partitionBy(repo, path, "_own", root).orderBy(order))
    has = F.max(F.when(F.col("_own"), 1).otherwise(0)).over(Window.partitionBy(repo, path)) == 1
    status = F.when(nth > 1, "same_root_duplicate").when(F.col("_own"), "kept").when(has, "duplicate").otherwise("loser_only")
    return tagged.withColumn("status", status).drop("_win", "_own")


def signatures(rows: DataFrame, key: list[str], content: str, within: list[str], order: str) -> DataFrame:
    """Paths with equal sets of contents, by a hash of the sorted set: one is kept within each ``within``."""
    sets = rows.select(*key, content).distinct().groupBy(*key).agg(F.sort_array(F.collect_list(content)).alias("_s"))
    sets = sets.select(*key, F.sha2(F.array_join("_s", "|"), 256).alias("signature"), F.size("_s").cast("long").alias("contents"))
    nth = F.row_number().over(Window.partitionBy(*within, "signature").orderBy(order, *key))
    return sets.withColumn("kept", nth == 1)


def one_root_delta(rows: DataFrame, ext: str, repo: str, content: str) -> DataFrame:
    """Per repository: distinct contents, those in no other repository, and those whose first repository it is."""
    per = rows.groupBy(ext, repo, content).agg(F.max("bytes").alias("bytes"))
    all_ = per.groupBy(ext, content).agg(F.count("*").alias("_repos"), F.min(repo).alias("_first"))
    joined = per.join(all_, [ext, content])
    return joined.groupBy(repo).agg(
        F.count("*").alias("contents"), F.count_if(F.col("_repos") == 1).alias("only_here"), F.count_if(F.col("_first") == F.col(repo)).alias("original"), F.sum("bytes").alias("bytes")
    )


def case_twins(rows: DataFrame, unit: str, rel: str) -> DataFrame:
    """Files whose names differ only by case, numbered; 1 keeps its name."""
    w = Window.partitionBy(unit, F.lower(rel)).orderBy(rel)
    distinct = rows.select(unit, rel).distinct()
    return distinct.withColumns({"n": F.row_number().over(w), "twins": F.count("*").over(Window.partitionBy(unit, F.lower(rel)))})
