"""Names on a share that tells neither cases apart nor takes every character."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.paths import case_name

from .shared import cut


def share_safe(path: Column) -> Column:
    """Each part of a path without what a share refuses: an underscore for each such character, and for dots and spaces at a part's end."""
    safe = F.regexp_replace(path, r'[\\:*?"<>|\x00-\x1f]', "_")
    # One at a time from the end of a part: a trailing character has only trailing ones behind it.
    return F.regexp_replace(safe, r"[ .](?=[ .]*(?:/|\z))", "_")


def _folders(path: str) -> Column:
    """All folders above a path."""
    parts = F.split(path, "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return F.when(F.size(parts) > 1, above).otherwise(F.array().cast("array<string>"))


def keep_apart(rows: DataFrame, unit: str, rel: str, existing: DataFrame | None = None, fixed: DataFrame | None = None) -> DataFrame:
    """(unit, rel, name): paths that are equal but for case, or that another path has as a folder, get __case<n> names; the first sorted keeps its own.

    ``existing`` (unit, rel): paths that are there already: they keep their names, and others of their case do not get them. ``fixed`` (unit, rel,
    name): names of an earlier plan, kept. The result is that of going through the paths in order, each taking its first free name. It is found by
    rounds: each path asks for a name, of those that ask for one the first in order holds it, others go on to their next one; paths of one case
    form a line in which nobody asks for an earlier name than one before. A round is a few joins; rounds end when no two ask for the same name.
    Null paths are left out.
    """
    src = rows.select(F.col(unit).alias("unit"), F.col(rel).alias("rel")).where("rel IS NOT NULL").distinct()
    there = existing.select(F.col(unit).alias("unit"), F.col(rel).alias("rel")).distinct() if existing is not None else src.limit(0)
    plan = fixed.select(F.col(unit).alias("unit"), F.col(rel).alias("rel"), F.col("name").alias("_fixed")).dropDuplicates(["unit", "rel"]) if fixed is not None else src.limit(0).withColumn("_fixed", F.lit(None).cast("string"))
    folders = src.unionByName(there).select("unit", F.explode(_folders("rel")).alias("low"))
    taken = folders.unionByName(there.select("unit", F.col("rel").alias("low"))).unionByName(plan.select("unit", F.col("_fixed").alias("low")))
    taken = cut(taken.select("unit", F.lower("low").alias("low")).distinct())
    known = src.join(plan, ["unit", "rel"], "left").join(there.withColumn("_there", F.lit(True)), ["unit", "rel"], "left")
    known = cut(known.withColumn("name", F.coalesce("_fixed", F.when(F.col("_there"), F.col("rel")))))
    line = Window.partitionBy("unit", "case").orderBy("rel")
    asks = known.where("name IS NULL").select("unit", "rel", F.lower("rel").alias("case"))
    asks = asks.withColumn("place", F.row_number().over(line)).withColumn("n", F.col("place"))
    while True:
        asks = cut(asks.withColumn("name", case_name(F.col("rel"), F.col("n"))).withColumn("low", F.lower("name")))
        first = asks.groupBy("unit", "low").agg(F.min("rel").alias("_first"))
        met = asks.join(first, ["unit", "low"]).join(taken.withColumn("_taken", F.lit(True)), ["unit", "low"], "left")
        met = cut(met.withColumn("_on", F.coalesce("_taken", F.lit(False)) | (F.col("rel") != F.col("_first"))))
        if met.where("_on").isEmpty():
            break
        want = F.when(F.col("_on"), F.col("n") + 1).otherwise(F.col("n"))
        # Nobody asks for an earlier name than one before in the line.
        ahead = F.max(want - F.col("place")).over(line.rowsBetween(Window.unboundedPreceding, 0))
        asks = met.select("unit", "rel", "case", "place", (ahead + F.col("place")).cast("int").alias("n"))
    out = known.where("name IS NOT NULL").select("unit", "rel", "name").unionByName(asks.select("unit", "rel", "name"))
    return out.select(F.col("unit").alias(unit), F.col("rel").alias(rel), "name")
