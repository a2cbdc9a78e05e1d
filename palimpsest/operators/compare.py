"""Comparing two inventories, trees or object stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key, the last in order, with how many there were. Partial aggregates: a hot key costs one row a task."""
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"), F.count("*").alias("copies"))
    return last.select(*[c if c in keys else F.col("_r")[c].alias(c) for c in rows.columns], "copies")


def path_lens(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Every key of both sides: identical, changed, only_a or only_b."""
    left = a.select(*keys, F.col(value).alias("value_a"))
    right = b.select(*keys, F.col(value).alias("value_b"))
    status = (
        F.when(F.col("value_b").isNull(), "only_a").when(F.col("value_a").isNull(), "only_b").when(F.col("value_a") == F.col("value_b"), "identical").otherwise("changed")
    )
    return left.join(right, keys, "full_outer").withColumn("status", status)


def content_lens(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """One row: distinct values shared, only in a, only in b; rows of each side whose value the other has. No value is collected."""
    sides = a.groupBy(value).agg(F.count("*").alias("na")).join(b.groupBy(value).agg(F.count("*").alias("nb")), value, "full_outer")
    both = F.col("na").isNotNull() & F.col("nb").isNotNull()
    return sides.agg(
        F.count_if(both).alias("shared"), F.count_if(F.col("nb").isNull()).alias("only_a"), F.count_if(F.col("na").isNull()).alias("only_b"),
        F.coalesce(F.sum(F.when(both, F.col("na"))), F.lit(0)).alias("rows_a_in_b"), F.coalesce(F.sum(F.when(both, F.col("nb"))), F.lit(0)).alias("rows_b_in_a"),
    )


def repo_lens(compared: DataFrame, repo: str = "repo") -> DataFrame:
    """Per repository: rows of each status, and whether it drifted."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in ("identical", "changed", "only_a", "only_b")]
    return compared.groupBy(repo).agg(*counts).withColumn("drifted", F.col("changed") + F.col("only_a") + F.col("only_b") > 0)


def presence(a: DataFrame, b: DataFrame, keys: list[str], repo: str = "repo") -> DataFrame:
    """Per repository of a: rows, how many b has by key, and the percentage."""
    there = b.select(*keys).distinct().withColumn("_there", F.lit(1))
    rows = a.join(there, keys, "left")
    return rows.groupBy(repo).agg(
        F.count("*").alias("files"), F.count("_there").alias("present"), F.round(F.count("_there") * 100.0 / F.count("*"), 2).alias("pct")
    )


def zipped(a: DataFrame, b: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """The nth row of each side of a group, side by side."""
    number = lambda df, name: df.select(group, F.row_number().over(Window.partitionBy(group).orderBy(*order)).alias("n"), F.col(value).alias(name))
    return number(a, "value_a").join(number(b, "value_b"), [group, "n"], "full_outer")


def tree_diff(a: DataFrame, b: DataFrame, keys: list[str], path: str, blob: str) -> DataFrame:
    """same, differs, moved, only_a, only_b: paths compared, then those of one side only paired by equal content.

    Pairs are one to one, in order of path within a content; empty contents are not paired.
    """
    left = a.select(*keys, F.col(path).alias("_p"), F.col(blob).alias("sha_a"))
    right = b.select(*keys, F.col(path).alias("_p"), F.col(blob).alias("sha_b"))
    both = left.join(right, [*keys, "_p"], "full_outer")
    met = both.where("sha_a IS NOT NULL AND sha_b IS NOT NULL").select(
        *keys, F.col("_p").alias("path_a"), F.col("_p").alias("path_b"), F.when(F.col("sha_a") == F.col("sha_b"), "same").otherwise("differs").alias("status")
    )
    number = lambda sha: F.row_number().over(Window.partitionBy(*keys, sha).orderBy("_p"))
    alone_a = both.where("sha_b IS NULL").select(*keys, F.col("sha_a").alias("sha"), F.col("_p").alias("path_a"), number("sha_a").alias("n"))
    alone_b = both.where("sha_a IS NULL").select(*keys, F.col("sha_b").alias("sha"), F.col("_p").alias("path_b"), number("sha_b").alias("n"))
    rest = alone_a.join(alone_b, [*keys, "sha", "n"], "full_outer")
    status = F.when(F.col("path_a").isNull(), "only_b").when(F.col("path_b").isNull(), "only_a").otherwise("moved")
    return met.unionByName(rest.select(*keys, "path_a", "path_b", status.alias("status")))


def object_diff(a: DataFrame, b: DataFrame, key: str, path: str) -> DataFrame:
    """Contents that one side lacks, with a representative path and how many more paths have it."""
    only = lambda x, y, side: x.join(y.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.min(path).alias("path"), (F.countDistinct(path) - 1).alias("more")).withColumn("side", F.lit(side))
    return only(a, b, "a").unionByName(only(b, a, "b"))


def subset_check(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: keys of a that b lacks, and PASS if there are none."""
    missing = a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")
    return missing.agg(F.count("*").alias("missing")).withColumn("verdict", F.when(F.col("missing") == 0, "PASS").otherwise("FAIL"))


def step_delta(before: DataFrame, after: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """new, gone, changed or unchanged for every key of a step."""
    old = before.select(*keys, F.struct(*values).alias("_old"))
    new = after.select(*keys, F.struct(*values).alias("_new"))
    status = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "gone").when(F.col("_old") == F.col("_new"), "unchanged").otherwise("changed")
    return old.join(new, keys, "full_outer").select(*keys, status.alias("status"))
