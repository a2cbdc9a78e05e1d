"""Samples and most common values of groups; no task and no window ever has all rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def draw(seed: int, *keys: str) -> Column:
    """The MD5, in hexadecimal, that places a row in a random order which the seed fixes. Null keys are empty."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))


def _same(group: list[str]) -> Column:
    same = F.lit(True)
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return same


def near(rows: DataFrame, group: list[str], by: str, k: int) -> DataFrame:
    """The rows of each group that can be among its k smallest in ``by`` (MD5s): all of these, and some k others.

    Rows are counted by the zero bits that their MD5 begins with, an aggregate that merges, at most 60 numbers a group. The bands with most
    zeros that have k rows together are kept; a band has half the rows of the one before.
    """
    bits = F.length(F.bin(F.conv(F.substring(by, 1, 15), 16, 10).cast("long")))
    rows = rows.withColumn("_zeros", 60 - bits)
    bands = rows.groupBy(*group, "_zeros").agg(F.count("*").alias("_n"))
    above = Window.partitionBy(*group).orderBy(F.desc("_zeros")).rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0))).where(F.col("_above") < k)
    least = bands.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]).agg(F.min("_zeros").alias("_least"))
    return rows.join(least, _same(group) & (F.col("_zeros") >= F.col("_least"))).select(*[c for c in rows.columns if c != "_zeros"])


def bottom_k(rows: DataFrame, group: list[str], by: str, key: list[str], k: int, place: str = "place") -> DataFrame:
    """The k rows of each group with the smallest MD5s in ``by``, ties by ``key``, with their place from 1. Null groups are groups."""
    rn = F.row_number().over(Window.partitionBy(*group).orderBy(by, *key))
    return near(rows, group, by, k).withColumn(place, rn).where(F.col(place) <= k)


def spread_sample(rows: DataFrame, group: list[str], unit: list[str], key: list[str], k: int, seed: int) -> DataFrame:
    """Up to k rows of each group, one of each unit in turn, with their place; ``key`` tells a unit's rows apart.

    Only the k units that come first can give rows, and each of them no more than k. So the units are drawn first, then rows of theirs: what is
    ranked in the end is at most k * k rows a group. Repeated rows count as rows. Columns keep their names, ``place`` and those that begin with _ excepted.
    """
    units = rows.select(*group, *unit).distinct().withColumn("_unit", draw(seed, *unit))
    chosen = bottom_k(units, group, "_unit", unit, k, "_turn_of")
    chosen = chosen.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate([*group, *unit])], "_turn_of")
    # At most k units a group: a small table, which Spark broadcasts if it has seen so.
    mine = rows.join(chosen, _same([*group, *unit])).select(*rows.columns, "_turn_of").withColumn("_row", draw(seed, *key))
    turns = bottom_k(mine, [*group, *unit], "_row", key, k, "_turn")
    place = F.row_number().over(Window.partitionBy(*group).orderBy("_turn", "_turn_of"))
    return turns.withColumn("place", place).where(F.col("place") <= k).select(*rows.columns, "place")


def most_common(rows: DataFrame, group: list[str], values: dict[str, Column], k: int) -> DataFrame:
    """Per group and named value its k most common ones as text, 'x (3), y (2)'; of equally common ones the smaller first. Null values are left out.

    All values are counted in one pass. Ranks up to k are taken within each task before counts are shuffled, so a group of
    many different values sends k of them from each task.
    """
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("string").alias("value")) for n, c in values.items()])).alias("_v")
    counts = rows.select(*group, named).where("_v.value IS NOT NULL").groupBy(*group, F.col("_v.name").alias("_name"), F.col("_v.value").alias("_value")).agg(F.count("*").alias("_n"))
    rn = F.row_number().over(Window.partitionBy(*group, "_name").orderBy(F.desc("_n"), "_value"))
    top = counts.withColumn("_rn", rn).where(F.col("_rn") <= k)
    text = F.concat("_value", F.lit(" ("), F.col("_n").cast("string"), F.lit(")"))
    each = lambda n: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_name") == n, F.struct("_rn", text.alias("t"))))), lambda x: x["t"]), ", ").alias(n)
    return top.groupBy(*group).agg(*[each(n) for n in values])
