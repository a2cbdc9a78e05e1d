"""Planning batches and drawing samples."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import numbered


def tiers(units: DataFrame, size: str, unit: str, cuts: dict[str, int]) -> DataFrame:
    """Tier of each unit by its rank in size: the largest ``cuts['G']`` are G, and so on; the rest S."""
    rank = F.row_number().over(Window.orderBy(F.desc(size), unit))
    tier, upto = None, 0
    for name, n in cuts.items():
        upto += n
        tier = F.when(F.col("_rn") <= upto, name) if tier is None else tier.when(F.col("_rn") <= upto, name)
    most = units.orderBy(F.desc(size), unit).limit(sum(cuts.values())).withColumn("_rn", rank).select(unit, tier.alias("tier"))
    return units.join(most, unit, "left").withColumn("tier", F.coalesce("tier", F.lit("S")))


def deal(units: DataFrame, tier: str, unit: str, batches: int, order: str) -> DataFrame:
    """Round robin within each tier, largest first.

    Nearly all units may be of one tier: units are numbered within bands of sizes that differ by less than one part in 256,
    and the bands, a few thousand whatever the number of units, are counted first.
    """
    band = F.when(F.col(order) > 0, F.floor(F.ln(F.col(order).cast("double")) * 256)).otherwise(F.lit(-1)).cast("int")
    rows = units.withColumn("_band", F.coalesce(band, F.lit(-2)))
    counts = rows.groupBy(tier, "_band").agg(F.count("*").alias("_n"))
    larger = Window.partitionBy(tier).orderBy(F.desc("_band")).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col(tier).alias("_tier"), F.col("_band").alias("_b"), F.coalesce(F.sum("_n").over(larger), F.lit(0)).alias("_before"))
    rn = F.row_number().over(Window.partitionBy(tier, "_band").orderBy(F.desc(order), unit))
    rows = rows.withColumn("_rn", rn).join(counts, F.col(tier).eqNullSafe(F.col("_tier")) & (F.col("_band") == F.col("_b")))
    return rows.withColumn("batch", ((F.col("_before") + F.col("_rn") - 1) % batches).cast("int")).drop("_band", "_rn", "_tier", "_b", "_before")


def _ranges(sizes: list[tuple[int, int]], batches: int) -> list[list[tuple[int, list[int]]]]:
    """For each (size, units of that size), largest first: from which rank on units go round which batches.

    Each unit goes to the least loaded batch, of equal ones to the first. Units of one size fill the batches level by level: at a level stand the batches
    that are loaded to it in whole units, in the order of what they have beyond. So the units of a size need a range for each batch at most.
    """
    load, out = [0] * batches, []
    for size, n in sizes:
        own: list[tuple[int, list[int]]] = []
        if size == 0:
            out.append([(0, [load.index(min(load))])])
            continue
        level, rest = [x // size for x in load], [x % size for x in load]
        steps = sorted(set(level))
        done = 0
        for k, at in enumerate(steps):
            who = sorted((b for b in range(batches) if level[b] <= at), key=lambda b: (rest[b], b))
            rounds = steps[k + 1] - at if k + 1 < len(steps) else n
            units = min(n - done, rounds * len(who))
            if units <= 0:
                break
            own.append((done, who))
            whole, some = divmod(units, len(who))
            for i, b in enumerate(who):
                load[b] += size * (whole + (i < some))
            done += units
        out.append(own)
    return out


def balanced(units: DataFrame, unit: str, size: str, batches: int, group: str) -> DataFrame:
    """Longest first to the least loaded batch, in each group: (group, unit, batch). Of equal sizes the smallest unit comes first.

    The rule is sequential, but only over a group's sizes: they are counted, and one task a group deals out the sizes, a few numbers each,
    however many units have them. Units are numbered within their size without a group in one task, and look their batch up.
    Sizes are whole numbers from 0 on; units without one have 0.
    """
    rows = units.select(group, unit, F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long")).alias("_size"))
    sizes = rows.groupBy(group, "_size").agg(F.count("*").alias("_n"))

    def deal_out(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_size", ascending=False)
        found = _ranges(list(zip(pdf["_size"].tolist(), pdf["_n"].tolist(), strict=True)), batches)
        own = [(g, s, start, who) for g, s, x in zip(pdf[group], pdf["_size"], found, strict=True) for start, who in x]
        return pd.DataFrame(own, columns=[group, "_size", "_start", "_who"])

    kind = units.schema[group].dataType.simpleString()
    ranges = sizes.groupBy(group).applyInPandas(deal_out, f"{group} {kind}, _size bigint, _start bigint, _who array<int>")
    ranges = ranges.groupBy(group, "_size").agg(F.array_sort(F.collect_list(F.struct("_start", "_who"))).alias("_r"))  # as many as batches at most
    ranges = ranges.select(F.col(group).alias("_g"), F.col("_size").alias("_s"), "_r")
    rows = numbered(rows, [group, "_size"], [F.col(unit).asc()], "_k").withColumn("_k", F.col("_k") - 1)
    met = rows.join(ranges, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_size") == F.col("_s")))
    at = F.element_at(F.filter("_r", lambda r: r["_start"] <= F.col("_k")), -1)
    met = met.withColumn("_at", at)
    return met.select(group, unit, F.get("_at._who", ((F.col("_k") - F.col("_at._start")) % F.size("_at._who")).cast("int")).alias("batch"))


def per_group(rows: DataFrame, group: str, most: int, order: list[str]) -> DataFrame:
    """At most so many rows of each group."""
    rn = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("_rn", rn).where(F.col("_rn") <= most).drop("_rn")


def seeded_sample(rows: DataFrame, group: str, key: str, seed: int, most: int) -> DataFrame:
    """A sample of so many rows that takes one of each group in turn, in an order that the seed fixes (MD5 of seed and key).

    No group gives more rows than the sample has, so only its first ones are ranked further.
    """
    draw = lambda c: F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(c).cast("string")))
    turn = F.row_number().over(Window.partitionBy(group).orderBy(draw(key), key))
    return rows.withColumn("turn", turn).where(F.col("turn") <= most).orderBy("turn", draw(group), group).limit(most)
