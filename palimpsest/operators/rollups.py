"""Counts, distributions, totals and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_totals(rows: DataFrame, by: str, sums: dict[str, Column], distinct: dict[str, Column]) -> DataFrame:
    """Per value of ``by`` and in total. Distinct counts of the total are counted anew, not added.

    Each distinct count goes by steps of its own, so that no row is expanded for several of them.
    """
    adds = [F.sum(c).alias(n) for n, c in sums.items()]
    own = rows.groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("_rows"), *adds).withColumn("_g", F.lit(0))
    out = own.unionByName(rows.agg(F.count("*").alias("_rows"), *adds).withColumns({"_by": F.lit(None).cast(rows.schema[by].dataType), "_g": F.lit(1)}))
    for name, c in distinct.items():
        pairs = rows.select(F.col(by).alias("_v"), c.alias("_d")).where("_d IS NOT NULL").distinct()
        counts = pairs.groupBy("_v").agg(F.count("*").alias(name)).withColumn("_t", F.lit(0))
        total = pairs.select("_d").distinct().agg(F.count("*").alias(name)).withColumns({"_v": F.lit(None).cast(rows.schema[by].dataType), "_t": F.lit(1)})
        counts = counts.unionByName(total)
        out = out.join(counts, F.col("_by").eqNullSafe(F.col("_v")) & (F.col("_g") == F.col("_t")), "left").drop("_v", "_t").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return out.select(F.when(F.col("_g") == 1, "total").otherwise(F.col("_by")).alias(by), *sums, *distinct)


def running_counts(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """Each distinct value of a group once: how many rows have it (_n), how many one up to it (_upto), how many there are (_all).

    Values are cut into bands of a part in 64 of their size; the bands, a few thousand whatever the number of values, are summed first, so that
    no task has all values of a group. Null values come first.
    """
    counts = rows.groupBy(*group, value).agg(F.count("*").alias("_n"))
    x = F.col(value).cast("double")
    band = F.when(x.isNull(), -3_000_000).when(F.isnan(x), 2_000_000).when(x > 0, F.floor(F.ln(x) * 64)).when(x < 0, -2_000_000 - F.floor(F.ln(-x) * 64)).otherwise(-1_000_000)
    counts = counts.withColumn("_band", band.cast("int"))
    whole = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_own").over(whole.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bands = counts.groupBy(*group, "_band").agg(F.sum("_n").alias("_own"))
    bands = bands.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_band").alias("_b"), before.alias("_before"), F.sum("_own").over(whole).alias("_all"))
    same = F.col("_band") == F.col("_b")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    upto = F.sum("_n").over(Window.partitionBy(*group, "_band").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return counts.join(bands, same).withColumn("_upto", F.col("_before") + upto).select(*group, value, "_n", "_upto", "_all")


def nearest_rank(rows: DataFrame, group: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Per group the value at place min(n, floor(n * p) + 1) in ascending order, for each share p."""
    counted = running_counts(rows, group, value)
    at = lambda p: F.min(F.when(F.col("_upto") >= F.least(F.col("_all"), F.floor(F.col("_all") * p) + 1), F.col(value)))
    return counted.groupBy(*group).agg(*[at(p).alias(n) for n, p in shares.items()], F.max("_all").alias("n"))


def distribution(rows: DataFrame, bucket: Column, name: str = "bucket") -> DataFrame:
    """Rows per bucket with their share in percent."""
    counts = rows.groupBy(bucket.alias(name)).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    return counts.join(F.broadcast(total)).select(name, "n", F.round(F.col("n") * 100.0 / F.col("_t"), 2).alias("pct"))


def concentration(rows: DataFrame, key: str, value: str, tops: list[int]) -> DataFrame:
    """Share of the sum that the top n keys hold, for each n."""
    per = rows.groupBy(key).agg(F.sum(value).alias("_v"))
    most = per.orderBy(F.desc("_v"), key).limit(max(tops))
    ranked = most.withColumn("_rn", F.row_number().over(Window.orderBy(F.desc("_v"), key)))
    sums = ranked.agg(*[F.sum(F.when(F.col("_rn") <= n, F.col("_v"))).alias(f"top_{n}") for n in tops])
    total = per.agg(F.sum("_v").alias("total"))
    return sums.join(total).select("total", *[F.round(F.col(f"top_{n}") * 100.0 / F.col("total"), 2).alias(f"pct_top_{n}") for n in tops])


def pairs_text(rows: DataFrame, group: list[str], key: str) -> DataFrame:
    """Per group 'key:count|key:count', by key."""
    counts = rows.groupBy(*group, key).agg(F.count("*").alias("n"))
    items = F.sort_array(F.collect_list(F.concat_ws(":", key, "n")))
    return counts.groupBy(*group).agg(F.sum("n").alias("rows"), F.array_join(items, "|").alias("pairs"))


def copy_groups(rows: DataFrame, commit: str, repo: str) -> DataFrame:
    """Sets of repositories that share commits, with the number of commits and rows."""
    per = rows.groupBy(commit).agg(F.array_join(F.sort_array(F.collect_set(repo)), "|").alias("repos"), F.count_distinct(repo).alias("n_repos"), F.count("*").alias("n"))
    return per.where("n_repos > 1").groupBy("repos", "n_repos").agg(F.count("*").alias("commits"), F.sum("n").alias("rows"))


def status_trail(runs: DataFrame, unit: str) -> DataFrame:
    """Per unit: attempts, statuses in order, the last one, whether it ever was ok, whether a failure was fixed."""
    trail = F.array_sort(F.collect_list(F.struct("finished", "ord", "status")))
    out = runs.groupBy(unit).agg(
        F.count("*").alias("attempts"), F.array_join(F.transform(trail, lambda s: s["status"]), " > ").alias("trail"),
        F.max_by("status", F.struct("finished", "ord")).alias("last_status"), F.bool_or(F.col("status") == "ok").alias("ever_ok"), F.bool_or(F.col("status") != "ok").alias("ever_failed"),
    )
    return out.withColumn("fixed", F.col("ever_failed") & (F.col("last_status") == "ok"))


def quantiles(rows: DataFrame, group: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """Linear-interpolated quantiles of each group by counts of its values: no aggregate holds all values of a group."""
    counts = running_counts(rows.where(F.col(value).isNotNull()), group, value)
    at = {name: (F.col("_all") - 1) * F.lit(p) for name, p in fractions.items()}
    ends = [f(F.when(F.col("_upto") > g(at[n]), F.col(value))).alias(f"_{k}_{n}") for n in at for k, f, g in (("a", F.min, F.floor), ("b", F.min, F.ceil))]
    found = counts.groupBy(*group).agg(F.max("_all").alias("_all"), *ends)
    part = lambda n: at[n] - F.floor(at[n])
    return found.select(*group, *[(F.col(f"_a_{n}") * (1 - part(n)) + F.col(f"_b_{n}") * part(n)).alias(n) for n in at])


def size_stats(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """Count, sum, median cut to a whole number, linear-interpolated quartiles and 90 %, maximum. Groups are not null."""
    parts = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}
    sums = rows.groupBy(*group).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.max(value).alias("max"))
    out = sums.join(quantiles(rows, group, value, parts), group, "left")
    return out.select(*group, "n", "total", F.floor("p50").cast("long").alias("median"), *[F.round(p, 4).alias(p) for p in parts], "max")
