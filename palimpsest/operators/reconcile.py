"""Reconciling what was produced with what was delivered, and looking things up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(source: DataFrame, share: DataFrame, unit: str = "unit", rel: str = "rel", size: str = "bytes") -> DataFrame:
    """Every file of both sides: ok, size_differs, other_case, missing; temp, case_twin or extra on the share only."""
    one = lambda df, name: df.groupBy(unit, rel).agg(F.max(size).alias(name))
    s, h = one(source, "_s"), one(share, "_h")
    low_h = h.select(unit, F.lower(rel).alias("_low")).distinct().withColumn("_in_share", F.lit(True))
    low_s = s.select(unit, F.lower(rel).alias("_low")).distinct().withColumn("_in_source", F.lit(True))
    both = s.join(h, [unit, rel], "full_outer").withColumn("_low", F.lower(rel))
    both = both.join(low_h, [unit, "_low"], "left").join(low_s, [unit, "_low"], "left")
    extra = F.when(F.col(rel).rlike(r"\.tmp\.[0-9]+$"), "temp").when(F.col("_in_source"), "case_twin").otherwise("extra")
    status = (
        F.when(F.col("_s").isNull(), extra)
        .when(F.col("_h").isNotNull(), F.when(F.col("_s") == F.col("_h"), "ok").otherwise("size_differs"))
        .when(F.col("_in_share"), "other_case")
        .otherwise("missing")
    )
    return both.select(unit, rel, status.alias("status"))


def occurrences(wanted: DataFrame, manifest: DataFrame, key: str, columns: list[str], mark: str) -> DataFrame:
    """Where each wanted content occurs; 'NOT FOUND' in ``mark`` if nowhere."""
    return wanted.join(manifest.select(key, *columns).distinct(), key, "left").withColumn(mark, F.coalesce(mark, F.lit("NOT FOUND")))


def by_prefix(rows: DataFrame, path: str, stores: DataFrame, prefix: str, store: str) -> DataFrame:
    """The store whose prefix of the path is longest; null if none is.

    Each path is joined on its own beginnings, one for every length that a prefix has, so this is an
    equi-join whatever the number of stores; the lengths are few.
    """
    lengths = F.array_sort(F.collect_set(F.length(prefix)))
    sizes = stores.agg(lengths.alias("_lens"))
    begins = rows.join(F.broadcast(sizes)).select(path, F.explode_outer(F.transform(F.filter("_lens", lambda n: n <= F.length(path)), lambda n: F.substring(F.col(path), F.lit(1), n))).alias("_begin"))
    met = begins.join(stores.withColumnRenamed(prefix, "_begin"), "_begin", "left")
    return met.groupBy(path).agg(F.max_by(store, F.when(F.col(store).isNotNull(), F.length("_begin"))).alias(store))


def lookup_places(wanted: DataFrame, name: str, places: DataFrame) -> DataFrame:
    """Whether each name is in each place: exact, fuzzy (letters and digits only) or missing. Null places are left out.

    The answer has a row for each name and place: each name is spread over the list of places, one row; what is found is joined by name.
    """
    from palimpsest.functions.paths import fuzzy

    there = places.where("place IS NOT NULL")
    listed = there.agg(F.sort_array(F.collect_set("place")).alias("_all"))
    every = wanted.join(F.broadcast(listed)).withColumn("place", F.explode("_all")).drop("_all")
    exact = there.select("place", F.col("name").alias(name), F.lit(1).alias("_e")).distinct()
    near = there.select("place", fuzzy(F.col("name")).alias("_f"), F.lit(1).alias("_n")).distinct()
    rows = every.join(exact, ["place", name], "left").withColumn("_f", fuzzy(F.col(name))).join(near, ["place", "_f"], "left")
    return rows.select(name, "place", F.when(F.col("_e") == 1, "exact").when(F.col("_n") == 1, "fuzzy").otherwise("missing").alias("found"))


def store_actions(rows: DataFrame, stored: DataFrame, content: str, order: list[str]) -> DataFrame:
    """in_stored, deduped or written: a content that is not stored yet is written for its first row. ``order`` tells the rows of a content apart."""
    there = stored.select(content).distinct().withColumn("_there", F.lit(True))
    first = rows.groupBy(content).agg(F.min(F.struct(*order)).alias("_first"))
    action = F.when(F.col("_there"), "in_stored").when(F.struct(*order) != F.col("_first"), "deduped").otherwise("written")
    return rows.join(there, content, "left").join(first, content).withColumn("action", action).drop("_there", "_first")
