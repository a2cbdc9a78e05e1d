"""Reports of several sections from one pass over the rows, with the run's health and a check against figures from elsewhere."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def sections(rows: DataFrame, named: dict[str, list[str]], sums: dict[str, Column], distinct: str | None = None, distinct_sum: str | None = None) -> DataFrame:
    """(section, keys, sums, and with ``distinct`` also contents and content_sum): every section's groups, from one scan.

    ``named`` gives each section's columns; no columns is the total. Sums are taken once for all columns together, and the sections from these
    by grouping sets, so that rows are not multiplied by the sections. ``keys`` are the group's values as text, joined by ' | ', null ones as ''.
    With ``distinct`` each of its values counts once in a group, ``distinct_sum`` with its largest size: rows are brought to one for each
    value in each group of all columns first; only these are spread over the sections.
    """
    columns = list(dict.fromkeys(c for own in named.values() for c in own))
    finest = rows.groupBy(*columns, *([distinct] if distinct else [])).agg(*[F.sum(x).alias(c) for c, x in sums.items()], *([F.max(distinct_sum).alias("_size")] if distinct_sum else []))
    # A section is told by the columns that are grouped: one bit each, the first one highest.
    level = F.grouping_id(*columns) if columns else F.lit(0)
    number = {name: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in own) for name, own in named.items()}
    if len(set(number.values())) < len(number):
        raise ValueError("two sections have the same columns")
    keys = lambda own: F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in own]) if own else F.lit("")
    sets = [[F.col(c) for c in own] for own in named.values()]
    spread = finest.groupingSets(sets, *[F.col(c) for c in columns]) if not distinct else None
    if spread is not None:
        out = spread.agg(level.alias("_level"), *[F.sum(c).alias(c) for c in sums])
    else:
        with_value = [[*own, F.col(distinct)] for own in sets]
        once = finest.groupingSets(with_value, *[F.col(c) for c in columns], F.col(distinct)).agg(F.grouping_id(*columns, distinct).alias("_id"), *[F.sum(c).alias(c) for c in sums], *([F.max("_size").alias("_size")] if distinct_sum else []))
        once = once.withColumn("_level", F.shiftright("_id", 1))
        out = once.groupBy("_level", *columns).agg(*[F.sum(c).alias(c) for c in sums], F.count(distinct).alias("contents"), *([F.sum(F.when(F.col(distinct).isNotNull(), F.col("_size"))).alias("content_sum")] if distinct_sum else []))
    name = key = None
    for section, own in named.items():
        here = F.col("_level") == number[section]
        name = F.when(here, section) if name is None else name.when(here, section)
        key = F.when(here, keys(own)) if key is None else key.when(here, keys(own))
    return out.select(name.alias("section"), key.alias("keys"), *sums, *(["contents"] if distinct else []), *(["content_sum"] if distinct and distinct_sum else []))


def observed(rows: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Callable[[], dict]]:
    """The rows, and a function that gives the measures once an action has gone over them: a run's health without a pass of its own."""
    seen = Observation(name)
    return rows.observe(seen, *[x.alias(c) for c, x in measures.items()]), lambda: seen.get


def cross_check(report: DataFrame, other: DataFrame, keys: list[str], figures: list[str]) -> DataFrame:
    """Figures of two tables side by side: keys, figure, report, other, same; what only one side has is not the same. Null keys meet."""
    long = lambda df, name: df.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("figure"), F.col(c).cast("decimal(38,3)").alias("v")) for c in figures])).alias("_f")).groupBy(*keys, F.col("_f.figure").alias("figure")).agg(F.max("_f.v").alias(name))
    a, b = long(report, "report").alias("a"), long(other, "other").alias("b")
    same = F.col("a.figure") == F.col("b.figure")
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    met = a.join(b, same, "full_outer")
    one = lambda c: F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c)
    return met.select(*[one(k) for k in keys], one("figure"), "report", "other", F.coalesce(F.col("report") == F.col("other"), F.lit(False)).alias("same"))
