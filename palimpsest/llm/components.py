"""Connected components by large-star and small-star rounds (Kiveris and others, 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, scratch_path


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of a link the smallest node that it reaches. Links may repeat.

    Each round rewires neighbours to smaller nodes; it is over when the links no longer change, after
    about log^2 of the longest path. Links stay in tables in the shared folder, none go to the driver.
    Links with a null end are left out. A star's centre with very many links is only ever grouped by an
    aggregate with partial sums (its smallest neighbour), then joined.
    """
    spark = links.sparkSession
    pair = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pair = pair.where(links[a].isNotNull() & links[b].isNotNull() & (F.col("u") != F.col("v"))).distinct()
    paths: list[str] = []

    def put(df: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, "links"))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    pair = put(pair)
    before = state(pair)
    while before[0]:
        # Large star: every larger neighbour of u is linked to the smallest of u and its neighbours.
        both = pair.select("u", "v").unionByName(pair.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = put(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = put(large)
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        low = put(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pair = put(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        after = state(pair)
        if after == before:
            break
        before = after
        for p in paths[:-1]:
            drop_path(spark, p)
        del paths[:-1]
    ends = pair.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return ends.unionByName(pair.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
