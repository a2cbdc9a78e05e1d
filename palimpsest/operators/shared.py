"""What several operators need: cutting lineage in the shared folder, numbers that no single task gives out."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only where a local session names none (tests)."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="palimpsest-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


_folders: set[str] = set()


def scratch(spark: SparkSession) -> str:
    """A new path in the application's part of the shared folder. It goes when the driver ends."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_drop, spark, folder)
    return f"{folder}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder: no lineage, and they survive lost executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """The table, to be joined by shuffles only. Spark takes the size of compressed files, a few bytes a row, for the size of a table, and would send millions of rows through the driver."""
    return df.hint("merge")


def _drop(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None:  # the session is still there
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def numbered(rows: DataFrame, group: list[str], order: list[Column], name: str = "n") -> DataFrame:
    """The rows with their number from 1 in their group, by ``order``; a group of any size is spread over tasks.

    Rows are sorted into parts by ranges; a part's numbers begin after the rows that earlier parts have of the group. ``order`` has to
    tell the rows of a group apart. Null groups are groups. Only counts of parts go through one task a group.
    """
    parts = cut(rows.repartitionByRange(*[F.col(c) for c in group], *order).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy(*group, "_part").agg(F.count("*").alias("_own"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_part").alias("_p"), F.coalesce(F.sum("_own").over(earlier), F.lit(0)).alias("_before"))
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    at = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))
    out = parts.withColumn("_at", at).join(dealt(first), same)
    return out.withColumn(name, (F.col("_before") + F.col("_at")).cast("long")).select(*rows.columns, name)
