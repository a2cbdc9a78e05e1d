"""Helpers that several operators share: tables, scratch folders, spans of matches."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Elements whose lengths are summed in one step by ``running_starts``.
BLOCK = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str, text_col: str, blank: bool = True) -> DataFrame:
    """Only the two columns an operator reads, as ``_id`` and ``_text``; other columns cannot clash.

    A null text becomes an empty one if ``blank``.
    """
    text = docs[text_col].cast("string")
    return docs.select(docs[id_col].alias("_id"), (F.coalesce(text, F.lit("")) if blank else text).alias("_text"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where a local session names none (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="palimpsest-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


_folders: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's part of the shared folder, which is deleted when the driver's process ends."""
    folder = f"{shared_dir(spark)}/palimpsest-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_drop_folder, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def _drop_folder(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None:  # the session is still there
        drop_path(spark, folder)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables in the shared folder by name, so that they can go as soon as they have been read."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.setdefault(name, []).append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete the tables of these names; all without a name."""
        for name in names or [*self.paths]:
            for path in self.paths.pop(name):
                drop_path(self.spark, path)

    def keep(self, *names: str) -> None:
        """Delete all tables but those of these names, which stay for good: what is returned reads them."""
        for name in names:
            self.paths.pop(name, None)
        self.drop()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also if the body names it in lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column) -> Column:
    """Sum of an array of longs; 0 if empty."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def running_starts(lengths: Column) -> Column:
    """For each element the sum of those before it. Two-level, so that thousands of matches stay cheap."""

    def starts(state: Column) -> Column:
        v, blocks = state["v"], state["b"]
        return F.transform(
            v,
            lambda _, i: total(F.slice(blocks, F.lit(1), (i / BLOCK).cast("int")))
            + total(F.slice(v, i - i % BLOCK + 1, i % BLOCK)),
        )

    def blocks(v: Column) -> Column:
        count = F.ceil(F.size(v) / BLOCK).cast("int")
        sums = F.transform(F.sequence(F.lit(1), count), lambda b: total(F.slice(v, (b - 1) * BLOCK + 1, BLOCK)))
        return F.struct(v.alias("v"), sums.alias("b"))

    empty = F.array().cast("array<bigint>")
    return let(lengths, lambda v: F.when(F.size(v) > 0, let(blocks(v), starts)).otherwise(empty))


def match_spans(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as array<struct<start,end,hit>>, in code points, end exclusive.

    The pattern must not match the empty string.
    """

    def spans(s: Column) -> Column:
        lengths = F.transform(s["hits"], lambda h, i: (F.length(s["gaps"][i]) + F.length(h)).cast("long"))
        return let(
            running_starts(lengths),
            lambda starts: F.transform(
                s["hits"],
                lambda h, i: F.struct(
                    (starts[i] + F.length(s["gaps"][i])).alias("start"),
                    (starts[i] + F.length(s["gaps"][i]) + F.length(h)).alias("end"),
                    h.alias("hit"),
                ),
            ),
        )

    both = F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")
    return F.when(text.rlike(pattern), let(both, spans)).otherwise(none)


def python_path(path: str) -> str:
    """A path for Python's own readers: without the file scheme."""
    return path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is; PUBLIC_TOKENIZERS may name another folder."""
    folder = os.environ.get("PUBLIC_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
