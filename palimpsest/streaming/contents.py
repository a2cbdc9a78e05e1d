"""A store of contents across units and runs: each content once, owned by the first unit that has it, in whatever order units come.

The store is parted by a hash of the key. Beside its rows each part has bitmaps of the keys that it holds. A batch asks these first: a key
whose bit is not set is new, and only parts that may hold one of the batch's keys are read. What a batch adds lies in folders of its own, so
a batch that is run again replaces what it left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .incremental import take_new

#: Parts of a store, and bits of a part's bitmap (a multiple of a bitmap row's).
PARTS, BITS = 64, 1 << 22
#: Bits in one row of bitmaps.
ROW = 1 << 15


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _part(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*key, F.lit("part")), F.lit(PARTS)).cast("int")


def _earlier(spark: SparkSession, store: str, kind: str, number: int, parts: list[int] | None = None) -> DataFrame | None:
    """What earlier batches left, of these parts: partitions that are not asked for are not read."""
    if not _exists(spark, f"{store}/{kind}"):
        return None
    rows = spark.read.parquet(f"{store}/{kind}").where(F.col("batch") < number)
    return rows if parts is None else rows.where(F.col("part").isin(parts))


def add_batch(rows: DataFrame, number: int, store: str, key: list[str], order: list[str]) -> list[int]:
    """Take a batch's contents into the store; the parts of the store that had to be read.

    Of a batch's rows with one key the first by ``order`` counts. A row is written for a key that is new, and for one whose owner so far comes
    later in that order. Rows with a null in the key are left out.
    """
    spark = rows.sparkSession
    keys = rows.columns
    first = F.min(F.struct(*order, *[c for c in keys if c not in (*key, *order)])).alias("_first")
    whole = rows.where(" AND ".join(f"`{c}` IS NOT NULL" for c in key))
    fresh = whole.groupBy(*key).agg(first).select(*key, "_first.*").withColumn("part", _part(key))
    at = F.pmod(F.xxhash64(*key, F.lit("bit")), F.lit(BITS))
    fresh = fresh.withColumns({"_row": (at / ROW).cast("int"), "_bit": (at % ROW).cast("int")})
    marks = _earlier(spark, store, "marks", number)
    hit: list[int] = []
    if marks is not None:
        byte = F.conv(F.hex(F.expr("substring(bits, _bit div 8 + 1, 1)")), 16, 10).cast("int")
        is_set = F.call_function("shiftright", byte, F.col("_bit") % 8).bitwiseAND(F.lit(1)) == 1
        known = fresh.join(marks, ["part", "_row"]).where(is_set)
        hit = sorted(r["part"] for r in known.select("part").distinct().collect())  # at most PARTS
    out = fresh
    if hit:
        old = _earlier(spark, store, "rows", number, hit).groupBy(*key).agg(F.min(F.struct(*order)).alias("_owner"))
        out = fresh.join(old, key, "left").where(F.col("_owner").isNull() | (F.struct(*order) < F.col("_owner"))).drop("_owner")
    # One file a part: keys are spread over the parts by their hash.
    out.select(*keys, "part").repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{store}/rows/batch={number}")
    written = spark.read.schema(out.select(*keys, "part").schema).parquet(f"{store}/rows/batch={number}")
    written = written.withColumns({"_row": (at / ROW).cast("int"), "_bit": (at % ROW).cast("int")})
    written.groupBy("part", "_row").agg(F.call_function("bitmap_construct_agg", F.col("_bit").cast("long")).alias("bits")).repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{store}/marks/batch={number}")
    return hit


def owners(spark: SparkSession, store: str, key: list[str], order: list[str]) -> DataFrame:
    """Each content of the store with its owner's row."""
    rows = spark.read.parquet(f"{store}/rows").drop("part", "batch")
    rest = [c for c in rows.columns if c not in (*key, *order)]
    return rows.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("_o")).select(*key, "_o.*")


def keep_contents(spark: SparkSession, folder: str, schema: str, store: str, checkpoint: str, key: list[str], order: list[str]) -> None:
    """Take in what has come to a folder since the last call."""
    take_new(spark, folder, schema, checkpoint, lambda rows, number: add_batch(rows, number, store, key, order) and None)
