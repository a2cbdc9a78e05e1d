"""Jump consistent hashing: stable keys to shards without a ring table (native).

Shards only ever grow at the end, and one more shard takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import let

#: The multiplier of the published algorithm's generator, as 16-bit limbs, lowest first (fixed value).
MULTIPLIER = 2862933555777941757
_LIMBS = [(MULTIPLIER >> (16 * k)) & 0xFFFF for k in range(4)]
#: Steps tried first; a key needs about ln(shards) of them. Keys that need more go on to the exact bound.
FIRST_STEPS = 24


def _bits(value: Column, mask: int) -> Column:
    return value.bitwiseAND(F.lit(mask).cast("long"))


def _next(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * MULTIPLIER + 1 modulo 2^64, in 32-bit halves: a long would overflow, an error in ANSI mode."""
    c0, c1, c2, c3 = (F.lit(c).cast("long") for c in _LIMBS)
    p0, p1 = lo * c0 + 1, lo * c1
    low = _bits(p0, 0xFFFFFFFF) + F.shiftleft(_bits(p1, 0xFFFF), 16)
    carry = F.shiftright(p0, 32) + F.shiftright(p1, 16) + F.shiftright(low, 32)
    high = carry + hi * c0 + F.shiftleft(_bits(hi * c1, 0xFFFF), 16) + lo * c2 + F.shiftleft(_bits(lo * c3, 0xFFFF), 16)
    return _bits(high, 0xFFFFFFFF), _bits(low, 0xFFFFFFFF)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard in [0, shards) of a 64-bit key, by Lamping and Veach's jump consistent hash; null for a null key.

    Each step draws where the key would jump next; the last place below ``shards`` is the answer.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")

    def step(s: Column, _: Column) -> Column:
        hi, lo = _next(s["hi"], s["lo"])
        return let(
            F.struct(hi.alias("hi"), lo.alias("lo")),
            lambda n: F.when(s["j"] >= shards, s).otherwise(
                F.struct(
                    n["hi"].alias("hi"),
                    n["lo"].alias("lo"),
                    s["j"].alias("b"),
                    F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(n["hi"], 1) + 1).cast("double")))
                    .cast("long")
                    .alias("j"),
                )
            ),
        )

    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"),
        _bits(key, 0xFFFFFFFF).alias("lo"),
        F.lit(-1).cast("long").alias("b"),
        F.lit(0).cast("long").alias("j"),
    )
    steps = min(shards, FIRST_STEPS)
    end = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)
    if shards > steps:
        rest = lambda s: F.when(s["j"] >= shards, s).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(shards)), s, step))
        end = let(end, rest)
    return F.when(key.isNotNull(), end["b"].cast("int"))


def assign_shards(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16, buckets: int = 0
) -> DataFrame:
    """A row per document: id, size, text_crc32, law ('key'), shard, slot, grown_shard.

    The id alone decides the shard, so equal texts under different ids spread and a hot text fills no shard.
    Slots are gapless from 0 in each shard. They are numbered in ``buckets`` parts of each shard (0: as
    many as shuffle partitions), whose sizes are counted from the ids alone, so no task sorts a whole shard.

    Null text: no bytes, crc32 0. Null id: one key like another. Very long texts count with all their bytes. Repeated rows: same shard, a slot each.
    Empty table: no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    key = F.xxhash64(docs[id_col])
    rows = docs.select(
        docs[id_col].alias("_id"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        jump_hash(key, shards).alias("shard"),
        jump_hash(key, shards + 1).alias("grown_shard"),
        F.pmod(F.shiftright(key, 7), F.lit(buckets)).cast("int").alias("_part"),
    )
    counts = (
        docs.select(jump_hash(key, shards).alias("shard"), F.pmod(F.shiftright(key, 7), F.lit(buckets)).cast("int").alias("_part"))
        .groupBy("shard", "_part")
        .agg(F.count("*").alias("_n"))
    )
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_part").orderBy("_id", "size", "text_crc32")
    return (
        rows.withColumn("_row", F.row_number().over(inside))
        .join(counts, ["shard", "_part"])
        .select(
            F.col("_id").alias(id_col),
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("_before") + F.col("_row") - 1).cast("long").alias("slot"),
            "grown_shard",
        )
    )
