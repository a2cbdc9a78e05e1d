"""The queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, languages, licenses, neardup, packing, periods, phrases, quality, secrets, sharding, substrings, topk, warc
from .common import table, vocabulary
from .oracles import ORACLE_SQL  # noqa: F401

SHARDS = 40
SEQUENCE = 2048


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")))
    base = F.lit(quality.mask("base")).cast("long")
    return rows.select(
        "doc_id", *quality.MEASURES[:5], (F.col("failed").bitwiseAND(base) != 0).alias("base_failed"), "kept", F.col("failed").alias("failed_bits")
    )


def op4_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = secrets.train(secrets.labelled_samples(spark))
    rows = secrets.scan(table(spark, sf_dir, "documents"), model)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long")
    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in secrets.KINDS[:3]],
        F.sha2(secrets.rendered(F.col("base")), 256).alias("base_sha256"),
        secrets.rendered(F.col("spans")).alias("spans"),
        "n_random",
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), SEQUENCE)
    rows = rows.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(rows, packing.Capacity(SEQUENCE, SEQUENCE, SEQUENCE**2), ["doc_id", "piece"])


def op6_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.round_trip(table(spark, sf_dir, "pages")).where("kind = 'record'")
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_hamming_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), 85, 5)


def op8_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.remove_repeats(table(spark, sf_dir, "documents"), 50)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    rows = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return rows.select("doc_id", "n_tokens", bpe.digest("ids").alias("ids_sha256"), bpe.digest("decoded").alias("decoded_sha256"))


def op10_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.topk(rows, F.col("vec_id") % 50 == 0, 5)


def op11_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periods.periodic_runs(table(spark, sf_dir, "documents"), plant=True)
    return rows.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.sha2(periods.rendered(), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")
    )


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, most=4, within=80, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_jump_shards": op4_jump_shards,
    "op5_secret_scan": op5_secret_scan,
    "op6_warc_salvage": op6_warc_salvage,
    "op7_hamming_near_dedup": op7_hamming_near_dedup,
    "op8_suffix_tree_dedup": op8_suffix_tree_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_threshold_topk": op10_threshold_topk,
    "op11_nearest_centroid": op11_nearest_centroid,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_phrase_collocations": op13_phrase_collocations,
}

