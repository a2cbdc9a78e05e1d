"""The corpus pipeline: raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again
as the next one's docs. All but the last return the columns of ``docs``. Rows without a doc_id pass every
stage: they are judged by the quality rules, have no duplicates, lose no passage, are redacted and packed.
Rows that repeat a doc_id count as one document in the two deduplicating stages and are each
kept. Empty tables give empty results. Columns besides doc_id, text and n_chars are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import neardup, packing, quality, secrets, substrings
from palimpsest.llm.common import Scratch, table, vocabulary, written

SEQUENCE = 2048


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the policy go."""
    rows = quality.apply_policy(quality.ledger(docs, keep=docs.columns), "v2")
    return rows.where("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (0.8 of five-word shingles in common) the document with the smallest id stays."""
    rows = neardup.near_duplicates(docs, 80, 5)
    gone = written(rows.where("NOT kept").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document of smaller id has go; so does a document of which nothing is left."""
    rows = substrings.remove_repeats(docs, 50, keep=docs.columns)
    rows = rows.where("n_removed = 0 OR n_removed < n_words")
    text = F.col("rest").alias("text")
    chars = F.when(F.col("n_removed") > 0, F.length("rest")).otherwise(F.col("n_chars")).cast("bigint").alias("n_chars")
    return rows.select([text if c == "text" else chars if c == "n_chars" else F.col(c) for c in docs.columns])


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the document stays."""
    rows = secrets.scan(docs, secrets.train(secrets.labelled_samples(spark)), keep=docs.columns)
    # A generator, so that the redaction is computed once for both columns.
    rows = rows.withColumn("_clean", F.explode(F.array(secrets.redacted(F.col("text"), F.col("spans")))))
    chars = F.when(F.size("spans") > 0, F.length("_clean")).otherwise(F.col("n_chars")).cast("bigint").alias("n_chars")
    return rows.select([F.col("_clean").alias("text") if c == "text" else chars if c == "n_chars" else F.col(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in as few sequences as best fit finds: a row per piece with its place."""
    rows = packing.pieces(docs, vocabulary("word_bpe_49k.json"), SEQUENCE)
    rows = rows.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(rows, packing.Capacity(SEQUENCE, SEQUENCE, SEQUENCE**2), ["doc_id", "piece"])


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicate removal", near_dedup),
    ("substring dedup", substring_dedup),
    ("secret scan", secret_scan),
    ("best-fit packing", best_fit_packing),
]

#: Tokenization cannot be said in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs, hold = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        before = [*hold.paths]
        docs = hold.put(name.replace(" ", "-"), stage(spark, docs, sf_dir))
        if before:  # the stage that read it is written
            hold.drop(*before)
    return STAGES[-1][1](spark, docs, sf_dir)
