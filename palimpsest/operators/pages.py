"""Pages of documents over their versions: each distinct page once, in the order in which it came."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def page_status(pages: DataFrame, today: DataFrame, order: str = "version", least: int = 20) -> DataFrame:
    """The pages with status and merged_page, the page's number among those kept of its path (null if it is not kept).

    ``pages``: path, ``order`` (oldest version first), page, print (a fingerprint), chars; path, version and page tell rows apart. ``today``: path, print of
    the current version. status: in_today (the current version has the page), duplicate (an earlier version or page of the path had it), kept, or kept_ocr_needed
    with fewer than ``least`` characters. First occurrences are minimums, so a print that all versions have costs a row a task. Null prints are a print.
    """
    first = pages.groupBy(F.col("path").alias("_p"), F.col("print").alias("_r")).agg(F.min(F.struct(order, "page")).alias("_first"))
    now = today.select(F.col("path").alias("_tp"), F.col("print").alias("_tr")).distinct().withColumn("_now", F.lit(True))
    met = pages.join(first, F.col("path").eqNullSafe(F.col("_p")) & F.col("print").eqNullSafe(F.col("_r"))).join(now, F.col("path").eqNullSafe(F.col("_tp")) & F.col("print").eqNullSafe(F.col("_tr")), "left")
    kept = F.when(F.coalesce("chars", F.lit(0)) < least, "kept_ocr_needed").otherwise("kept")
    status = F.when(F.col("_now"), "in_today").when(F.struct(order, "page") != F.col("_first"), "duplicate").otherwise(kept)
    met = met.withColumn("status", status)
    is_kept = F.col("status").startswith("kept")
    number = F.sum(is_kept.cast("long")).over(Window.partitionBy("path").orderBy(order, "page").rowsBetween(Window.unboundedPreceding, 0))
    return met.withColumn("merged_page", F.when(is_kept, number)).select(*pages.columns, "status", "merged_page")


def page_counts(status: DataFrame, order: str = "version") -> DataFrame:
    """Per path: versions, pages seen, kept, of these without text, duplicates, pages of today's version, and whether one version stands for all (nothing to merge)."""
    s = F.col("status")
    out = status.groupBy("path").agg(
        F.count_distinct(order).alias("versions"), F.count("*").alias("pages"), F.count_if(s.startswith("kept")).alias("kept"), F.count_if(s == "kept_ocr_needed").alias("ocr_needed"),
        F.count_if(s == "duplicate").alias("duplicates"), F.count_if(s == "in_today").alias("in_today"),
    )
    return out.withColumn("whole_file", (F.col("versions") == 1) & (F.col("kept") == F.col("pages")))
