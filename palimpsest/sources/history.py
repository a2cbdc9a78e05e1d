"""Version history from a log in raw format.

The log is text with a record separator before each commit and unit separators between its fields:
``git log --raw --no-abbrev --format=%x1e%H%x1f%P%x1f%cI%x1f%an%x1f%s``; with ``--numstat`` lines as well if wanted.
Each record is parsed by column expressions, so filters on the result prune early and no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_ID = "0" * 40
#: Modes without content: symbolic links and submodules (fixed values).
NO_CONTENT = ["120000", "160000"]


def commits(spark: SparkSession, path: str) -> DataFrame:
    """file, commit, parents (array), commit_date (as written), ts, author, subject, body (the lines of changes)."""
    raw = spark.read.option("lineSep", "\x1e").text(path).where(F.contains("value", F.lit("\x1f")))
    f = F.split("value", "\x1f", 5)
    tail = F.split(f[4], "\n", 2)
    parents = F.filter(F.split(f[1], " "), lambda p: p != "")
    return raw.select(
        F.col("_metadata.file_path").alias("file"), f[0].alias("commit"), parents.alias("parents"), f[2].alias("commit_date"),
        F.try_to_timestamp(f[2]).alias("ts"), f[3].alias("author"), tail[0].alias("subject"), F.coalesce(F.get(tail, F.lit(1)), F.lit("")).alias("body"),
    )


def changes(log: DataFrame) -> DataFrame:
    """A row per commit and path: status letter, score, modes, blobs, path, old_path (of renames and copies)."""
    line = log.select("file", "commit", "ts", "author", F.posexplode(F.split("body", "\n")).alias("line_no", "line")).where(F.col("line").startswith(":"))
    part = F.split("line", "\t")
    head = F.split(F.substring(part[0], 2, 400), " ")
    two = F.size(part) > 2
    return line.select(
        "file", "commit", "ts", "author", "line_no", F.substring(head[4], 1, 1).alias("status"), F.try_to_number(F.nullif(F.substring(head[4], 2, 3), F.lit("")), F.lit("999")).cast("int").alias("score"),
        head[0].alias("old_mode"), head[1].alias("new_mode"), head[2].alias("old_blob"), head[3].alias("new_blob"),
        F.when(two, F.get(part, F.lit(2))).otherwise(part[1]).alias("path"), F.when(two, part[1]).alias("old_path"),
    )


def numstat(log: DataFrame) -> DataFrame:
    """A row per commit and path: lines added and deleted; null for a binary file."""
    line = log.select("file", "commit", F.explode(F.split("body", "\n")).alias("line")).where(F.col("line").rlike(r"^(\d+|-)\t(\d+|-)\t"))
    part = F.split("line", "\t", 3)
    number = lambda c: F.when(c != "-", c.cast("long"))
    return line.select("file", "commit", number(part[0]).alias("added"), number(part[1]).alias("deleted"), part[2].alias("path"))


def with_content(rows: DataFrame) -> DataFrame:
    """Changes that give a version: no deletes, links, submodules or null blobs."""
    return rows.where((F.col("status") != "D") & ~F.col("new_mode").isin(NO_CONTENT) & (F.col("new_blob") != NULL_ID))


def reflog_refs(spark: SparkSession, path: str) -> DataFrame:
    """Branch names that reflogs speak of: from, to, order within the file."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("ord"), "value")
    moved = r"\tcheckout: moving from (\S+) to (\S+)"
    return raw.where(F.col("value").rlike(moved)).select("file", "ord", F.regexp_extract("value", moved, 1).alias("left"), F.regexp_extract("value", moved, 2).alias("name"))


def merged_branches(log: DataFrame) -> DataFrame:
    """Branch names in the subjects of merges."""
    name = F.coalesce(
        F.nullif(F.regexp_extract("subject", r"^Merge (?:remote-tracking )?branch '([^']+)'", 1), F.lit("")),
        F.nullif(F.regexp_extract("subject", r"^Merge pull request #\d+ from [^/\s]+/(\S+)", 1), F.lit("")),
    )
    return log.select("commit", name.alias("name")).where("name IS NOT NULL")


def plausible_branch(name: Column) -> Column:
    """Whether a name can be a branch's: no commit, no place-holder, and not 'refs/' with nothing of its own behind it. Null is not."""
    name = F.coalesce(name, F.lit(""))
    short = name.startswith("refs/") & ~name.rlike("(?s)/.*/")
    return ~(name.isin("", "HEAD", "-") | name.rlike(r"\A[0-9a-f]{40}\z") | short)
