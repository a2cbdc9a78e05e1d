"""Version model: what a table of changes says about files, versions and contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .rollups import quantiles

PATH = ["org", "repo", "path"]


def files(changes: DataFrame) -> DataFrame:
    """A row per path: commits, versions, first, latest and last event by order of commits (not by date), contents without deletes.

    Deletes and changes without content are counted as commits but give no version.
    """
    content = F.when(F.col("status") != "D", F.col("blob"))
    return changes.groupBy(*PATH).agg(
        F.count("*").alias("changes"),
        F.countDistinct("commit").alias("commits"),
        F.countDistinct(content).alias("versions"),
        F.min("ord").alias("first_ord"),
        F.max_by("blob", F.when(F.col("status") != "D", F.col("ord"))).alias("latest_blob"),
        F.max_by("status", "ord").alias("last_event"),
        F.max("ord").alias("last_ord"),
    )


def versions(changes: DataFrame) -> DataFrame:
    """A row per path and distinct content: commits, first and last commit by order, whether it is the latest."""
    rows = changes.where(F.col("status") != "D").groupBy(*PATH, "blob").agg(
        F.max("bytes").alias("bytes"),
        F.count("*").alias("commits"),
        F.min_by("commit", "ord").alias("first_commit"),
        F.min("ord").alias("first_ord"),
        F.max_by("commit", "ord").alias("last_commit"),
        F.max("ord").alias("last_ord"),
    )
    newest = F.max("last_ord").over(Window.partitionBy(*PATH))
    return rows.withColumn("latest", F.col("last_ord") == newest)


def levels(changes: DataFrame, ext: Column) -> DataFrame:
    """Distinct contents of each extension at three grains: per file, per repository, overall; with sizes and median.

    One shuffle to (ext, repo, path, blob), then two smaller ones: no row is expanded for several distinct counts.
    """
    per_file = changes.where(F.col("status") != "D").groupBy(ext.alias("ext"), *PATH, "blob").agg(F.max("bytes").alias("bytes"))
    per_repo = per_file.groupBy("ext", "org", "repo", "blob").agg(F.max("bytes").alias("bytes"), F.count("*").alias("n_file"), F.sum("bytes").alias("file_bytes"))
    overall = per_repo.groupBy("ext", "blob").agg(
        F.max("bytes").alias("bytes"), F.sum("n_file").alias("n_file"), F.sum("file_bytes").alias("file_bytes"), F.count("*").alias("n_repo"), F.sum("bytes").alias("repo_bytes")
    )
    sums = overall.groupBy("ext").agg(
        F.sum("n_file").alias("versions_by_file"),
        F.sum("n_repo").alias("versions_by_repo"),
        F.count("*").alias("versions"),
        F.sum("file_bytes").alias("bytes_by_file"),
        F.sum("repo_bytes").alias("bytes_by_repo"),
        F.sum("bytes").alias("bytes"),
        F.max("bytes").alias("max_bytes"),
    )
    median = quantiles(overall, ["ext"], "bytes", {"m": 0.5}).select("ext", F.floor("m").cast("long").alias("median_bytes"))
    return sums.join(median, "ext", "left").select(*sums.columns[:-1], "median_bytes", "max_bytes")


def active_state(history: DataFrame, active: DataFrame) -> DataFrame:
    """Files of history with ``at_head`` (null: the repository has no active copy) and the active copy's files that history lacks."""
    repos = active.select("org", "repo").distinct().withColumn("_has", F.lit(True))
    now = active.select(*PATH, F.col("blob").alias("active_blob"), F.col("bytes").alias("active_bytes"), F.lit(True).alias("_now"))
    both = history.withColumn("_old", F.lit(True)).join(now, PATH, "full_outer").join(repos, ["org", "repo"], "left")
    at_head = F.when(F.col("_has"), F.coalesce("_now", F.lit(False)))
    return both.select(*PATH, *[c for c in history.columns if c not in PATH], "active_blob", "active_bytes", at_head.alias("at_head"), F.col("_old").isNotNull().alias("in_history")).drop("_has", "_now", "_old")


def identical(history_versions: DataFrame, active: DataFrame) -> DataFrame:
    """What each active file equals: its path's latest version, an older one, another path of its repository, or nothing.

    Contents are only looked up for files whose size some version of the repository has.
    """
    sizes = history_versions.select("org", "repo", "bytes").distinct()
    may = active.join(sizes, ["org", "repo", "bytes"], "left_semi")
    own = history_versions.select(*PATH, "blob", F.col("latest").alias("own_latest"))
    other = history_versions.groupBy("org", "repo", "blob").agg(F.min("path").alias("other_path"))
    found = may.join(own, [*PATH, "blob"], "left").join(other, ["org", "repo", "blob"], "left")
    result = (
        F.when(F.col("own_latest"), "same_as_latest")
        .when(F.col("own_latest").isNotNull(), "same_as_older")
        .when(F.col("other_path").isNotNull(), "same_as_other_path")
    )
    found = found.select(*PATH, result.alias("result"), F.coalesce(F.when(F.col("own_latest").isNotNull(), F.col("path")), F.col("other_path")).alias("matched_path"))
    return active.join(found, PATH, "left").select(*PATH, "blob", "bytes", F.coalesce("result", F.lit("no_match")).alias("result"), "matched_path")


def to_send(history_versions: DataFrame, processed: DataFrame) -> DataFrame:
    """Versions whose content the same repository has not processed; other repositories do not count."""
    return history_versions.join(processed.select("repo", "blob").distinct(), ["repo", "blob"], "left_anti")


def churn(changes: DataFrame) -> DataFrame:
    """Per path: changes by status, commits, authors, lines added and deleted, first and last date."""
    by = {s: F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in "AMDRT"}
    return changes.groupBy(*PATH).agg(
        F.countDistinct("commit").alias("commits"), F.countDistinct("author").alias("authors"), *by.values(),
        F.sum("added").alias("added"), F.sum("deleted").alias("deleted"), F.min("ts").alias("first_date"), F.max("ts").alias("last_date"),
    )


def folder_churn(changes: DataFrame, folders: Column) -> DataFrame:
    """Per folder, ancestors included: distinct commits, changes, distinct files.

    Changes are counted per path and commit before they are spread over the folders.
    """
    pairs = changes.groupBy(*PATH, "commit").agg(F.count("*").alias("n"))
    spread = pairs.select("org", "repo", "path", "commit", "n", F.explode(folders).alias("folder"))
    return spread.groupBy("org", "repo", "folder").agg(F.countDistinct("commit").alias("commits"), F.sum("n").alias("changes"), F.countDistinct("path").alias("files"))


def first_and_last_by_time(changes: DataFrame) -> DataFrame:
    """First and last commit of each path by time; ties go to the first and to the last in order."""
    return changes.groupBy(*PATH).agg(
        F.min_by("commit", F.struct("ts", "ord")).alias("first_commit"), F.max_by("commit", F.struct("ts", "ord")).alias("last_commit")
    )


def nth_change(changes: DataFrame) -> DataFrame:
    """Each change with its running number on its path."""
    return changes.withColumn("nth", F.row_number().over(Window.partitionBy(*PATH).orderBy("ord")))


def numbered_contents(changes: DataFrame) -> DataFrame:
    """Distinct contents of a path, oldest first, numbered from 1; ``owner``: the first path of the repository with the content."""
    first = changes.where(F.col("status") != "D").groupBy(*PATH, "blob").agg(F.min("ord").alias("first_ord"))
    own = Window.partitionBy(*PATH).orderBy("first_ord")
    owners = first.groupBy("org", "repo", "blob").agg(F.min_by("path", "first_ord").alias("owner"))
    return first.withColumn("n", F.row_number().over(own)).join(owners, ["org", "repo", "blob"])


def lifecycle(changes: DataFrame) -> DataFrame:
    """Last event of each path, gone or alive, and how often it went."""
    return changes.groupBy(*PATH).agg(
        F.max_by("status", "ord").alias("last_event"), F.max_by("commit", "ord").alias("last_commit"), F.count_if(F.col("status") == "D").alias("deletes")
    ).withColumn("alive", F.col("last_event") != "D")
