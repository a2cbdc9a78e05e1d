"""The summary by extension, the identical check with LFS stubs, and file lists looked up in history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rollups import quantiles
from .shared import cut
from .versions import PATH

#: Results of the identical check (fixed values).
RESULTS = ["same_as_latest", "same_as_older", "same_as_other_path", "no_match", "lfs_active_real", "gone", "unreadable"]
#: Columns that only extensions of the binary group have (fixed values).
BINARY_ONLY = [*RESULTS, "at_head_checked", "at_head_unchecked", "versions_to_send", "versions_to_send_all_repos", "gb_to_send_all_repos", "versions_to_send_incl_head"]
GB = 1 << 30


def identical_with_lfs(history_versions: DataFrame, active: DataFrame) -> DataFrame:
    """What each active file equals, where versions may be LFS stubs (``lfs_oid``, ``lfs_bytes``): PATH, active_bytes, result, matched_blob, matched_path, lfs_match, hashed.

    A file whose size neither a version of its repository nor a stub of its path promises is not looked up: hashed is false. Active files have
    ``blob``, ``sha256`` and ``bytes``; those without bytes are gone, those without a hash are unreadable. A file of a path with stubs
    that is none of its versions is the real content: lfs_match says whether of the latest stub, an older one or none.
    """
    key = ["org", "repo"]
    sizes = history_versions.where("bytes IS NOT NULL").select(*key, "bytes").distinct().withColumn("_size", F.lit(True))
    own = history_versions.select(*PATH, "blob", F.col("latest").alias("_latest")).dropDuplicates([*PATH, "blob"])
    stubs = history_versions.where("lfs_oid IS NOT NULL").groupBy(*PATH).agg(F.lit(True).alias("_stubs"))
    promised = history_versions.where("lfs_bytes IS NOT NULL").select(*PATH, F.col("lfs_bytes").alias("bytes")).distinct().withColumn("_promised", F.lit(True))
    oids = history_versions.where("lfs_oid IS NOT NULL").groupBy(*PATH, F.col("lfs_oid").alias("sha256")).agg(F.bool_or("latest").alias("_oid_latest"), F.min_by("blob", F.struct(~F.col("latest"), "blob")).alias("_oid_blob"))
    other = history_versions.groupBy(*key, "blob").agg(F.min("path").alias("_other"))
    rows = active.join(sizes, [*key, "bytes"], "left").join(promised, [*PATH, "bytes"], "left").join(stubs, PATH, "left")
    rows = rows.join(own, [*PATH, "blob"], "left").join(oids, [*PATH, "sha256"], "left").join(other, [*key, "blob"], "left")
    asked = F.coalesce(F.col("_size"), F.col("_promised"), F.lit(False))
    stub = F.coalesce("_stubs", F.lit(False))
    result = (
        F.when(F.col("bytes").isNull(), "gone")
        .when(~asked, F.when(stub, "lfs_active_real").otherwise("no_match"))
        .when(F.col("blob").isNull(), "unreadable")
        .when(F.col("_latest"), "same_as_latest")
        .when(F.col("_latest").isNotNull(), "same_as_older")
        .when(stub, "lfs_active_real")
        .when(F.col("_other").isNotNull(), "same_as_other_path")
        .otherwise("no_match")
    )
    rows = rows.withColumn("result", result).withColumn("hashed", asked & F.col("bytes").isNotNull() & F.col("blob").isNotNull())
    matched = F.when(F.col("result").isin("same_as_latest", "same_as_older", "same_as_other_path"), F.col("blob")).when(F.col("hashed") & (F.col("result") == "lfs_active_real"), F.col("_oid_blob"))
    lfs = F.when(F.col("result") == "lfs_active_real", F.when(~F.col("hashed") | F.col("_oid_latest").isNull(), "none").when(F.col("_oid_latest"), "latest").otherwise("older"))
    return rows.select(*PATH, F.col("bytes").alias("active_bytes"), "result", matched.alias("matched_blob"), F.when(F.col("result") == "same_as_other_path", F.col("_other")).alias("matched_path"), lfs.alias("lfs_match"), "hashed")


def by_extension(files: DataFrame, history_versions: DataFrame, identical: DataFrame, processed: DataFrame) -> DataFrame:
    """The summary of all repositories by extension: ext, group and 32 figures.

    files: PATH, ext, group, vendored, in_history, at_head (null: no active repository), commits, versions, bytes_versions, lfs_versions,
    missing_objects. history_versions: PATH, ext, blob, bytes, lfs_oid. identical: PATH, result. processed: org, repo, blob. Distinct
    contents are counted in steps, per repository and then overall, so no row is expanded. Figures of binary files are null for other groups.
    """
    seen = history_versions.groupBy("org", "repo", "ext", "blob").agg(F.max(F.coalesce("bytes", F.lit(0))).alias("bytes"), F.max("lfs_oid").alias("lfs_oid"))
    done = processed.select("org", "repo", "blob").distinct().withColumn("_done", F.lit(True))
    seen = seen.join(done, ["org", "repo", "blob"], "left").withColumn("send", F.col("_done").isNull() & F.col("lfs_oid").isNull())
    overall = seen.groupBy("ext", "blob").agg(F.max("bytes").alias("bytes"), F.count("*").alias("n"), F.sum("bytes").alias("all_bytes"), F.max(F.when(F.col("send"), F.col("bytes"))).alias("send_bytes"))
    contents = overall.groupBy("ext").agg(
        F.sum("n").alias("versions_per_repo"), F.sum("all_bytes").alias("_repo_bytes"), F.count("*").alias("versions_all_repos"), F.sum("bytes").alias("_bytes"), F.max("bytes").alias("max_bytes"),
        F.count("send_bytes").alias("versions_to_send_all_repos"), F.coalesce(F.sum("send_bytes"), F.lit(0)).alias("_send_bytes"),
    )
    median = quantiles(overall, ["ext"], "bytes", {"m": 0.5}).select("ext", F.floor("m").cast("long").alias("median_bytes"))
    own = history_versions.select(*PATH, "ext", "blob", "lfs_oid").dropDuplicates([*PATH, "blob"]).join(done, ["org", "repo", "blob"], "left")
    send = own.groupBy(*PATH).agg(F.count_if(F.col("_done").isNull() & F.col("lfs_oid").isNull()).alias("_send"))
    rows = files.join(send, PATH, "left").join(identical.select(*PATH, "result").dropDuplicates(PATH), PATH, "left")
    old, head, binary = F.col("in_history"), F.coalesce("at_head", F.lit(False)), F.col("group") == "binary"
    checked = old & binary & head & F.col("result").isNotNull()
    plus = checked & F.col("result").isin("no_match", "lfs_active_real")
    incl = F.when(~old, F.when(binary, 1).otherwise(0)).when(binary, F.col("versions") - F.col("lfs_versions") + plus.cast("int")).otherwise(0)
    total = lambda c, where=old: F.coalesce(F.sum(F.when(where, c)), F.lit(0))
    aggs = {
        "files_in_history": F.count_if(old), "files_at_head": F.count_if(old & head), "files_history_only": F.count_if(old & ~F.coalesce("at_head", F.lit(True))),
        "files_no_active_repo": F.count_if(old & F.col("at_head").isNull()), "files_active_only": F.count_if(~old), "files_vendored": F.count_if(old & (F.coalesce("vendored", F.lit("")) != "")),
        "commits": total(F.col("commits")), "versions_per_file": total(F.col("versions")), "versions_beyond_head": total(F.greatest(F.col("versions") - head.cast("int"), F.lit(0))),
        "_file_bytes": total(F.col("bytes_versions")), "lfs_stub_versions": total(F.col("lfs_versions")), "missing_objects": total(F.col("missing_objects")),
        "at_head_checked": F.count_if(checked), **{r: F.count_if(checked & (F.col("result") == r)) for r in RESULTS}, "at_head_unchecked": F.count_if(old & binary & head & F.col("result").isNull()),
        "versions_to_send": total(F.coalesce("_send", F.lit(0)), old & binary), "versions_to_send_incl_head": F.sum(incl),
    }
    per_repo = rows.groupBy("ext", "group", "org", "repo").agg(*[x.alias(c) for c, x in aggs.items()])
    sums = per_repo.groupBy("ext", "group").agg(F.count("*").alias("repos"), *[F.sum(c).alias(c) for c in aggs])
    out = sums.join(contents, "ext", "left").join(median, "ext", "left")
    gb = lambda c: F.round(F.coalesce(c, F.lit(0)) / GB, 3)
    none = lambda c: F.coalesce(c, F.lit(0))
    out = out.withColumns({
        "gb_per_file": gb(F.col("_file_bytes")), "gb_per_repo": gb(F.col("_repo_bytes")), "gb_all_repos": gb(F.col("_bytes")), "gb_to_send_all_repos": gb(F.col("_send_bytes")),
        **{c: none(F.col(c)) for c in ("versions_per_repo", "versions_all_repos", "median_bytes", "max_bytes", "versions_to_send_all_repos")},
    })
    out = out.withColumns({c: F.when(binary, F.col(c)) for c in BINARY_ONLY})
    columns = ["repos", "files_in_history", "files_at_head", "files_history_only", "files_no_active_repo", "files_active_only", "files_vendored", "commits", "versions_per_file", "versions_beyond_head", "versions_per_repo", "versions_all_repos", "gb_per_file", "gb_per_repo", "gb_all_repos", "median_bytes", "max_bytes", "lfs_stub_versions", "missing_objects", "at_head_checked", *RESULTS, "at_head_unchecked", "versions_to_send", "versions_to_send_all_repos", "gb_to_send_all_repos", "versions_to_send_incl_head"]
    return out.select("ext", "group", *columns)


def listed_history(listed: DataFrame, records: DataFrame, head: DataFrame, repos: DataFrame) -> DataFrame:
    """Rows of a file list with what history has: id, status, matched_path, present_at_head and the columns of ``records``.

    listed: id, org, repo, candidates (paths to try, in order). status: repo_missing (not among ``repos``), bad_row (nothing to try), found (the first
    candidate with a record), in_head_no_history (else the first that is there today), not_found (then the first candidate is named).
    ``head`` has the paths of today; present_at_head is null for repositories that have none. Candidates are computed once.
    """
    key = ["org", "repo"]
    listed = cut(listed.select("id", *key, "candidates", F.size("candidates").alias("_tries")))
    counts = [c for c in records.columns if c not in PATH]
    tried = listed.select("id", *key, F.posexplode("candidates").alias("_pos", "path"))
    now = head.select(*PATH).distinct().withColumn("_now", F.lit(True))
    met = tried.join(records.withColumn("_rec", F.lit(True)), PATH, "left").join(now, PATH, "left")
    place = lambda flag: F.when(F.col(flag), F.col("_pos"))
    choice = F.min(F.struct(place("_rec").isNull().alias("a"), F.when(F.col("_rec").isNull(), place("_now").isNull()).alias("b"), F.col("_pos").alias("c"), F.struct("path", "_rec", "_now", *counts).alias("v")))
    best = met.groupBy("id").agg(choice["v"].alias("v"))
    places = repos.select(*key, F.lit(True).alias("_here"), F.lit(False).alias("_today")).unionByName(head.select(*key, F.lit(False).alias("_here"), F.lit(True).alias("_today")))
    places = places.groupBy(*key).agg(F.bool_or("_here").alias("_here"), F.bool_or("_today").alias("_today"))
    rows = listed.drop("candidates").join(places, key, "left").join(best, "id", "left")
    status = F.when(~F.coalesce("_here", F.lit(False)), "repo_missing").when(F.col("_tries") < 1, "bad_row").when(F.col("v._rec"), "found").when(F.col("v._now"), "in_head_no_history").otherwise("not_found")
    rows = rows.withColumn("status", status)
    shown = F.col("status").isin("found", "in_head_no_history", "not_found")
    at_head = F.when(shown & F.col("_today"), F.coalesce("v._now", F.lit(False)))
    return rows.select("id", "status", F.when(shown, F.col("v.path")).alias("matched_path"), at_head.alias("present_at_head"), *[F.when(F.col("status") == "found", F.col("v")[c]).alias(c) for c in counts])
