"""Statistics over inventories, archives, object stores and steps: what reports are made of."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import content, paths, routes

from . import report, rollups, sampling

#: Types of certificates (fixed values).
CERTS = ["pfx", "p7s"]
#: Reasons for which a path in an archive is left out (fixed values, of ``paths.left_out_reason``).
LEFT_OUT = ["vendored", "macos", "docfx_cache"]
#: What a split set is entered as (fixed value).
SPLIT_TYPE = "001"


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def extension_research(files: DataFrame, versions: DataFrame, most: int = 8) -> DataFrame:
    """A profile of each extension.

    ``files``: org, repo, path, ext, in_history, at_head (null: no active copy), vendored (a name, '' if none). ``versions``: ext, bytes, a row for
    each content of a path. Counts of files by where they are, of versions and their sizes (median cut to a whole number), and
    the most common repositories, folders (two levels) and names. Extensions are not null; empty tables give none.
    """
    parts = F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1)
    folder = F.when(F.size(parts) > 0, F.concat(F.array_join(F.slice(parts, 1, 2), "/"), F.lit("/"))).otherwise("(repo root)")
    known = F.col("in_history")
    counts = files.groupBy("ext").agg(
        F.count_if(known).alias("files_in_history"), F.count_if(known & F.col("at_head")).alias("still_active"), F.count_if(known & ~F.col("at_head")).alias("history_only"),
        F.count_if(~known).alias("active_only"), F.count_if(known & (F.coalesce("vendored", F.lit("")) != "")).alias("vendored"),
    )
    repos = files.select("ext", "org", "repo").distinct().groupBy("ext").agg(F.count("*").alias("repos"))
    sizes = rollups.size_stats(versions.where("bytes IS NOT NULL"), ["ext"], "bytes").select("ext", F.col("total").alias("bytes"), F.col("median").alias("median_bytes"), F.col("max").alias("largest_bytes"))
    found = versions.groupBy("ext").agg(F.count("*").alias("versions"))
    top = sampling.most_common(files, ["ext"], {"top_repos": F.concat_ws("/", "org", "repo"), "top_folders": folder, "top_names": F.substring_index("path", "/", -1)}, most)
    out = counts.join(repos, "ext").join(found, "ext", "left").join(sizes, "ext", "left").join(top, "ext", "left")
    return out.na.fill(0, ["versions", "bytes"])


def sampled_versions(versions: DataFrame, contents: DataFrame, k: int, seed: int) -> DataFrame:
    """Up to k versions of each extension, spread over repositories, with what their contents are.

    ``versions``: ext, org, repo, path, blob, of which each (path, blob) is one row of its repository; ``contents``: blob, content. Returns these
    with place, kind ('not read' where the content is missing), signature and the first 200 bytes of a text. Only sampled contents are read into the join.
    """
    picked = sampling.spread_sample(versions.select("ext", "org", "repo", "path", "blob"), ["ext"], ["org", "repo"], ["path", "blob"], k, seed)
    met = picked.join(contents.select("blob", "content").where("content IS NOT NULL").dropDuplicates(["blob"]), "blob", "left")
    read = F.col("content").isNotNull()
    kind = F.when(read, content.kind_of(F.col("content"))).otherwise("not read")
    signature = F.when(read, routes.signature(F.col("content"))).otherwise("")
    preview = F.when(kind == "text", F.make_valid_utf8(F.substring("content", 1, 200).cast("string"))).otherwise("")
    return met.select("ext", "place", "org", "repo", "path", "blob", kind.alias("kind"), signature.alias("signature"), preview.alias("preview"))


def safe_type(ext: Column) -> Column:
    """An extension as a type's name: lower case, letters, digits, '_', '+' and '-', 24 of them; '_noext' if nothing is left."""
    own = F.left(F.regexp_replace(F.lower(F.coalesce(ext, F.lit(""))), "[^a-z0-9_+-]", ""), F.lit(24))
    return F.when(own == "", "_noext").otherwise(own)


def members_by_type(members: DataFrame) -> DataFrame:
    """Files in archives by type, and in total: occurrences, distinct ones with their size, what was not stored, nested archives opened, repositories.

    ``members``: org, repo, inner_path (rows without one are no files in archives), ext, route, action, bytes. A nested archive that was opened
    counts as opened only. The total row (type 'total') has no route, no opened_nested and no repositories.
    """
    action, nested = F.col("action"), F.col("action") == "opened_nested"
    rows = members.where("coalesce(inner_path, '') <> ''").withColumn("type", safe_type(F.col("ext")))
    own = rows.groupBy("type").agg(
        F.min("route").alias("route"), F.count_if(~nested).alias("occurrences"), F.count_if(action == "written").alias("distinct"),
        F.coalesce(F.sum(F.when(action == "written", F.col("bytes"))), F.lit(0)).alias("bytes"), F.count_if(~nested & ~action.isin("written", "deduped")).alias("not_stored"), F.count_if(nested).alias("opened_nested"),
    )
    repos = rows.where(~nested).select("type", "org", "repo").distinct().groupBy("type").agg(F.count("*").alias("repos"))
    own = own.join(repos, "type", "left").na.fill(0, ["repos"])
    total = own.agg(*[F.sum(c).alias(c) for c in ("occurrences", "distinct", "bytes", "not_stored")]).where("occurrences IS NOT NULL")
    out = own.unionByName(total.withColumn("type", F.lit("total")), allowMissingColumns=True)
    return out.select("type", "route", "occurrences", "distinct", F.round(F.col("bytes") / 1e9, 3).alias("gb_distinct"), "not_stored", "opened_nested", "repos")


def archives_by_type(archives: DataFrame, statuses: list[str]) -> DataFrame:
    """Archives by type: versions, files inside, and versions by status; other_status has those of no status listed.

    ``archives``: archive_path, source, status (what follows a colon is its reason), members. A split set adds its files to '001' and is no version: its parts are.
    """
    split = F.col("source") == "split_set"
    rows = archives.select(F.when(split, SPLIT_TYPE).otherwise(paths.ext_key(F.col("archive_path"))).alias("archive_type"), F.when(~F.coalesce(split, F.lit(False)), F.coalesce(F.substring_index("status", ":", 1), F.lit(""))).alias("s"), "members")
    here = F.col("s").isNotNull()
    other = here & ~F.col("s").isin(statuses)
    return rows.groupBy("archive_type").agg(F.count("s").alias("versions"), F.coalesce(F.sum("members"), F.lit(0)).alias("files_inside"), *[F.count_if(F.col("s") == s).alias(s) for s in statuses], F.count_if(other).alias("other_status"))


def archive_problems(archives: DataFrame) -> DataFrame:
    """Archives that were not read whole; a split part is one only if it stands for its set."""
    status = F.coalesce(F.substring_index("status", ":", 1), F.lit(""))
    part = (status == "split_part") & (F.coalesce("source", F.lit("")) != "split_set")
    return archives.where((status != "ok") & ~part)


def archives_by_repo(archives: DataFrame, members: DataFrame) -> DataFrame:
    """Per repository: versions of archives, those opened, files inside; files written, deduped, not stored, and the size written."""
    version = F.coalesce("source", F.lit("")) != "split_set"
    a = archives.groupBy("org", "repo").agg(F.count_if(version).alias("archive_versions"), F.count_if(version & (F.substring_index("status", ":", 1) == "ok")).alias("opened"), F.coalesce(F.sum("members"), F.lit(0)).alias("files_inside"))
    action = F.col("action")
    m = members.where("coalesce(inner_path, '') <> '' AND action <> 'opened_nested'").groupBy("org", "repo").agg(
        F.count_if(action == "written").alias("written"), F.count_if(action == "deduped").alias("deduped"), F.count_if(~action.isin("written", "deduped")).alias("not_stored"), F.coalesce(F.sum(F.when(action == "written", F.col("bytes"))), F.lit(0)).alias("bytes"),
    )
    both = a.alias("a").join(m.alias("m"), _same("a", "m", ["org", "repo"]), "full_outer")
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return both.select(F.coalesce("a.org", "m.org").alias("org"), F.coalesce("a.repo", "m.repo").alias("repo"), *[count(c) for c in ("archive_versions", "opened", "files_inside", "written", "deduped", "not_stored")], F.round(F.coalesce("bytes", F.lit(0)) / 1e9, 3).alias("gb_written"))


def conservation(inside: DataFrame, files: DataFrame, manifest: DataFrame, changes: DataFrame, handled: DataFrame | None = None) -> DataFrame:
    """Per type and step: what came in, what was there before and after, what the step's manifest says, what is new and gone, and whether that adds up.

    ``inside``: unit, type, sha, side ('before' or 'after'); ``files``: type, step, side; ``manifest``: unit, type, step, output (null: the step writes no names);
    ``changes``: type, step, status ('new', 'gone'); ``handled``: type, step, for what a step left out. Steps are not null. A file after that no
    manifest has, or a difference that new and gone do not explain, gives 'CHECK'; types that no step has 'not processed'.

    The sides are counted as one table, so each row is shuffled once at most, and only as counts; outputs count once a unit.
    """
    blank = F.lit(None).cast("string")
    key = lambda df, mark: df.groupBy("type", "step", mark.alias("mark")).agg(F.count("*").alias("n"))
    named = manifest.where("output <> ''").select("unit", "type", "step", "output").distinct()
    tall = [
        key(files, F.concat(F.lit("out_"), "side")), key(named, F.lit("manifest")), key(changes, F.concat(F.lit("delta_"), "status")),
        key(manifest, F.when(F.col("output").isNull(), "no_manifest").otherwise("seen")), *([key(handled, F.lit("seen"))] if handled is not None else []),
    ]
    figure = lambda m: F.coalesce(F.sum(F.when(F.col("mark") == m, F.col("n"))), F.lit(0))
    names = ["out_before", "out_after", "manifest", "delta_new", "delta_gone"]
    steps = reduce(DataFrame.unionByName, tall).groupBy("type", "step").agg(*[figure(n).alias(n) for n in names], (figure("no_manifest") > 0).alias("unnamed"))
    # A content is new in its unit if that did not have it before, whatever its type was then.
    per = inside.groupBy("unit", "sha").agg(F.bool_or(F.col("side") == "before").alias("_old"), F.max(F.when(F.col("side") == "after", F.col("type"))).alias("type"), F.bool_or(F.col("side") == "after").alias("_now"))
    fresh = per.where("_now AND NOT _old").groupBy("type").agg(F.count("*").alias("inside_new_distinct"))
    held = inside.groupBy("type").agg(F.count_if(F.col("side") == "before").alias("inside_before"), F.count_if(F.col("side") == "after").alias("inside_after"))
    held = held.join(fresh, "type", "left")
    both = held.join(steps, "type", "full_outer").na.fill(0, ["inside_before", "inside_after", "inside_new_distinct", *names])
    adds = (F.col("unnamed") | (F.col("out_after") == F.col("manifest"))) & (F.col("out_after") - F.col("out_before") == F.col("delta_new") - F.col("delta_gone"))
    check = F.when(F.col("step").isNull(), "not processed").when(adds, "ok").otherwise("CHECK")
    return both.select(
        "type", F.coalesce("step", F.lit("")).alias("step"), "inside_before", "inside_after", (F.col("inside_after") - F.col("inside_before")).alias("inside_added"), "inside_new_distinct",
        "out_before", "out_after", F.when(F.coalesce("unnamed", F.lit(False)), blank.cast("long")).otherwise(F.col("manifest")).alias("manifest"), "delta_new", "delta_gone", check.alias("check"),
    )


def scope(merged: DataFrame, left_out: DataFrame, sums: list[str]) -> DataFrame:
    """By type and in total: paths and versions in scope, as those merged and those left out by reason. scope = merged + left holds by construction of the rows.

    ``merged``: ext, versions and ``sums``, a row a path; ``left_out``: ext, reason, versions, a row a path. Both are summed before they meet.
    Reasons that are not known are counted in left_other, so that no row goes missing.
    """
    m = merged.groupBy("ext").agg(F.count("*").alias("merged_paths"), F.sum("versions").alias("merged_versions"), *[F.sum(c).alias(c) for c in sums])
    reason = F.when(F.col("reason").isin(LEFT_OUT), F.col("reason")).otherwise("other")
    o = left_out.groupBy("ext").agg(*[F.count_if(reason == r).alias(f"left_{r}") for r in [*LEFT_OUT, "other"]], F.sum("versions").alias("left_versions"))
    figures = ["merged_paths", "merged_versions", *sums, *[f"left_{r}" for r in [*LEFT_OUT, "other"]], "left_versions"]
    both = m.unionByName(o, allowMissingColumns=True).groupBy("ext").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in figures])
    total = both.agg(F.lit("total").alias("ext"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in figures])
    left = reduce(lambda a, b: a + b, [F.col(f"left_{r}") for r in [*LEFT_OUT, "other"]])
    out = both.unionByName(total)
    return out.select("ext", (F.col("merged_paths") + left).alias("scope_paths"), (F.col("merged_versions") + F.col("left_versions")).alias("scope_files"), *figures)


def reason_sections(versions: DataFrame) -> DataFrame:
    """(section, keys, versions, bytes) of what is to be sent: by extension and reason, own or vendored, year, and in total, from one scan.

    ``versions``: ext, why, vendored (a name, '' if none), first_date (text or null), bytes.
    """
    year = F.coalesce(F.left(F.col("first_date").cast("string"), F.lit(4)), F.lit("????"))
    rows = versions.select("ext", "why", F.when(F.coalesce("vendored", F.lit("")) != "", "vendored").otherwise("own").alias("whose"), year.alias("year"), F.coalesce("bytes", F.lit(0)).alias("bytes"))
    named = {"total": [], "reason": ["ext", "why"], "whose": ["ext", "whose"], "year": ["ext", "year"]}
    return report.sections(rows, named, {"versions": F.lit(1), "bytes": F.col("bytes")})


def certificates(files: DataFrame) -> DataFrame:
    """The files of certificates."""
    return files.where(F.col("ext").isin(CERTS))


def lock_files(files: DataFrame) -> DataFrame:
    """Lock files (extension lock) by name in lower case: files, versions, bytes, vendored ones."""
    rows = files.where("ext = 'lock'").groupBy(F.lower(paths.leaf(F.col("path"))).alias("name"))
    return rows.agg(F.count("*").alias("files"), F.sum("versions").alias("versions"), F.sum("bytes").alias("bytes"), F.count_if(F.coalesce("vendored", F.lit("")) != "").alias("vendored"))


def mortality(records: DataFrame, path: str = "path") -> DataFrame:
    """(section, keys, files, gone, commits, chars, lines, mortality): by class, by extension and by top folder ('.' at the top), from one scan.

    ``records``: path, alive, commits, chars, lines, a row a path. ``mortality`` is in whole percent, halves to the even number. Null figures count as 0.
    """
    top = F.when(F.contains(path, F.lit("/")), F.substring_index(path, "/", 1)).otherwise(".")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    rows = records.select(paths.file_class(F.col(path)).alias("class"), paths.ext_or_none(F.col(path)).alias("ext"), top.alias("top"), F.when(F.col("alive"), 0).otherwise(1).alias("gone"), *[zero(c).alias(c) for c in ("commits", "chars", "lines")])
    out = report.sections(rows, {"class": ["class"], "extension": ["ext"], "folder": ["top"]}, {"files": F.lit(1), **{c: F.col(c) for c in ("gone", "commits", "chars", "lines")}})
    return out.withColumn("mortality", F.bround(F.col("gone") * 100.0 / F.col("files")).cast("long"))


def object_stores(objects: DataFrame) -> DataFrame:
    """Per repository the objects of its store: packed and loose ones by type, their sizes, and loose ones that nothing could read (no type).

    ``objects``: repo, object, type, bytes, loose. An object that is loose and packed as well counts as loose, once.
    """
    kinds = {"commit": "commits", "tree": "trees", "blob": "blobs", "tag": "tags"}
    one = objects.groupBy("repo", "object").agg(F.max("type").alias("type"), F.max("bytes").alias("bytes"), F.bool_or("loose").alias("loose"))
    loose, known = F.coalesce("loose", F.lit(False)), F.col("type").isNotNull()
    size = lambda where: F.coalesce(F.sum(F.when(where & known, F.col("bytes"))), F.lit(0))
    figures = [F.count_if(~loose & known).alias("packed_objects"), size(~loose).alias("packed_bytes"), F.count_if(loose).alias("loose_objects"), size(loose).alias("loose_bytes"), F.count_if(loose & ~known).alias("loose_unparsed")]
    for where, name in ((~loose, "packed"), (loose, "loose"), (F.lit(True), "total")):
        figures += [F.count_if(where & (F.col("type") == k)).alias(f"{name}_{v}") for k, v in kinds.items()]
    return one.groupBy("repo").agg(*figures)


def store_files(listed: DataFrame) -> DataFrame:
    """Per repository its packs and loose objects, by the names of files below its objects folder, and their size on disk.

    ``listed``: repo, rel (path below the folder objects), bytes. Indexes, and what lies in info, are neither.
    """
    pack, loose = F.col("rel").rlike(r"\Apack/[^/]+\.pack\z"), F.col("rel").rlike(r"\A(?!pack/|info/)[^/]{2}/[^/]+\z")
    size = lambda where: F.coalesce(F.sum(F.when(where, F.col("bytes"))), F.lit(0))
    return listed.groupBy("repo").agg(F.count_if(pack).alias("packs"), F.count_if(loose).alias("loose"), size(pack).alias("pack_bytes"), size(loose).alias("loose_bytes"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def repacked(before: DataFrame, after: DataFrame) -> DataFrame:
    """What repacking did to each repository: listings of its objects folder before and after, as ``store_files`` takes them.

    Sizes in MB (10^6 bytes, two places); 'not_run' where a repository has no listing after, 'new' where it has none before.
    """
    a, b = store_files(before).alias("a"), store_files(after).alias("b")
    both = a.join(b, F.col("a.repo").eqNullSafe(F.col("b.repo")), "full_outer")
    mb = lambda c: F.round(c / 1e6, 2)
    status = F.when(F.col("b.packs").isNull(), "not_run").when(F.col("a.packs").isNull(), "new").when(F.col("b.loose") > 0, "loose_left").otherwise("ok")
    return both.select(
        F.coalesce("a.repo", "b.repo").alias("repo"), mb(F.col("a.bytes")).alias("size_before_mb"), mb(F.col("b.bytes")).alias("size_after_mb"), mb(F.col("a.bytes") - F.col("b.bytes")).alias("reclaimed_mb"),
        F.col("a.packs").alias("packs_before"), F.col("b.packs").alias("packs_after"), F.col("a.loose").alias("loose_before"), F.col("b.loose").alias("loose_after"), status.alias("status"),
    )


def path_list(files: DataFrame, versions: DataFrame) -> DataFrame:
    """Each path of the history once: commits, first and last date over its versions, last event, whether it is there today, sizes, vendored.

    ``files``: org, repo, path, ext, in_history, commits, last_event, at_head, latest_bytes, max_bytes, vendored; ``versions``: org, repo, path, first_date, last_date.
    """
    dates = versions.groupBy("org", "repo", "path").agg(F.min(F.least("first_date", "last_date")).alias("first_date"), F.max(F.greatest("first_date", "last_date")).alias("last_date"))
    met = files.where("in_history").alias("f").join(dates.alias("d"), _same("f", "d", ["org", "repo", "path"]), "left")
    own = [f"f.{c}" for c in ("org", "repo", "path", "ext", "commits")]
    return met.select(*own, "d.first_date", "d.last_date", "f.last_event", "f.at_head", "f.latest_bytes", "f.max_bytes", (F.coalesce("f.vendored", F.lit("")) != "").alias("vendored"))


def path_list_by_extension(listed: DataFrame) -> DataFrame:
    """A path list by extension with a total: repositories (counted anew in the total), paths, commits, those still there, vendored ones."""
    flag = lambda c: F.when(c, 1).otherwise(0)
    sums = {"paths": F.lit(1), "commits": F.coalesce("commits", F.lit(0)), "still_today": flag(F.col("at_head")), "vendored": flag(F.col("vendored"))}
    return rollups.with_totals(listed.withColumn("_repo", F.struct("org", "repo")), "ext", sums, {"repos": F.col("_repo")})


def explained_counts(files: DataFrame, inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Why more files were written than an inventory lists: (kind, files, pct) of the written ones, and each repository's gap.

    ``files``: org, repo, path, output (empty or null: not written), at_head (null: not known); ``inventory``: org, repo, listed. The second table has the repositories
    of both: written, vendored, not_at_head, own_at_head (written less the two before: about what an inventory can see), listed, gap.
    """
    rows = files.where("coalesce(output, '') <> ''").withColumn("_own", paths.vendor_of(F.col("path")) == "")
    head = F.when(F.col("at_head"), "at HEAD").when(~F.col("at_head"), "not at HEAD").otherwise("HEAD unknown")
    kinds = rollups.distribution(rows, F.concat_ws(", ", F.when(F.col("_own"), "own code").otherwise("vendored"), head), "kind").withColumnRenamed("n", "files")
    gone = F.coalesce(~F.col("at_head"), F.lit(False))
    per = rows.groupBy("org", "repo").agg(F.count("*").alias("written"), F.count_if(~F.col("_own")).alias("vendored"), F.count_if(gone).alias("not_at_head"), (F.count("*") - F.count_if(~F.col("_own")) - F.count_if(gone)).alias("own_at_head"))
    both = per.join(inventory.groupBy("org", "repo").agg(F.max("listed").alias("listed")), ["org", "repo"])
    return kinds, both.withColumn("gap", F.col("written") - F.col("listed"))
