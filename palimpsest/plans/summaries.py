"""Queries on the summary by extension, the identical check with stubs, file lists, object streams and strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions import paths, routes, strings
from palimpsest.operators import identity, listing, report, shared, summary, trees
from palimpsest.sources import objects
from palimpsest.streaming import contents

from .catalog import query
from .standins import role, sql

_EXT = "CASE WHEN path LIKE '%.%' THEN substr(path, strpos(path, '.') + 1) ELSE '' END"
_VERSIONS = """v AS (SELECT *, last_ord = max(last_ord) OVER (PARTITION BY org, repo, path) AS latest FROM (SELECT org, repo, path, blob, max(bytes) AS bytes, max(lfs_oid) AS lfs_oid, max(lfs_bytes) AS lfs_bytes, max(ord) AS last_ord FROM lfs_changes WHERE status <> 'D' GROUP BY ALL))"""
_IDENTICAL = """i AS (SELECT a.org, a.repo, a.path, a.bytes AS active_bytes, a.blob, a.sha256,
EXISTS (SELECT 1 FROM v WHERE v.org = a.org AND v.repo = a.repo AND v.bytes = a.bytes) OR EXISTS (SELECT 1 FROM v WHERE v.org = a.org AND v.repo = a.repo AND v.path = a.path AND v.lfs_bytes = a.bytes) AS asked,
EXISTS (SELECT 1 FROM v WHERE v.org = a.org AND v.repo = a.repo AND v.path = a.path AND lfs_oid IS NOT NULL) AS stub,
(SELECT bool_or(latest) FROM v WHERE v.org = a.org AND v.repo = a.repo AND v.path = a.path AND v.blob = a.blob) AS own,
(SELECT bool_or(latest) FROM v WHERE v.org = a.org AND v.repo = a.repo AND v.path = a.path AND v.lfs_oid = a.sha256) AS oid,
(SELECT min(blob) FROM v WHERE v.org = a.org AND v.repo = a.repo AND v.path = a.path AND v.lfs_oid = a.sha256) AS oid_blob,
(SELECT min(path) FROM v WHERE v.org = a.org AND v.repo = a.repo AND v.blob = a.blob) AS other FROM lfs_active a),
r AS (SELECT *, asked AND active_bytes IS NOT NULL AND blob IS NOT NULL AS hashed, CASE WHEN active_bytes IS NULL THEN 'gone' WHEN NOT asked THEN CASE WHEN stub THEN 'lfs_active_real' ELSE 'no_match' END WHEN blob IS NULL THEN 'unreadable'
WHEN own THEN 'same_as_latest' WHEN own IS NOT NULL THEN 'same_as_older' WHEN stub THEN 'lfs_active_real' WHEN other IS NOT NULL THEN 'same_as_other_path' ELSE 'no_match' END AS result FROM i)"""


def _versions(spark, sf):
    from pyspark.sql.window import Window

    rows = role(spark, sf, "lfs_changes").where("status <> 'D'").groupBy("org", "repo", "path", "blob").agg(*[F.max(c).alias(c) for c in ("bytes", "lfs_oid", "lfs_bytes")], F.max("ord").alias("last_ord"))
    return rows.withColumn("latest", F.col("last_ord") == F.max("last_ord").over(Window.partitionBy("org", "repo", "path")))


@query(
    "j03_identical_lfs",
    sql(f"WITH {_VERSIONS}, {_IDENTICAL} SELECT org, repo, path, active_bytes, result, CASE WHEN result IN ('same_as_latest', 'same_as_older', 'same_as_other_path') THEN blob WHEN hashed AND result = 'lfs_active_real' THEN oid_blob END AS matched_blob, CASE WHEN result = 'same_as_other_path' THEN other END AS matched_path, CASE WHEN result = 'lfs_active_real' THEN CASE WHEN NOT hashed OR oid IS NULL THEN 'none' WHEN oid THEN 'latest' ELSE 'older' END END AS lfs_match, hashed FROM r", "lfs_changes", "lfs_active"),
)
def identical_lfs(spark, sf):
    return summary.identical_with_lfs(_versions(spark, sf), role(spark, sf, "lfs_active"))


_GROUP = "CASE WHEN ext IN ('csv', '') THEN 'binary' ELSE 'text' END"
_FILES = f"""h AS (SELECT org, repo, path, count(DISTINCT commit) AS commits, count(DISTINCT CASE WHEN status <> 'D' THEN blob END) AS versions, count(DISTINCT CASE WHEN status <> 'D' AND lfs_oid IS NOT NULL THEN blob END) AS lfs_versions FROM lfs_changes GROUP BY ALL),
b AS (SELECT org, repo, path, CAST(sum(bytes) AS BIGINT) AS bytes_versions FROM v GROUP BY ALL),
f AS (SELECT *, {_GROUP} AS "group" FROM (SELECT coalesce(h.org, a.org) AS org, coalesce(h.repo, a.repo) AS repo, coalesce(h.path, a.path) AS path, {_EXT.replace('path', 'coalesce(h.path, a.path)')} AS ext, h.path IS NOT NULL AS in_history,
CASE WHEN coalesce(h.repo, a.repo) IN (SELECT repo FROM lfs_active) THEN a.path IS NOT NULL END AS at_head, h.commits, h.versions, h.lfs_versions, b.bytes_versions FROM h FULL JOIN lfs_active a ON a.org = h.org AND a.repo = h.repo AND a.path = h.path LEFT JOIN b ON b.org = h.org AND b.repo = h.repo AND b.path = h.path)),
p AS (SELECT DISTINCT repo, blob FROM processed),
s AS (SELECT org, repo, path, count(*) FILTER (lfs_oid IS NULL AND NOT EXISTS (SELECT 1 FROM p WHERE p.repo = v.repo AND p.blob = v.blob)) AS send FROM v GROUP BY ALL),
x AS (SELECT f.*, s.send, r.result, f.at_head AND f.in_history AND f."group" = 'binary' AND r.result IS NOT NULL AS checked FROM f LEFT JOIN s USING (org, repo, path) LEFT JOIN r USING (org, repo, path)),
e AS (SELECT org, repo, {_EXT} AS ext, blob, max(bytes) AS bytes, max(lfs_oid) AS oid FROM v GROUP BY ALL),
o AS (SELECT ext, blob, max(bytes) AS bytes, count(*) AS n, sum(bytes) AS all_bytes, max(bytes) FILTER (oid IS NULL AND NOT EXISTS (SELECT 1 FROM p WHERE p.repo = e.repo AND p.blob = e.blob)) AS send_bytes FROM e GROUP BY ALL),
c AS (SELECT ext, CAST(sum(n) AS BIGINT) AS versions_per_repo, sum(all_bytes) AS repo_bytes, count(*) AS versions_all_repos, sum(bytes) AS all_bytes, max(bytes) AS max_bytes, count(send_bytes) AS versions_to_send_all_repos, coalesce(sum(send_bytes), 0) AS send_bytes, CAST(floor(quantile_cont(bytes, 0.5)) AS BIGINT) AS median_bytes FROM o GROUP BY ext)"""
_SUMS = """SELECT ext, "group", count(DISTINCT (org, repo)) AS repos, count(*) FILTER (in_history) AS files_in_history, count(*) FILTER (in_history AND at_head) AS files_at_head, count(*) FILTER (in_history AND NOT at_head) AS files_history_only,
count(*) FILTER (in_history AND at_head IS NULL) AS files_no_active_repo, count(*) FILTER (NOT in_history) AS files_active_only, count(*) FILTER (in_history AND path LIKE 'src/m1/%') AS files_vendored,
CAST(coalesce(sum(commits), 0) AS BIGINT) AS commits, CAST(coalesce(sum(versions), 0) AS BIGINT) AS versions_per_file, CAST(coalesce(sum(greatest(versions - CASE WHEN at_head THEN 1 ELSE 0 END, 0)), 0) AS BIGINT) AS versions_beyond_head,
round(coalesce(sum(bytes_versions), 0) / 1073741824, 3) AS gb_per_file, CAST(coalesce(sum(lfs_versions), 0) AS BIGINT) AS lfs_stub_versions, CAST(0 AS BIGINT) AS missing_objects"""


def _binary(column: str, figure: str) -> str:
    return f"CASE WHEN \"group\" = 'binary' THEN {figure} END AS {column}"


_SUMS += ", " + ", ".join(
    [_binary("at_head_checked", "count(*) FILTER (checked)"), *[_binary(r, f"count(*) FILTER (checked AND result = '{r}')") for r in summary.RESULTS],
     _binary("at_head_unchecked", "count(*) FILTER (in_history AND at_head AND result IS NULL)"), _binary("versions_to_send", "CAST(coalesce(sum(send) FILTER (in_history), 0) AS BIGINT)"),
     _binary("versions_to_send_incl_head", "CAST(sum(CASE WHEN NOT in_history THEN 1 ELSE versions - lfs_versions + CASE WHEN checked AND result IN ('no_match', 'lfs_active_real') THEN 1 ELSE 0 END END) AS BIGINT)")]
) + ' FROM x GROUP BY ext, "group"'


@query(
    "a01_by_extension",
    sql(f"""WITH {_VERSIONS}, {_IDENTICAL}, {_FILES}, t AS ({_SUMS}) SELECT t.*, coalesce(versions_per_repo, 0) AS versions_per_repo, coalesce(versions_all_repos, 0) AS versions_all_repos, round(coalesce(repo_bytes, 0) / 1073741824, 3) AS gb_per_repo, round(coalesce(all_bytes, 0) / 1073741824, 3) AS gb_all_repos,
    coalesce(median_bytes, 0) AS median_bytes, coalesce(max_bytes, 0) AS max_bytes, {_binary('versions_to_send_all_repos', 'coalesce(versions_to_send_all_repos, 0)')}, {_binary('gb_to_send_all_repos', 'round(coalesce(send_bytes, 0) / 1073741824, 3)')} FROM t LEFT JOIN c USING (ext)""", "lfs_changes", "lfs_active", "processed"),
)
def by_extension(spark, sf):
    """All 34 columns; files of .csv and without an extension stand for binary ones."""
    changes, active = role(spark, sf, "lfs_changes"), role(spark, sf, "lfs_active")
    versions = _versions(spark, sf).withColumn("ext", paths.ext_key(F.col("path")))
    key = ["org", "repo", "path"]
    # Distinct counts in steps: a row per path and commit, and the versions, a row per path and content.
    commits = changes.select(*key, "commit").distinct().groupBy(*key).agg(F.count("*").alias("commits"))
    counts = versions.groupBy(*key).agg(F.count("*").alias("versions"), F.count("lfs_oid").alias("lfs_versions"), F.sum("bytes").alias("bytes_versions"))
    history = commits.join(counts, key, "left").na.fill(0, ["versions", "lfs_versions"]).withColumn("in_history", F.lit(True))
    now = active.select(*key, F.lit(True).alias("_now"))
    repos = active.select("org", "repo").distinct().withColumn("_has", F.lit(True))
    files = history.join(now, key, "full_outer").join(repos, ["org", "repo"], "left")
    ext = paths.ext_key(F.col("path"))
    files = files.withColumns({
        "in_history": F.coalesce("in_history", F.lit(False)), "at_head": F.when(F.col("_has"), F.coalesce("_now", F.lit(False))), "ext": ext, "group": F.when(ext.isin("csv", ""), "binary").otherwise("text"),
        "vendored": F.when(F.col("path").like("src/m1/%"), "m1"), "missing_objects": F.lit(0),
    })
    processed = role(spark, sf, "processed").join(repos.drop("_has").unionByName(changes.select("org", "repo")).distinct(), "repo")
    return summary.by_extension(files, versions, summary.identical_with_lfs(versions, active), processed)


_LIST = """fl AS (SELECT c_custkey AS id, org, repo, CASE WHEN c_nationkey = 5 THEN NULL ELSE concat(folder, '/', name) END AS path FROM (SELECT c_custkey, c_nationkey, concat('org', c_custkey % 7 % 3) AS org, CASE WHEN c_nationkey = 9 THEN 'other' ELSE concat('repo', c_custkey % 7) END AS repo, CASE WHEN c_nationkey = 11 THEN 'lib' ELSE concat('src/m', c_custkey % 4) END AS folder, concat('f', c_custkey, CASE c_custkey % 5 WHEN 0 THEN '.py' WHEN 1 THEN '.java' WHEN 2 THEN '.txt' WHEN 3 THEN '' ELSE '.csv' END) AS name FROM customer))"""


@query(
    "j01_file_list_history",
    sql(f"""WITH {_LIST}, h AS (SELECT org, repo, path, count(*) AS touched, count(*) FILTER (status = 'A') AS added, count(*) FILTER (status NOT IN ('A', 'D', 'R')) AS modified, count(*) FILTER (status = 'D') AS deleted, count(*) FILTER (status = 'R') AS renamed,
    arg_min(commit, (ts, ord)) AS first_commit, min(ts) AS first_change, arg_max(commit, (ts, ord)) AS last_commit, max(ts) AS last_change, arg_max(status, (ts, ord)) AS last_status FROM changes GROUP BY ALL),
    k AS (SELECT org, repo FROM changes UNION SELECT org, repo FROM active), x AS (SELECT fl.*, (org, repo) IN (SELECT (org, repo) FROM k) AS here, (org, repo) IN (SELECT (org, repo) FROM active) AS today, (org, repo, path) IN (SELECT (org, repo, path) FROM active) AS now FROM fl),
    s AS (SELECT x.id, x.path, today, now, h.* EXCLUDE (org, repo, path), CASE WHEN NOT here THEN 'repo_missing' WHEN x.path IS NULL THEN 'bad_row' WHEN touched IS NOT NULL THEN 'found' WHEN now THEN 'in_head_no_history' ELSE 'not_found' END AS status FROM x LEFT JOIN h USING (org, repo, path))
    SELECT id, status, CASE WHEN status IN ('found', 'in_head_no_history', 'not_found') THEN path END AS matched_path, CASE WHEN status IN ('found', 'in_head_no_history', 'not_found') AND today THEN coalesce(now, false) END AS present_at_head, * EXCLUDE (id, status, path, today, now) FROM s""", "changes", "active"),
)
def file_list_history(spark, sf):
    """Rows name their file in three ways: whole path, folder and name, path with organisation and repository in front; some name none."""
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(k, nation).repartition(k)  # a small file is one task's, its candidates need not be
    org, repo = F.concat(F.lit("org"), k % 7 % 3), F.when(nation == 9, "other").otherwise(F.concat(F.lit("repo"), k % 7))
    name = F.when(nation == 5, "").otherwise(F.concat(F.lit("f"), k, F.expr("CASE c_custkey % 5 WHEN 0 THEN '.py' WHEN 1 THEN '.java' WHEN 2 THEN '.txt' WHEN 3 THEN '' ELSE '.csv' END")))
    folder = F.when(nation == 11, "lib").otherwise(F.concat(F.lit("src/m"), k % 4))
    rel = F.when(k % 3 == 0, F.concat_ws("/", folder, name)).when(k % 3 == 1, F.concat(F.lit("./"), folder)).otherwise(F.concat_ws("\\", F.lit("x"), org, F.upper(repo), F.translate(folder, "/", "\\"), name))
    listed = rows.select(k.alias("id"), org.alias("org"), repo.alias("repo"), paths.candidates(F.when(nation == 5, "").otherwise(rel), name, org, repo).alias("candidates"))
    changes, active = role(spark, sf, "changes"), role(spark, sf, "active")
    records = identity.record_counts(changes.withColumn("old_path", F.lit(None).cast("string")), ["org", "repo"])
    # Without renames every repository with a change has a record.
    return summary.listed_history(listed, records, active, records.select("org", "repo").unionByName(active.select("org", "repo")))


@query("s09_object_stream", "SELECT sha1(concat('blob ', strlen(text), chr(0), text)) AS id, strlen(text) AS size, count(*) AS copies, true AS ok FROM documents WHERE text IS NOT NULL GROUP BY ALL")
def object_stream(spark, sf):
    """The texts as a stream of objects, read back by index and ranges; each content has to have its id."""
    texts = spark.read.parquet(f"{sf}/documents.parquet").where("text IS NOT NULL").select(F.col("text").cast("binary").alias("c"))
    head = F.concat(F.concat_ws(" ", F.lit("blob"), F.octet_length("c").cast("string")).cast("binary"), F.unhex(F.lit("00")))
    folder = shared.scratch(spark)
    # The text writer ends each value with a line feed, as the stream does.
    texts.select(F.concat_ws("\n", F.concat_ws(" ", F.sha1(F.concat(head, "c")), F.lit("blob"), F.octet_length("c").cast("string")), F.col("c").cast("string")).alias("value")).write.text(folder)
    files = spark.read.format("binaryFile").load(folder).select("path")
    found = objects.verified(objects.objects(files, piece=1 << 30))
    return found.groupBy("id", F.col("size")).agg(F.count("*").alias("copies"), F.bool_and("ok").alias("ok"))


@query("f39_strings", r"SELECT page_id, CAST(len(s) AS INTEGER) AS n, md5(array_to_string(s, '|')) AS digest FROM (SELECT page_id, regexp_extract_all(html, '(?:[\x20-\x7e]|[^\x00-\x7f]){4,}') AS s FROM pages)")
def strings_in_pages(spark, sf):
    found = strings.mined(F.col("html").cast("binary"))
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", F.explode(F.array(found)).alias("s")).select("page_id", F.size("s").alias("n"), F.md5(F.array_join("s", "|")).alias("digest"))


_ROUTES = {"code": ["py", "java"], "table": ["csv"], "text": ["txt", "csv"]}


@query("f28_routes", sql(f"WITH e AS (SELECT DISTINCT path, {_EXT} AS ext FROM changes) SELECT CASE WHEN ext IN ('py', 'java') THEN 'code' WHEN ext = 'csv' THEN 'table' WHEN ext = 'txt' THEN 'text' WHEN ext = '' THEN 'no_extension' ELSE 'other' END AS route, CASE WHEN ext = 'txt' THEN 'text' WHEN ext = 'csv' THEN 'binary' ELSE 'other' END AS \"group\", count(*) AS files FROM e GROUP BY ALL", "changes"))
def file_routes(spark, sf):
    files = role(spark, sf, "changes").select("path").distinct().select(paths.ext_key(F.col("path")).alias("ext"))
    return files.groupBy(routes.route_of(F.col("ext"), _ROUTES).alias("route"), routes.group_of(F.col("ext"), ["txt"], ["csv"]).alias("group")).agg(F.count("*").alias("files"))


@query(
    "a42_type_routes",
    ("SELECT ext AS type, CASE WHEN o_orderkey % 3 = 0 THEN 'log' ELSE '-' END AS inner, count(*) FILTER (status = 'ok') AS text, count(*) FILTER (status = 'binary' AND NOT prog) AS whole, count(*) FILTER (status = 'binary' AND prog) AS left_out, count(*) FILTER (status = 'failed') AS no_text FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'ok' WHEN 'F' THEN 'binary' ELSE 'failed' END AS status, CASE WHEN o_orderkey % 5 = 0 THEN 'deploy' WHEN o_orderkey % 5 = 1 THEN 'db_backup' ELSE 'txt' END AS ext, o_orderkey % 5 = 0 AND o_orderkey % 3 = 1 AS prog FROM orders) GROUP BY ALL").replace("ELSE '-' END AS inner", "WHEN o_orderkey % 5 = 0 AND o_orderkey % 3 = 1 THEN 'dll' ELSE '-' END AS inner"),
)
def type_routes(spark, sf):
    k = F.col("o_orderkey")
    inner = F.when(k % 3 == 0, ".LOG.v2").when((k % 5 == 0) & (k % 3 == 1), ".dll.v3").otherwise("")
    ext = F.when(k % 5 == 0, "deploy").when(k % 5 == 1, "DB_backup").otherwise("txt")
    status = F.when(F.col("o_orderstatus") == "O", "ok").when(F.col("o_orderstatus") == "F", "binary").otherwise("failed")
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(F.concat(F.lit("a.b/f"), k, inner, F.lit("."), ext).alias("path"), status.alias("status"))
    return listing.routes_by_type(rows)


@query("s19_active_files", "SELECT concat('org', c_nationkey % 3) AS org, concat('repo', c_nationkey) AS repo, ext, count(*) AS files FROM (SELECT c_nationkey, CASE WHEN c_acctbal < 0 THEN 'py' ELSE 'md' END AS ext FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) GROUP BY ALL")
def active_copy(spark, sf):
    """Files below a root as a listing gives them; what lies in folders .git is no part of an active copy."""
    rows = spark.read.parquet(f"{sf}/customer.parquet")
    folder = F.when(F.col("c_mktsegment") == "BUILDING", ".git/objects").when(F.col("c_mktsegment") == "MACHINERY", "lib/sub/.git").otherwise("lib/x.git")
    name = F.concat(F.lit("f"), "c_custkey", F.when(F.col("c_acctbal") < 0, ".py").otherwise(".MD"))
    listed = rows.select(F.concat_ws("/", F.lit("file:/data/root"), F.concat(F.lit("org"), F.col("c_nationkey") % 3), F.concat(F.lit("repo"), "c_nationkey"), folder, name).alias("path"))
    return listing.active_files(listing.below(listed, "/data/root")).groupBy("org", "repo", "ext").agg(F.count("*").alias("files"))


@query("s31_inventory", sql("SELECT unit, regexp_extract(path, '^(.*)/[^/]*$', 1) AS relpath, regexp_extract(path, '([^/]*)$', 1) AS filename FROM (SELECT DISTINCT unit, path FROM new_files)", "new_files"))
def tree_inventory(spark, sf):
    """A file list made from the newest trees."""
    roots, entries = trees.store(role(spark, sf, "new_files"), ["unit"])
    return listing.inventory(trees.listed(roots, entries), ["unit"])


_SECTIONS = {"total": [], "extension": ["ext"], "repository": ["org", "repo"], "reason": ["ext", "action"]}
_REPORT = f"""m AS (SELECT *, {_EXT} AS ext FROM manifest), s AS (SELECT sha, max(bytes) AS size, org, repo, ext, action, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM m GROUP BY ALL)"""


def _one(section: str, columns: list[str]) -> str:
    keys = " || ' | ' || ".join(columns) or "''"
    by = "".join(f", {c}" for c in columns)
    return f"SELECT '{section}' AS section, {keys} AS keys, CAST(sum(files) AS BIGINT) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS contents, CAST(sum(size) AS BIGINT) AS content_sum FROM (SELECT sha{by}, sum(files) AS files, sum(bytes) AS bytes, max(size) AS size FROM s GROUP BY ALL) GROUP BY ALL"


@query("a40_sections", sql(f"WITH {_REPORT} {' UNION ALL '.join(_one(n, c) for n, c in _SECTIONS.items())}", "manifest"))
def report_sections(spark, sf):
    """Total, by extension, by repository and by reason: files, bytes, and each content once in its group."""
    rows = role(spark, sf, "manifest").withColumn("ext", paths.ext_key(F.col("path")))
    return report.sections(rows, _SECTIONS, {"files": F.lit(1), "bytes": F.col("bytes")}, "sha", "bytes")


@query("a40_cross_check", sql(f"WITH {_REPORT}, e AS ({_one('extension', ['ext'])}), o AS (SELECT {_EXT} AS ext, count(*) AS files, count(DISTINCT sha) AS contents FROM manifest WHERE action <> 'failed' GROUP BY 1) SELECT e.keys AS ext, f AS figure, CASE f WHEN 'files' THEN e.files ELSE e.contents END :: DECIMAL(38, 3) AS report, CASE f WHEN 'files' THEN o.files ELSE o.contents END :: DECIMAL(38, 3) AS other, coalesce(CASE f WHEN 'files' THEN e.files = o.files ELSE e.contents = o.contents END, false) AS same FROM e FULL JOIN o ON o.ext = e.keys, unnest(['files', 'contents']) t(f)", "manifest"))
def report_check(spark, sf):
    """The report's figures by extension against those of what did not fail: they differ where something failed."""
    rows = role(spark, sf, "manifest").withColumn("ext", paths.ext_key(F.col("path")))
    own = report.sections(rows, {"extension": ["ext"]}, {"files": F.lit(1)}, "sha").select(F.col("keys").alias("ext"), "files", "contents")
    other = rows.where("action <> 'failed'").groupBy("ext").agg(F.count("*").alias("files"), F.count_distinct("sha").alias("contents"))
    return report.cross_check(own, other, ["ext"], ["files", "contents"])


@query("r10_content_owners", sql("SELECT sha, CAST(min(ord) AS BIGINT) AS ord, arg_min(path, ord) AS path FROM manifest GROUP BY sha", "manifest"))
def content_owners(spark, sf):
    """Contents taken in by three batches, the later units first; each is owned by the first unit that has it."""
    store = shared.scratch(spark)
    ends = [F.lit(True), F.col("ts") < F.lit("1997-01-01").cast("timestamp"), F.col("ts") < F.lit("1994-01-01").cast("timestamp")]
    timed = role(spark, sf, "manifest").select("sha", "ord", "path", "ts")
    for number, (before, since) in enumerate(zip(ends, [*ends[1:], F.lit(False)], strict=True)):
        contents.add_batch(timed.where(before & ~since).select("sha", "ord", "path"), number, store, ["sha"], ["ord"])
    return contents.owners(spark, store, ["sha"], ["ord"])
