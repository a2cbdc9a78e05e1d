"""Queries on changes, versions, active state and lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions import buckets, paths
from palimpsest.operators import lines, versions

from .catalog import query
from .standins import role, sql

_EXT = "CASE WHEN path LIKE '%.%' THEN substr(path, strpos(path, '.') + 1) ELSE '' END"


@query(
    "version_levels",
    sql(
        f"""WITH f AS (SELECT {_EXT} AS ext, org, repo, path, blob, max(bytes) AS bytes FROM changes WHERE status <> 'D' GROUP BY ALL),
        r AS (SELECT ext, org, repo, blob, max(bytes) AS bytes FROM f GROUP BY ALL), g AS (SELECT ext, blob, max(bytes) AS bytes FROM r GROUP BY ALL)
        SELECT a.*, b.versions_by_repo, b.bytes_by_repo, c.versions, c.bytes, c.median_bytes, c.max_bytes FROM
        (SELECT ext, count(*) AS versions_by_file, CAST(sum(bytes) AS BIGINT) AS bytes_by_file FROM f GROUP BY ext) a
        JOIN (SELECT ext, count(*) AS versions_by_repo, CAST(sum(bytes) AS BIGINT) AS bytes_by_repo FROM r GROUP BY ext) b USING (ext)
        JOIN (SELECT ext, count(*) AS versions, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(floor(quantile_cont(bytes, 0.5)) AS BIGINT) AS median_bytes, max(bytes) AS max_bytes FROM g GROUP BY ext) c USING (ext)""",
        "changes",
    ),
)
def version_levels(spark, sf):
    return versions.levels(role(spark, sf, "changes"), paths.ext_key(F.col("path")))


@query(
    "a02_repo_ext",
    sql(
        f"""SELECT org, repo, {_EXT} AS ext, count(DISTINCT path) AS files, count(DISTINCT blob) AS contents, count(*) AS changes
        FROM changes GROUP BY ALL""",
        "changes",
    ),
)
def repo_ext(spark, sf):
    rows = role(spark, sf, "changes")
    return rows.groupBy("org", "repo", paths.ext_key(F.col("path")).alias("ext")).agg(
        F.count_distinct("path").alias("files"), F.count_distinct("blob").alias("contents"), F.count("*").alias("changes")
    )


_FILES = """SELECT org, repo, path, count(*) AS changes, count(DISTINCT commit) AS commits, count(DISTINCT CASE WHEN status <> 'D' THEN blob END) AS versions,
    min(ord) AS first_ord, arg_max(blob, ord) FILTER (status <> 'D') AS latest_blob, arg_max(status, ord) AS last_event, max(ord) AS last_ord FROM changes GROUP BY ALL"""


@query("s03_files", sql(_FILES, "changes"))
def files(spark, sf):
    return versions.files(role(spark, sf, "changes"))


_VERSIONS = """SELECT *, last_ord = max(last_ord) OVER (PARTITION BY org, repo, path) AS latest FROM (SELECT org, repo, path, blob, max(bytes) AS bytes, count(*) AS commits,
    arg_min(commit, ord) AS first_commit, min(ord) AS first_ord, arg_max(commit, ord) AS last_commit, max(ord) AS last_ord FROM changes WHERE status <> 'D' GROUP BY ALL)"""


@query("a11_versions", sql(_VERSIONS, "changes"))
def version_rows(spark, sf):
    return versions.versions(role(spark, sf, "changes"))


@query("a10_latest_version", sql("SELECT org, repo, path, arg_max(blob, ord) AS blob, max(ord) AS ord FROM changes WHERE status <> 'D' GROUP BY ALL", "changes"))
def latest_version(spark, sf):
    rows = role(spark, sf, "changes").where("status <> 'D'")
    return rows.groupBy("org", "repo", "path").agg(F.max_by("blob", "ord").alias("blob"), F.max("ord").alias("ord"))


@query(
    "a09_first_last_by_time",
    sql("SELECT org, repo, path, arg_min(commit, (ts, ord)) AS first_commit, arg_max(commit, (ts, ord)) AS last_commit FROM changes GROUP BY ALL", "changes"),
)
def first_last(spark, sf):
    return versions.first_and_last_by_time(role(spark, sf, "changes"))


@query("w01_nth_change", sql("SELECT org, repo, path, ord, status, row_number() OVER (PARTITION BY org, repo, path ORDER BY ord) AS nth FROM changes", "changes"))
def nth_change(spark, sf):
    return versions.nth_change(role(spark, sf, "changes")).select("org", "repo", "path", "ord", "status", "nth")


@query(
    "a04_churn",
    sql(
        """SELECT org, repo, path, count(DISTINCT commit) AS commits, count(DISTINCT author) AS authors, count(*) FILTER (status = 'A') AS n_a, count(*) FILTER (status = 'M') AS n_m,
        count(*) FILTER (status = 'D') AS n_d, count(*) FILTER (status = 'R') AS n_r, count(*) FILTER (status = 'T') AS n_t, CAST(sum(added) AS BIGINT) AS added,
        CAST(sum(deleted) AS BIGINT) AS deleted, min(ts) AS first_date, max(ts) AS last_date FROM changes GROUP BY ALL""",
        "changes",
    ),
)
def churn(spark, sf):
    return versions.churn(role(spark, sf, "changes"))


@query(
    "a05_folder_churn",
    sql(
        """WITH d AS (SELECT org, repo, path, commit, unnest(['.', 'src', 'src/' || split_part(path, '/', 2)]) AS folder FROM changes)
        SELECT org, repo, folder, count(DISTINCT commit) AS commits, count(*) AS changes, count(DISTINCT path) AS files FROM d GROUP BY ALL""",
        "changes",
    ),
)
def folder_churn(spark, sf):
    return versions.folder_churn(role(spark, sf, "changes"), paths.ancestors(F.col("path")))


@query(
    "a06_inventory_churn",
    sql(
        """SELECT path, CAST(sum(added) AS BIGINT) AS added, CAST(sum(deleted) AS BIGINT) AS deleted,
        round(abs(sum(added) - sum(deleted)) / CAST(greatest(sum(added), sum(deleted)) AS DOUBLE), 4) AS symmetry, date_diff('day', min(ts)::DATE, max(ts)::DATE) AS lifespan FROM changes GROUP BY path""",
        "changes",
    ),
)
def inventory_churn(spark, sf):
    rows = versions.churn(role(spark, sf, "changes"))
    return rows.select("path", "added", "deleted", buckets.symmetry(F.col("added"), F.col("deleted")).alias("symmetry"), F.datediff("last_date", "first_date").cast("long").alias("lifespan"))


@query(
    "w12_lifecycle",
    sql(
        """SELECT org, repo, path, arg_max(status, ord) AS last_event, arg_max(commit, ord) AS last_commit, count(*) FILTER (status = 'D') AS deletes,
        arg_max(status, ord) <> 'D' AS alive FROM changes GROUP BY ALL""",
        "changes",
    ),
)
def lifecycle(spark, sf):
    return versions.lifecycle(role(spark, sf, "changes"))


@query(
    "a08_removals",
    sql(
        """WITH l AS (SELECT org, repo, path, arg_max(status, ord) AS s, arg_max(ts, ord) AS ts FROM changes GROUP BY ALL)
        SELECT repo, s AS status, date_part('month', ts) AS month, count(*) AS n FROM l GROUP BY GROUPING SETS ((repo), (s), (month))""",
        "changes",
    ),
)
def removals(spark, sf):
    rows = role(spark, sf, "changes").groupBy("org", "repo", "path").agg(F.max_by("status", "ord").alias("status"), F.month(F.max_by("ts", "ord")).cast("long").alias("month"))
    return rows.groupingSets([[F.col("repo")], [F.col("status")], [F.col("month")]], "repo", "status", "month").agg(F.count("*").alias("n"))


@query(
    "w03_numbered_contents",
    sql(
        """WITH f AS (SELECT org, repo, path, blob, min(ord) AS first_ord FROM changes WHERE status <> 'D' GROUP BY ALL),
        o AS (SELECT org, repo, blob, arg_min(path, first_ord) AS owner FROM f GROUP BY ALL)
        SELECT f.*, row_number() OVER (PARTITION BY f.org, f.repo, f.path ORDER BY first_ord) AS n, owner FROM f JOIN o USING (org, repo, blob)""",
        "changes",
    ),
)
def numbered_contents(spark, sf):
    return versions.numbered_contents(role(spark, sf, "changes"))


@query(
    "j02_active_state",
    sql(
        f"""WITH h AS ({_FILES}), r AS (SELECT DISTINCT org, repo, true AS has FROM active)
        SELECT coalesce(h.org, a.org) AS org, coalesce(h.repo, a.repo) AS repo, coalesce(h.path, a.path) AS path, h.commits, h.latest_blob, a.blob AS active_blob,
        CASE WHEN EXISTS (SELECT 1 FROM r WHERE r.org = coalesce(h.org, a.org) AND r.repo = coalesce(h.repo, a.repo)) THEN a.path IS NOT NULL END AS at_head, h.path IS NOT NULL AS in_history
        FROM h FULL JOIN active a ON h.org = a.org AND h.repo = a.repo AND h.path = a.path""",
        "changes", "active",
    ),
)
def active_state(spark, sf):
    rows = versions.active_state(versions.files(role(spark, sf, "changes")), role(spark, sf, "active"))
    return rows.select("org", "repo", "path", "commits", "latest_blob", "active_blob", "at_head", "in_history")


_IDENTICAL = f"""v AS ({_VERSIONS}), o AS (SELECT org, repo, blob, min(path) AS other_path FROM v GROUP BY ALL),
    idn AS (SELECT a.org, a.repo, a.path, a.blob, a.bytes, CASE WHEN v.latest THEN 'same_as_latest' WHEN v.latest IS NOT NULL THEN 'same_as_older'
    WHEN o.other_path IS NOT NULL THEN 'same_as_other_path' ELSE 'no_match' END AS result, coalesce(CASE WHEN v.latest IS NOT NULL THEN a.path END, o.other_path) AS matched_path
    FROM active a LEFT JOIN v ON v.org = a.org AND v.repo = a.repo AND v.path = a.path AND v.blob = a.blob LEFT JOIN o ON o.org = a.org AND o.repo = a.repo AND o.blob = a.blob)"""


@query("j03_identical", sql(f"WITH {_IDENTICAL} SELECT * FROM idn", "changes", "active"))
def identical(spark, sf):
    return versions.identical(versions.versions(role(spark, sf, "changes")), role(spark, sf, "active"))


@query(
    "j04_to_send",
    sql(f"WITH v AS ({_VERSIONS}) SELECT org, repo, path, blob, bytes FROM v WHERE NOT EXISTS (SELECT 1 FROM processed p WHERE p.repo = v.repo AND p.blob = v.blob)", "changes", "processed"),
)
def to_send(spark, sf):
    rows = versions.to_send(versions.versions(role(spark, sf, "changes")), role(spark, sf, "processed"))
    return rows.select("org", "repo", "path", "blob", "bytes")


@query(
    "j05_assumed_processed",
    sql(
        f"""WITH v AS ({_VERSIONS}), p AS (SELECT repo, blob FROM processed WHERE repo <> 'repo2' UNION SELECT repo, blob FROM v WHERE latest AND repo = 'repo2')
        SELECT repo, count(*) AS left_over FROM v WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.repo = v.repo AND p.blob = v.blob) GROUP BY repo""",
        "changes", "processed",
    ),
)
def assumed_processed(spark, sf):
    """Where the second pass is missing (repo2), the latest contents count as processed."""
    v = versions.versions(role(spark, sf, "changes"))
    known = role(spark, sf, "processed").where("repo <> 'repo2'").unionByName(v.where("latest AND repo = 'repo2'").select("repo", "blob"))
    return versions.to_send(v, known).groupBy("repo").agg(F.count("*").alias("left_over"))


@query(
    "f30_why_sent",
    sql(
        f"""WITH {_IDENTICAL}, v2 AS ({_VERSIONS}), r AS (SELECT DISTINCT org, repo FROM active)
        SELECT w AS why, act AS action, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes FROM (SELECT v2.bytes, CASE WHEN r.repo IS NULL THEN 'no_active_repo' WHEN i.path IS NULL THEN 'history_only'
        WHEN i.result IN ('same_as_latest', 'same_as_older', 'same_as_other_path') THEN 'older_version' WHEN i.result = 'no_match' THEN 'active_differs' ELSE 'active_unreadable' END AS w,
        CASE WHEN v2.bytes = 0 THEN 'empty' WHEN v2.bytes > 4000 THEN 'too_large' ELSE 'send' END AS act
        FROM v2 LEFT JOIN idn i ON i.org = v2.org AND i.repo = v2.repo AND i.path = v2.path LEFT JOIN r ON r.org = v2.org AND r.repo = v2.repo) GROUP BY ALL""",
        "changes", "active",
    ),
)
def why_sent(spark, sf):
    v, active = versions.versions(role(spark, sf, "changes")), role(spark, sf, "active")
    found = versions.identical(v, active).select("org", "repo", "path", "result")
    repos = active.select("org", "repo").distinct().withColumn("_has", F.lit(True))
    rows = v.join(found, ["org", "repo", "path"], "left").join(repos, ["org", "repo"], "left")
    at_head = F.when(F.col("_has"), F.col("result").isNotNull())
    action = buckets.send_action(F.lit(""), F.col("bytes"), F.lit(""), most=4000)
    return rows.groupBy(buckets.why_sent(at_head, F.col("result")).alias("why"), action.alias("action")).agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


_LINES = "l AS (SELECT source, doc_id, unnest(generate_series(0, len(s) - 1)) AS line_no, trim(unnest(s)) AS line FROM (SELECT source, doc_id, string_split(text, chr(10)) AS s FROM documents)), ll AS (SELECT * FROM l WHERE line <> '')"


def _texts(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("source", "doc_id", "text")


@query("w02_line_first_seen", f"WITH {_LINES} SELECT source, line, min((doc_id, line_no)).doc_id AS doc_id, min((doc_id, line_no)).line_no AS line_no FROM (SELECT source, line, doc_id, line_no FROM ll) GROUP BY source, line".replace("min((doc_id, line_no))", "min({'doc_id': doc_id, 'line_no': line_no})"))
def line_first_seen(spark, sf):
    rows = lines.first_seen(lines.lines(_texts(spark, sf), "text", ["source", "doc_id"]), ["source"], ["doc_id", "line_no"])
    return rows.withColumn("line_no", F.col("line_no").cast("long"))


_CURRENT = "SELECT ll.* FROM ll JOIN (SELECT source, max(doc_id) AS doc_id FROM documents GROUP BY source) USING (source, doc_id)"


def _marked(spark, sf):
    """The texts, and in ``newest`` whether each is the current version of its source."""
    texts = _texts(spark, sf)
    newest = texts.groupBy("source").agg(F.max("doc_id").alias("doc_id")).withColumn("newest", F.lit(True))
    return texts.join(newest, ["source", "doc_id"], "left")


@query("j06_line_delta", f"WITH {_LINES}, c AS ({_CURRENT}) SELECT DISTINCT source, line FROM ll WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.source = ll.source AND c.line = ll.line)")
def line_delta(spark, sf):
    return lines.text_delta(_marked(spark, sf), "text", ["source"], F.col("newest"))


@query(
    "a19_line_delta_counts",
    f"""WITH {_LINES}, c AS ({_CURRENT}), h AS (SELECT DISTINCT source, line FROM ll), k AS (SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.source = h.source AND c.line = h.line)),
    s AS (SELECT d.source, (SELECT count(*) FROM h WHERE h.source = d.source) AS lines_history, (SELECT count(DISTINCT line) FROM c WHERE c.source = d.source) AS lines_current,
    (SELECT count(*) FROM k WHERE k.source = d.source) AS lines_kept FROM (SELECT DISTINCT source FROM documents) d)
    SELECT *, lines_history - lines_kept AS lines_removed, CASE WHEN lines_history = 0 THEN 'no_history' WHEN lines_current = 0 THEN 'no_current' WHEN lines_kept = 0 THEN 'nothing_left'
    WHEN lines_kept = lines_history THEN 'unchanged' ELSE 'reduced' END AS action FROM s""",
)
def line_delta_counts(spark, sf):
    return lines.delta_counts(_marked(spark, sf), "text", ["source"], F.col("newest"))


@query(
    "f51_measure_blob",
    """SELECT doc_id, strlen(text) AS bytes, length(text) AS chars, len(s) AS lines, list_max(list_transform(s, lambda x: length(x))) AS max_line,
    round(list_avg(list_transform(s, lambda x: length(x))), 1) AS avg_line FROM (SELECT doc_id, text, string_split(text, chr(10)) AS s FROM documents)""",
)
def measure_blob(spark, sf):
    s = F.transform(F.split("text", "\n", -1), lambda x: F.length(x))
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.octet_length("text").alias("bytes"), F.length("text").alias("chars"), s.alias("s"))
    avg = F.aggregate("s", F.lit(0), lambda a, x: a + x) / F.size("s")
    return rows.select("doc_id", F.col("bytes").cast("long").alias("bytes"), F.col("chars").cast("long").alias("chars"), F.size("s").cast("long").alias("lines"), F.array_max("s").cast("long").alias("max_line"), F.round(avg, 1).alias("avg_line"))
