"""Further queries: file lists against history, branches, runs, steps and set checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palimpsest.functions import paths
from palimpsest.functions.routes import route_of
from palimpsest.operators import lineage

from .catalog import query
from .standins import role, sql

_EXT = "substr(path, strpos(path, '.') + 1)"


@query("j29_renamed_exists", sql("WITH r AS (SELECT DISTINCT repo, path AS renamed_to FROM changes WHERE status = 'R'), l AS (SELECT repo, path, arg_max(status, ord) <> 'D' AS alive FROM changes GROUP BY ALL) SELECT r.repo, renamed_to, coalesce(alive, false) AS exists_today FROM r LEFT JOIN l ON l.repo = r.repo AND l.path = r.renamed_to", "changes"))
def renamed_exists(spark, sf):
    rows = role(spark, sf, "changes")
    moved = rows.where("status = 'R'").select("repo", F.col("path").alias("renamed_to")).distinct()
    alive = rows.groupBy("repo", F.col("path").alias("renamed_to")).agg((F.max_by("status", "ord") != "D").alias("alive"))
    return moved.join(alive, ["repo", "renamed_to"], "left").select("repo", "renamed_to", F.coalesce("alive", F.lit(False)).alias("exists_today"))


@query("j30_history_share", sql("WITH t AS (SELECT repo, count(*) AS files FROM changes GROUP BY repo), g AS (SELECT repo, count(*) AS gone FROM changes WHERE status = 'D' AND bytes > 3000 GROUP BY repo) SELECT t.repo, files, coalesce(gone, 0) AS gone, round(coalesce(gone, 0) * 100.0 / files, 2) AS share FROM t LEFT JOIN g USING (repo)", "changes"))
def history_share(spark, sf):
    rows = role(spark, sf, "changes")
    gone = rows.where("status = 'D' AND bytes > 3000").groupBy("repo").agg(F.count("*").alias("gone"))
    both = rows.groupBy("repo").agg(F.count("*").alias("files")).join(gone, "repo", "left").na.fill(0, ["gone"])
    return both.withColumn("share", F.round(F.col("gone") * 100.0 / F.col("files"), 2))


@query("j31_inventory_vs_manifest", sql("WITH i AS (SELECT repo, count(*) AS inventory FROM active GROUP BY repo), m AS (SELECT repo, count(*) AS manifest FROM manifest GROUP BY repo) SELECT repo, inventory, manifest, manifest - inventory AS gap FROM i JOIN m USING (repo)", "active", "manifest"))
def inventory_vs_manifest(spark, sf):
    a = role(spark, sf, "active").groupBy("repo").agg(F.count("*").alias("inventory"))
    b = role(spark, sf, "manifest").groupBy("repo").agg(F.count("*").alias("manifest"))
    return a.join(b, "repo").withColumn("gap", F.col("manifest") - F.col("inventory"))


@query("j32_at_head_backfill", sql("SELECT org, repo, path, CASE WHEN (SELECT count(*) FROM active r WHERE r.org = c.org AND r.repo = c.repo) = 0 THEN NULL ELSE EXISTS (SELECT 1 FROM active a WHERE a.org = c.org AND a.repo = c.repo AND a.path = c.path) END AS at_head FROM (SELECT DISTINCT org, repo, path FROM changes) c", "changes", "active"))
def at_head_backfill(spark, sf):
    files = role(spark, sf, "changes").select("org", "repo", "path").distinct()
    active = role(spark, sf, "active")
    there = active.select("org", "repo", "path").distinct().withColumn("_a", F.lit(True))
    repos = active.select("org", "repo").distinct().withColumn("_r", F.lit(True))
    rows = files.join(there, ["org", "repo", "path"], "left").join(repos, ["org", "repo"], "left")
    return rows.select("org", "repo", "path", F.when(F.col("_r"), F.coalesce("_a", F.lit(False))).alias("at_head"))


@query("j34_new_contents", sql("SELECT sha, min(path) AS path FROM manifest WHERE ts >= TIMESTAMP '1995-06-01 00:00:00' AND sha NOT IN (SELECT sha FROM manifest WHERE ts < TIMESTAMP '1995-06-01 00:00:00' AND action <> 'failed') GROUP BY sha", "manifest"))
def new_contents(spark, sf):
    rows = role(spark, sf, "manifest")
    before = rows.where("ts < TIMESTAMP '1995-06-01 00:00:00' AND action <> 'failed'").select("sha")
    return rows.where("ts >= TIMESTAMP '1995-06-01 00:00:00'").join(before, "sha", "left_anti").groupBy("sha").agg(F.min("path").alias("path"))


@query("j17_manifest_join", sql("WITH a AS (SELECT repo, path, count(*) AS n FROM manifest GROUP BY ALL), b AS (SELECT repo, path, max(bytes) AS kept FROM manifest WHERE action = 'written' GROUP BY ALL) SELECT a.repo, a.path, n, kept FROM a LEFT JOIN b USING (repo, path)", "manifest"))
def manifest_join(spark, sf):
    rows = role(spark, sf, "manifest")
    delta = rows.where("action = 'written'").groupBy("repo", "path").agg(F.max("bytes").alias("kept"))
    return rows.groupBy("repo", "path").agg(F.count("*").alias("n")).join(delta, ["repo", "path"], "left")


@query("j19_run_validation", sql("WITH a AS (SELECT repo, count(*) AS first_run FROM manifest WHERE bytes > 20000 GROUP BY repo), b AS (SELECT repo, count(*) AS new_run FROM manifest WHERE action <> 'failed' AND repo <> 'repo3' GROUP BY repo) SELECT coalesce(a.repo, b.repo) AS repo, coalesce(first_run, 0) AS first_run, coalesce(new_run, 0) AS new_run, coalesce(first_run, 0) = coalesce(new_run, 0) AS agrees FROM a FULL JOIN b ON a.repo = b.repo", "manifest"))
def run_validation(spark, sf):
    rows = role(spark, sf, "manifest")
    a = rows.where("bytes > 20000").groupBy("repo").agg(F.count("*").alias("first_run"))
    b = rows.where("action <> 'failed' AND repo <> 'repo3'").groupBy("repo").agg(F.count("*").alias("new_run"))
    return a.join(b, "repo", "full_outer").na.fill(0).withColumn("agrees", F.col("first_run") == F.col("new_run"))


@query("j26_stats_chain", sql(f"WITH h AS (SELECT {_EXT} AS ext, count(*) AS history FROM manifest WHERE action <> 'failed' GROUP BY 1), t AS (SELECT {_EXT} AS ext, count(*) AS today FROM manifest WHERE ts >= TIMESTAMP '1995-06-01 00:00:00' GROUP BY 1), s AS (SELECT {_EXT} AS ext, count(DISTINCT sha) AS stored FROM manifest WHERE action = 'written' GROUP BY 1) SELECT coalesce(h.ext, t.ext, s.ext) AS ext, history, today, stored FROM h FULL JOIN t ON h.ext = t.ext FULL JOIN s ON s.ext = coalesce(h.ext, t.ext)", "manifest"))
def stats_chain(spark, sf):
    rows = role(spark, sf, "manifest").withColumn("ext", paths.ext_key(F.col("path")))
    h = rows.where("action <> 'failed'").groupBy("ext").agg(F.count("*").alias("history"))
    t = rows.where("ts >= TIMESTAMP '1995-06-01 00:00:00'").groupBy("ext").agg(F.count("*").alias("today"))
    s = rows.where("action = 'written'").groupBy("ext").agg(F.count_distinct("sha").alias("stored"))
    return h.join(t, "ext", "full_outer").join(s, "ext", "full_outer")


@query("j25_lost_and_resent", sql("WITH l AS (SELECT DISTINCT repo, sha FROM manifest WHERE action = 'failed'), k AS (SELECT DISTINCT sha FROM manifest WHERE action = 'written'), d AS (SELECT DISTINCT sha FROM manifest WHERE action = 'deduped') SELECT l.repo, CASE WHEN k.sha IS NOT NULL THEN 'stored' WHEN d.sha IS NOT NULL THEN 'deduped_only' ELSE 'lost' END AS fate, count(*) AS n FROM l LEFT JOIN k USING (sha) LEFT JOIN d USING (sha) GROUP BY ALL", "manifest"))
def lost_and_resent(spark, sf):
    rows = role(spark, sf, "manifest")
    fate = rows.groupBy("sha").agg(F.bool_or(F.col("action") == "written").alias("k"), F.bool_or(F.col("action") == "deduped").alias("d"))
    lost = rows.where("action = 'failed'").select("repo", "sha").distinct().join(fate, "sha")
    return lost.groupBy("repo", F.when(F.col("k"), "stored").when(F.col("d"), "deduped_only").otherwise("lost").alias("fate")).agg(F.count("*").alias("n"))


@query("j37_stage_per_ext", sql(f"WITH e AS (SELECT *, {_EXT} AS ext FROM manifest), f AS (SELECT repo, ext, count(*) AS files FROM e GROUP BY ALL), s AS (SELECT repo, ext, count(DISTINCT sha) AS sent FROM e WHERE action = 'written' GROUP BY ALL) SELECT repo, ext, files, coalesce(sent, 0) AS sent, CASE WHEN ext IN ('urg', 'hig') THEN 'text' WHEN ext = 'med' THEN 'whole files' ELSE 'not in scope' END AS stage, CASE WHEN ext NOT IN ('urg', 'hig', 'med') THEN '' WHEN sent IS NULL THEN 'nothing sent' ELSE 'sent' END AS state FROM f LEFT JOIN s USING (repo, ext)", "manifest"))
def stage_per_ext(spark, sf):
    """Files of each repository by extension, with the stage that the extension is in and what was sent of it."""
    rows = role(spark, sf, "manifest").withColumn("ext", paths.ext_key(F.col("path")))
    sent = rows.where("action = 'written'").select("repo", "ext", "sha").distinct().groupBy("repo", "ext").agg(F.count("*").alias("sent"))
    both = rows.groupBy("repo", "ext").agg(F.count("*").alias("files")).join(sent, ["repo", "ext"], "left")
    stage = route_of(F.col("ext"), {"text": ["urg", "hig"], "whole files": ["med"]}, "not in scope", "not in scope")
    state = F.when(stage == "not in scope", "").when(F.col("sent").isNull(), "nothing sent").otherwise("sent")
    return both.select("repo", "ext", "files", F.coalesce("sent", F.lit(0)).alias("sent"), stage.alias("stage"), state.alias("state"))


@query("a15_reasons", sql(f"SELECT {_EXT} AS ext, action AS reason, date_part('year', ts) AS year, count(*) AS versions, CAST(sum(bytes) AS BIGINT) AS bytes FROM manifest GROUP BY ALL", "manifest"))
def reasons(spark, sf):
    rows = role(spark, sf, "manifest")
    return rows.groupBy(paths.ext_key(F.col("path")).alias("ext"), F.col("action").alias("reason"), F.year("ts").cast("long").alias("year")).agg(F.count("*").alias("versions"), F.sum("bytes").alias("bytes"))


@query("a20_scope_identity", sql(f"SELECT {_EXT} AS ext, count(*) AS scope, count(*) FILTER (path NOT LIKE 'd1/%' AND path NOT LIKE 'd2/%') AS merged, count(*) FILTER (path LIKE 'd1/%') AS left_vendored, count(*) FILTER (path LIKE 'd2/%') AS left_cache, true AS adds_up FROM manifest GROUP BY 1", "manifest"))
def scope_identity(spark, sf):
    rows = role(spark, sf, "manifest").withColumns({"ext": paths.ext_key(F.col("path")), "why": F.when(F.col("path").like("d1/%"), "vendored").when(F.col("path").like("d2/%"), "cache").otherwise("")})
    out = rows.groupBy("ext").agg(F.count("*").alias("scope"), F.count_if(F.col("why") == "").alias("merged"), F.count_if(F.col("why") == "vendored").alias("left_vendored"), F.count_if(F.col("why") == "cache").alias("left_cache"))
    return out.withColumn("adds_up", F.col("scope") == F.col("merged") + F.col("left_vendored") + F.col("left_cache"))


@query("a30_pack_counts", sql("SELECT pack, count(*) AS rows, count(DISTINCT object) AS objects, CAST(sum(bytes) AS BIGINT) AS bytes FROM packs GROUP BY pack", "packs"))
def pack_counts(spark, sf):
    return role(spark, sf, "packs").groupBy("pack").agg(F.count("*").alias("rows"), F.count_distinct("object").alias("objects"), F.sum("bytes").alias("bytes"))


@query("a31_extraction_summary", sql("WITH p AS (SELECT repo, count(*) AS files, count(DISTINCT sha) AS contents FROM manifest GROUP BY repo) SELECT count(*) AS repos, CAST(floor(quantile_cont(files, 0.5)) AS BIGINT) AS median_files, max(files) AS max_files, round(sum(files) * 1.0 / sum(contents), 4) AS redundancy FROM p", "manifest"))
def extraction_summary(spark, sf):
    per = role(spark, sf, "manifest").groupBy("repo").agg(F.count("*").alias("files"), F.count_distinct("sha").alias("contents"))
    return per.agg(F.count("*").alias("repos"), F.floor(F.percentile("files", F.lit(0.5))).cast("long").alias("median_files"), F.max("files").alias("max_files"), F.round(F.sum("files") / F.sum("contents"), 4).alias("redundancy"))


@query("a22_archive_stats", "SELECT role AS type, count(*) AS members, count(DISTINCT conv_id) AS archives, count(*) FILTER (length(text) < 40) AS small, count(*) FILTER (length(text) >= 40) AS large FROM conversations GROUP BY 1")
def archive_stats(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").groupBy(F.col("role").alias("type"))
    return rows.agg(F.count("*").alias("members"), F.count_distinct("conv_id").alias("archives"), F.count_if(F.length("text") < 40).alias("small"), F.count_if(F.length("text") >= 40).alias("large"))


@query("w04_page_dedup", "WITH f AS (SELECT conv_id, md5(text) AS page, min(turn) AS first FROM conversations GROUP BY ALL) SELECT conv_id, page, first, row_number() OVER (PARTITION BY conv_id ORDER BY first) AS n FROM f")
def page_dedup(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").groupBy("conv_id", F.md5("text").alias("page")).agg(F.min("turn").alias("first"))
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("conv_id").orderBy("first")))


@query(
    "w11_rename_lineage",
    """WITH RECURSIVE r AS (SELECT concat('f', user_id) AS old, concat('f', (user_id + 1) % 150) AS new, event_id AS ord FROM events WHERE event_type = 'purchase'),
    n AS (SELECT *, (SELECT min(b.ord) FROM r b WHERE b.old = a.new AND b.ord > a.ord) AS nx FROM r a),
    w AS (SELECT old, ord, new, nx FROM n UNION ALL SELECT w.old, w.ord, n.new, n.nx FROM w JOIN n ON n.ord = w.nx)
    SELECT old, ord, new AS name FROM w WHERE nx IS NULL""",
)
def rename_lineage(spark, sf):
    """Renames f<u> to f<u + 1 modulo 150>, followed to the end by order."""
    rows = spark.read.parquet(f"{sf}/events.parquet").where("event_type = 'purchase'")
    pairs = rows.select(F.concat(F.lit("f"), "user_id").alias("old"), F.concat(F.lit("f"), (F.col("user_id") + 1) % 150).alias("new"), F.col("event_id").alias("ord"))
    return lineage.current_names(pairs)


@query("t04_custom_order", sql(f"SELECT ext, n, row_number() OVER (ORDER BY CASE ext WHEN 'urg' THEN 0 WHEN 'hig' THEN 1 ELSE 2 END, n DESC, ext) AS place FROM (SELECT {_EXT} AS ext, count(*) AS n FROM manifest GROUP BY 1)", "manifest"))
def custom_order(spark, sf):
    rows = role(spark, sf, "manifest").groupBy(paths.ext_key(F.col("path")).alias("ext")).agg(F.count("*").alias("n"))
    rank = F.when(F.col("ext") == "urg", 0).when(F.col("ext") == "hig", 1).otherwise(2)
    return rows.withColumn("place", F.row_number().over(Window.orderBy(rank, F.desc("n"), "ext")))  # a row per type only


@query("t03_most_common", sql("WITH c AS (SELECT repo, count(*) AS n FROM manifest GROUP BY repo), t AS (SELECT repo, n FROM c ORDER BY n DESC, repo LIMIT 5) SELECT repo, n, (SELECT count(*) FROM c) - 5 AS more FROM t", "manifest"))
def most_common(spark, sf):
    counts = role(spark, sf, "manifest").groupBy("repo").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "repo").limit(5).join(counts.agg((F.count("*") - 5).alias("more")))


@query("t06_top_groups", sql("WITH c AS (SELECT org, sha, count(*) AS copies, row_number() OVER (PARTITION BY org ORDER BY count(*) DESC, sha) AS rn FROM (SELECT org, sha FROM manifest) GROUP BY org, sha) SELECT org, sha, copies FROM c WHERE rn <= 10".replace("row_number() OVER (PARTITION BY org ORDER BY count(*) DESC, sha) AS rn FROM (SELECT org, sha FROM manifest) GROUP BY org, sha)", "0 AS z FROM manifest GROUP BY org, sha), d AS (SELECT *, row_number() OVER (PARTITION BY org ORDER BY copies DESC, sha) AS rn FROM c)").replace("FROM c WHERE rn", "FROM d WHERE rn"), "manifest"))
def top_groups(spark, sf):
    counts = role(spark, sf, "manifest").groupBy("org", "sha").agg(F.count("*").alias("copies"))
    rn = F.row_number().over(Window.partitionBy("org").orderBy(F.desc("copies"), "sha"))
    return counts.withColumn("rn", rn).where("rn <= 10").drop("rn")


@query("u03_history_or_active", sql("SELECT org, repo, path, bool_or(h) AS in_history, bool_or(a) AS in_active FROM (SELECT org, repo, path, true AS h, false AS a FROM changes UNION ALL SELECT org, repo, path, false, true FROM active) GROUP BY ALL", "changes", "active"))
def history_or_active(spark, sf):
    side = lambda n, h: role(spark, sf, n).select("org", "repo", "path", F.lit(h).alias("h"))
    rows = side("changes", True).unionByName(side("active", False))
    return rows.groupBy("org", "repo", "path").agg(F.bool_or("h").alias("in_history"), F.bool_or(~F.col("h")).alias("in_active"))


@query("u07_repo_sides", sql("SELECT coalesce(a.repo, b.repo) AS repo, CASE WHEN b.repo IS NULL THEN 'left' WHEN a.repo IS NULL THEN 'right' ELSE 'both' END AS side FROM (SELECT DISTINCT repo FROM manifest WHERE org = 'org3') a FULL JOIN (SELECT DISTINCT repo FROM changes) b ON a.repo = b.repo", "manifest", "changes"))
def repo_sides(spark, sf):
    a = role(spark, sf, "manifest").where("org = 'org3'").select("repo").distinct().withColumn("l", F.lit(1))
    b = role(spark, sf, "changes").select("repo").distinct().withColumn("r", F.lit(1))
    return a.join(b, "repo", "full_outer").select("repo", F.when(F.col("r").isNull(), "left").when(F.col("l").isNull(), "right").otherwise("both").alias("side"))


@query("p07_actions", sql("SELECT CASE WHEN bytes IS NULL THEN 'missing_object' WHEN bytes = 0 THEN 'empty' WHEN path LIKE 'src/m1/%' THEN 'skipped_vendored' WHEN bytes > 4500 THEN 'too_large' ELSE 'send' END AS action, count(*) AS n FROM changes GROUP BY 1", "changes"))
def actions(spark, sf):
    from palimpsest.functions.buckets import send_action

    vendored = F.when(F.col("path").like("src/m1/%"), "m1").otherwise("")
    rows = role(spark, sf, "changes")
    return rows.groupBy(send_action(F.lit(""), F.col("bytes"), vendored, most=4500, skip_vendored=True).alias("action")).agg(F.count("*").alias("n"))
