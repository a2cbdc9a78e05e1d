"""Queries for rollups, distributions, dedup reports, functions and plans."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palimpsest.functions import buckets, content, paths
from palimpsest.operators import dedup, planning, rollups
from palimpsest.sources.binaries import split_part_status

from .catalog import query
from .standins import role, sql

_EXT = "substr(path, strpos(path, '.') + 1)"


@query(
    "a39_ext_rollup",
    sql(f"SELECT coalesce(e, 'total') AS ext, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS files, count(DISTINCT repo) AS repos FROM (SELECT {_EXT} AS e, * FROM manifest) GROUP BY ROLLUP (e)", "manifest"),
)
def ext_rollup(spark, sf):
    rows = role(spark, sf, "manifest").withColumn("ext", paths.ext_key(F.col("path")))
    return rollups.with_totals(rows, "ext", {"bytes": F.col("bytes"), "files": F.lit(1)}, {"repos": F.col("repo")})


@query(
    "a03_all_extension_counts",
    sql(f"SELECT {_EXT} AS ext, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, max(bytes) AS max_bytes, count(DISTINCT repo) AS repos FROM manifest GROUP BY ext", "manifest"),
)
def extension_counts(spark, sf):
    rows = role(spark, sf, "manifest").withColumn("ext", paths.ext_key(F.col("path")))
    return rows.groupBy("ext").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("max_bytes"), F.count_distinct("repo").alias("repos"))


@query(
    "a13_nearest_rank",
    """WITH r AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) AS rn, count(*) OVER (PARTITION BY lang) AS n FROM documents)
    SELECT lang, max(n_chars) FILTER (rn = least(n, floor(n * 0.5) + 1)) AS median, max(n_chars) FILTER (rn = least(n, floor(n * 0.9) + 1)) AS p90,
    max(n_chars) FILTER (rn = least(n, floor(n * 0.99) + 1)) AS p99, max(n) AS n FROM r GROUP BY lang""",
)
def nearest_rank(spark, sf):
    return rollups.nearest_rank(spark.read.parquet(f"{sf}/documents.parquet"), ["lang"], "n_chars", {"median": 0.5, "p90": 0.9, "p99": 0.99})


@query(
    "a12_size_stats",
    """SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS total, CAST(floor(quantile_cont(n_chars, 0.5)) AS BIGINT) AS median, round(quantile_cont(n_chars, 0.25), 4) AS p25,
    round(quantile_cont(n_chars, 0.5), 4) AS p50, round(quantile_cont(n_chars, 0.75), 4) AS p75, round(quantile_cont(n_chars, 0.9), 4) AS p90, max(n_chars) AS max FROM documents GROUP BY lang""",
)
def size_stats(spark, sf):
    return rollups.size_stats(spark.read.parquet(f"{sf}/documents.parquet"), ["lang"], "n_chars")


@query("a14_value_histogram", "SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1")
def histogram(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet").groupBy(F.col("o_orderpriority").alias("value")).agg(F.count("*").alias("n"))


@query("a17_original_occurrence", sql("SELECT sha, min({'ts': ts, 'org': org, 'repo': repo, 'path': path, 'ord': ord}).ts AS ts, min({'ts': ts, 'org': org, 'repo': repo, 'path': path, 'ord': ord}).org AS org, min({'ts': ts, 'org': org, 'repo': repo, 'path': path, 'ord': ord}).repo AS repo, min({'ts': ts, 'org': org, 'repo': repo, 'path': path, 'ord': ord}).path AS path, min({'ts': ts, 'org': org, 'repo': repo, 'path': path, 'ord': ord}).ord AS ord, count(*) AS copies FROM manifest GROUP BY sha", "manifest"))
def original(spark, sf):
    return dedup.originals(role(spark, sf, "manifest"), ["sha"], ["ts", "org", "repo", "path", "ord"])


@query(
    "a18_duplicates",
    sql(
        """WITH p AS (SELECT sha, count(*) AS copies, bool_and(path LIKE 'd1/%') AS vendored, max(bytes) AS bytes FROM manifest GROUP BY sha)
        SELECT CASE WHEN copies = 1 THEN '1' WHEN copies <= 10 THEN '2-10' WHEN copies <= 100 THEN '11-100' ELSE '>100' END AS band, vendored, count(*) AS contents, CAST(sum(copies) AS BIGINT) AS files,
        CAST(sum(bytes * (copies - 1)) AS BIGINT) AS spare_bytes FROM p GROUP BY ALL""",
        "manifest",
    ),
)
def duplicates(spark, sf):
    return dedup.duplicates(role(spark, sf, "manifest"), "sha", F.col("path").like("d1/%"))


@query(
    "a16_repo_delta",
    sql(
        f"""WITH p AS (SELECT {_EXT} AS ext, repo, sha, max(bytes) AS bytes FROM manifest GROUP BY ALL), a AS (SELECT ext, sha, count(*) AS n, min(repo) AS f FROM p GROUP BY ALL)
        SELECT repo, count(*) AS contents, count(*) FILTER (n = 1) AS only_here, count(*) FILTER (f = repo) AS original, CAST(sum(bytes) AS BIGINT) AS bytes FROM p JOIN a USING (ext, sha) GROUP BY repo""",
        "manifest",
    ),
)
def repo_delta(spark, sf):
    return dedup.one_root_delta(role(spark, sf, "manifest").withColumn("ext", paths.ext_key(F.col("path"))), "ext", "repo", "sha")


_PACKS = """m AS (SELECT pack, object, sum(bytes) AS b FROM packs GROUP BY ALL), s AS (SELECT pack, CAST(sum(b) AS BIGINT) AS pack_bytes, count(*) AS objects FROM m GROUP BY pack),
    o AS (SELECT object, pack AS owner FROM (SELECT object, m.pack, row_number() OVER (PARTITION BY object ORDER BY pack_bytes DESC, m.pack) AS rn FROM m JOIN s USING (pack)) WHERE rn = 1)"""


@query(
    "w05_pack_coverage",
    sql(
        f"""WITH {_PACKS}, c AS (SELECT m.pack, owner, count(*) AS n FROM m JOIN o USING (object) GROUP BY ALL),
        b AS (SELECT pack, owner FROM (SELECT pack, owner, row_number() OVER (PARTITION BY pack ORDER BY n DESC, owner) AS rn FROM c WHERE owner <> pack) WHERE rn = 1)
        SELECT s.pack, pack_bytes, objects, coalesce(n, 0) AS new_objects, b.owner AS best_match, round(100.0 * (objects - coalesce(n, 0)) / objects, 2) AS pct_covered
        FROM s LEFT JOIN c ON c.pack = s.pack AND c.owner = s.pack LEFT JOIN b ON b.pack = s.pack""",
        "packs",
    ),
)
def pack_coverage(spark, sf):
    return dedup.pack_coverage(role(spark, sf, "packs"))


_ROOTS = "rt AS (SELECT repo, org AS root, path, ord FROM manifest), wk AS (SELECT repo, root, count(*) AS rows FROM rt GROUP BY ALL), wc AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY rows DESC, CASE root WHEN 'org3' THEN 0 WHEN 'org1' THEN 1 ELSE 2 END, root) AS rn FROM wk)"


@query("w06_winner_root", sql(f"WITH {_ROOTS} SELECT repo, root, rows FROM wc WHERE rn = 1", "manifest"))
def winner_root(spark, sf):
    return dedup.winner_roots(role(spark, sf, "manifest").withColumnRenamed("org", "root"), "repo", "root", ["org3", "org1"])


@query(
    "w07_root_dedup",
    sql(
        f"""WITH {_ROOTS}, t AS (SELECT rt.repo, rt.root, rt.path, rt.ord, rt.root = wc.root AS own, row_number() OVER (PARTITION BY rt.repo, rt.path, rt.root ORDER BY rt.ord) AS nth FROM rt JOIN wc ON wc.repo = rt.repo AND rn = 1),
        u AS (SELECT *, bool_or(own) OVER (PARTITION BY repo, path) AS has FROM t) SELECT repo, root, path, ord, CASE WHEN nth > 1 THEN 'same_root_duplicate' WHEN own THEN 'kept' WHEN has THEN 'duplicate' ELSE 'loser_only' END AS status FROM u""",
        "manifest",
    ),
)
def root_dedup(spark, sf):
    rows = role(spark, sf, "manifest").select("repo", F.concat(F.col("org"), F.lit("")).alias("root"), "path", "ord")
    winners = dedup.winner_roots(rows, "repo", "root", ["org3", "org1"])
    return dedup.root_dedup(rows, winners, "repo", "root", "path", "ord").select("repo", "root", "path", "ord", "status")


@query(
    "w13_signatures",
    sql(
        """WITH g AS (SELECT repo, path, sha256(string_agg(DISTINCT blob, '|' ORDER BY blob)) AS signature, count(DISTINCT blob) AS contents FROM changes GROUP BY ALL)
        SELECT *, row_number() OVER (PARTITION BY repo, signature ORDER BY path) = 1 AS kept FROM g""",
        "changes",
    ),
)
def signatures(spark, sf):
    rows = role(spark, sf, "changes")
    return dedup.signatures(rows, ["repo", "path"], "blob", ["repo"], "path")


@query("t05_concentration", sql("WITH p AS (SELECT repo, sum(bytes) AS v FROM manifest GROUP BY repo), r AS (SELECT v, row_number() OVER (ORDER BY v DESC, repo) AS rn FROM p) SELECT CAST((SELECT sum(v) FROM p) AS BIGINT) AS total, round(sum(v) FILTER (rn <= 5) * 100.0 / (SELECT sum(v) FROM p), 2) AS pct_top_5, round(sum(v) FILTER (rn <= 10) * 100.0 / (SELECT sum(v) FROM p), 2) AS pct_top_10 FROM r", "manifest"))
def concentration(spark, sf):
    return rollups.concentration(role(spark, sf, "manifest"), "repo", "bytes", [5, 10])


@query("t01_hot_files", sql("SELECT repo, path, count(*) AS commits FROM changes GROUP BY ALL ORDER BY commits DESC, repo, path LIMIT 20", "changes"))
def hot_files(spark, sf):
    return role(spark, sf, "changes").groupBy("repo", "path").agg(F.count("*").alias("commits")).orderBy(F.desc("commits"), "repo", "path").limit(20)


@query("t02_removal_commits", sql("SELECT commit, count(*) AS removed, count(DISTINCT repo) AS repos FROM changes WHERE status = 'D' GROUP BY commit ORDER BY removed DESC, commit LIMIT 100", "changes"))
def removal_commits(spark, sf):
    rows = role(spark, sf, "changes").where("status = 'D'").groupBy("commit").agg(F.count("*").alias("removed"), F.count_distinct("repo").alias("repos"))
    return rows.orderBy(F.desc("removed"), "commit").limit(100)


@query("t08_largest_contents", sql("SELECT sha, max(bytes) AS bytes, count(*) AS copies FROM manifest GROUP BY sha ORDER BY bytes DESC, sha LIMIT 200", "manifest"))
def largest_contents(spark, sf):
    return role(spark, sf, "manifest").groupBy("sha").agg(F.max("bytes").alias("bytes"), F.count("*").alias("copies")).orderBy(F.desc("bytes"), "sha").limit(200)


@query("t07_risk_first", sql("SELECT DISTINCT path, contains(path, 'key') OR contains(path, 'bak') AS risky, length(path) AS n FROM urls ORDER BY risky DESC, n DESC, path LIMIT 50", "urls"))
def risk_first(spark, sf):
    rows = role(spark, sf, "urls").select("path", (F.contains("path", F.lit("key")) | F.contains("path", F.lit("bak"))).alias("risky"), F.length("path").cast("long").alias("n")).distinct()
    return rows.orderBy(F.desc("risky"), F.desc("n"), "path").limit(50)


@query("a23_repo_pairs", sql(f"WITH c AS (SELECT repo, {_EXT} AS ext, count(*) AS n FROM manifest GROUP BY ALL) SELECT repo, CAST(sum(n) AS BIGINT) AS rows, string_agg(concat(ext, ':', n), '|' ORDER BY concat(ext, ':', n)) AS pairs FROM c GROUP BY repo", "manifest"))
def repo_pairs(spark, sf):
    return rollups.pairs_text(role(spark, sf, "manifest").withColumn("ext", paths.ext_key(F.col("path"))), ["repo"], "ext")


@query(
    "a24_file_buckets",
    sql(
        """WITH c AS (SELECT repo, count(*) AS n FROM manifest GROUP BY repo), b AS (SELECT CASE WHEN n <= 0 THEN '0' WHEN n <= 10 THEN '1-10' WHEN n <= 50 THEN '11-50' WHEN n <= 100 THEN '51-100' WHEN n <= 500 THEN '101-500'
        WHEN n <= 1000 THEN '501-1000' WHEN n <= 5000 THEN '1001-5000' WHEN n <= 10000 THEN '5001-10000' ELSE '10001+' END AS bucket FROM c) SELECT bucket, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM b GROUP BY bucket""",
        "manifest",
    ),
)
def file_buckets(spark, sf):
    per = role(spark, sf, "manifest").groupBy("repo").agg(F.count("*").alias("n"))
    return rollups.distribution(per, buckets.count_bucket(F.col("n"), buckets.FILE_COUNTS))


@query("f21_size_buckets", "SELECT CASE WHEN o_totalprice < 100000 THEN '< 100 KB' WHEN o_totalprice < 1000000 THEN '100 KB - 1 MB' WHEN o_totalprice < 10000000 THEN '1 - 10 MB' WHEN o_totalprice < 100000000 THEN '10 - 100 MB' ELSE '>= 100 MB' END AS bucket, count(*) AS n FROM orders GROUP BY 1")
def size_buckets(spark, sf):
    rows = spark.read.parquet(f"{sf}/orders.parquet")
    return rows.groupBy(buckets.below(F.col("o_totalprice"), buckets.SIZES).alias("bucket")).agg(F.count("*").alias("n"))


_DAYS = "date_diff('day', o_orderdate::DATE, DATE '2001-09-01')"


@query("f19_staleness", f"SELECT CASE WHEN d < 30 THEN 'under a month' WHEN d < 90 THEN '1-3 months' WHEN d < 365 THEN '3-12 months' WHEN d < 730 THEN '1-2 years' WHEN d < 1825 THEN '2-5 years' ELSE 'over 5 years' END AS bucket, count(*) AS n FROM (SELECT {_DAYS} AS d FROM orders) GROUP BY 1")
def staleness(spark, sf):
    rows = spark.read.parquet(f"{sf}/orders.parquet").withColumn("d", F.datediff(F.lit("2001-09-01").cast("date"), "o_orderdate"))
    return rows.groupBy(buckets.below(F.col("d"), buckets.STALE).alias("bucket")).agg(F.count("*").alias("n"))


@query("f22_lifetimes", f"SELECT CASE WHEN d <= 1 THEN 'within 1 day' WHEN d <= 7 THEN '<1 week' WHEN d <= 30 THEN '<1 month' WHEN d <= 180 THEN '<6 months' WHEN d <= 365 THEN '<1 year' WHEN d <= 730 THEN '1-2 years' WHEN d <= 1825 THEN '2-5 years' ELSE '5+ years' END AS bucket, count(*) AS n FROM (SELECT {_DAYS} AS d FROM orders) GROUP BY 1")
def lifetimes(spark, sf):
    rows = spark.read.parquet(f"{sf}/orders.parquet").withColumn("d", F.datediff(F.lit("2001-09-01").cast("date"), "o_orderdate"))
    return rows.groupBy(buckets.up_to(F.col("d"), buckets.LIFETIMES, -1).alias("bucket")).agg(F.count("*").alias("n"))


@query("a25_repo_and_org", sql("SELECT org, repo, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM manifest GROUP BY ROLLUP (org, repo)", "manifest"))
def repo_and_org(spark, sf):
    per = role(spark, sf, "manifest").groupBy("org", "repo").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    return per.rollup("org", "repo").agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))


@query("a28_copy_groups", sql("WITH p AS (SELECT commit, string_agg(DISTINCT repo, '|' ORDER BY repo) AS repos, count(DISTINCT repo) AS n_repos, count(*) AS n FROM changes WHERE status = 'D' GROUP BY commit) SELECT repos, n_repos, count(*) AS commits, CAST(sum(n) AS BIGINT) AS rows FROM p WHERE n_repos > 1 GROUP BY ALL", "changes"))
def copy_groups(spark, sf):
    return rollups.copy_groups(role(spark, sf, "changes").where("status = 'D'"), "commit", "repo")


@query("a29_object_stats", "SELECT source AS repo, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'fr') AS fr, count(*) FILTER (lang = 'es') AS es FROM documents GROUP BY 1")
def object_stats(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").groupBy(F.col("source").alias("repo")).pivot("lang", ["en", "de", "fr", "es"]).agg(F.count(F.lit(1)))
    return rows.na.fill(0)


@query("a32_action_counts", sql("SELECT org, action, count(*) AS n, count(DISTINCT sha) AS contents FROM manifest GROUP BY CUBE (org, action)", "manifest"))
def action_counts(spark, sf):
    return role(spark, sf, "manifest").cube("org", "action").agg(F.count("*").alias("n"), F.count_distinct("sha").alias("contents"))


@query("a33_path_list", sql("SELECT path, count(*) AS commits, min(ts) AS first_date, max(ts) AS last_date, bool_or(action = 'written') AS written FROM manifest GROUP BY path", "manifest"))
def path_list(spark, sf):
    return role(spark, sf, "manifest").groupBy("path").agg(F.count("*").alias("commits"), F.min("ts").alias("first_date"), F.max("ts").alias("last_date"), F.bool_or(F.col("action") == "written").alias("written"))


@query("a35_list_profile", sql("SELECT count(*) AS rows, count(DISTINCT org) AS orgs, count(DISTINCT (org, repo)) AS repos, count(*) - count(DISTINCT (repo, path)) AS dup_rows, count(DISTINCT (repo, path)) - count(DISTINCT (repo, lower(path))) AS case_clashes, (SELECT count(*) FROM (SELECT sha FROM manifest GROUP BY sha HAVING count(*) > 1)) AS shared_hashes, (SELECT count(*) FROM (SELECT repo FROM manifest GROUP BY repo HAVING count(DISTINCT org) > 1)) AS shared_names FROM manifest", "manifest"))
def list_profile(spark, sf):
    rows = role(spark, sf, "manifest")
    by_path = rows.groupBy("repo", "path").agg(F.count("*").alias("n"))
    a = rows.agg(F.count("*").alias("rows"), F.count_distinct("org").alias("orgs"), F.count_distinct("org", "repo").alias("repos"))
    b = by_path.agg(F.sum(F.col("n") - 1).alias("dup_rows"), (F.count("*") - F.count_distinct("repo", F.lower("path"))).alias("case_clashes"))
    c = rows.groupBy("sha").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("shared_hashes"))
    d = rows.groupBy("repo").agg(F.count_distinct("org").alias("n")).agg(F.count_if(F.col("n") > 1).alias("shared_names"))
    return a.join(b).join(c).join(d)


@query("a36_not_found_split", sql("WITH r AS (SELECT repo, count(*) AS files, count(*) FILTER (action <> 'failed') AS found FROM manifest GROUP BY repo) SELECT found = 0 AS whole_repo, count(*) AS repos, CAST(sum(files - found) AS BIGINT) AS not_found FROM r GROUP BY 1", "manifest"))
def not_found(spark, sf):
    per = role(spark, sf, "manifest").groupBy("repo").agg(F.count("*").alias("files"), F.count_if(F.col("action") != "failed").alias("found"))
    return per.groupBy((F.col("found") == 0).alias("whole_repo")).agg(F.count("*").alias("repos"), F.sum(F.col("files") - F.col("found")).alias("not_found"))


@query("a38_run_trails", sql("WITH t AS (SELECT unit, count(*) AS attempts, string_agg(status, ' > ' ORDER BY finished, ord) AS trail, arg_max(status, (finished, ord)) AS last_status, bool_or(status = 'ok') AS ever_ok, bool_or(status <> 'ok') AS ever_failed FROM runs GROUP BY unit) SELECT *, ever_failed AND last_status = 'ok' AS fixed FROM t", "runs"))
def run_trails(spark, sf):
    return rollups.status_trail(role(spark, sf, "runs"), "unit")


@query("j40_ok_elsewhere", sql("SELECT unit, run, count(*) AS failures, (SELECT string_agg(DISTINCT CAST(o.run AS VARCHAR), '|' ORDER BY CAST(o.run AS VARCHAR)) FROM runs o WHERE o.unit = r.unit AND o.status = 'ok' AND o.run <> r.run) AS ok_runs FROM runs r WHERE status <> 'ok' GROUP BY unit, run", "runs"))
def ok_elsewhere(spark, sf):
    rows = role(spark, sf, "runs")
    ok = rows.where("status = 'ok'").groupBy("unit").agg(F.sort_array(F.collect_set(F.col("run").cast("string"))).alias("ok"))
    bad = rows.where("status <> 'ok'").groupBy("unit", "run").agg(F.count("*").alias("failures"))
    others = F.array_remove("ok", F.col("run").cast("string"))
    return bad.join(ok, "unit", "left").select("unit", "run", "failures", F.when(F.size(others) > 0, F.array_join(others, "|")).alias("ok_runs"))


@query("a21_combine_runs", sql(f"SELECT {_EXT} AS ext, count(*) AS files, count(*) FILTER (ord % 2 = 0) AS run_0, count(*) FILTER (ord % 2 = 1) AS run_1 FROM manifest GROUP BY ext", "manifest"))
def combine_runs(spark, sf):
    rows = role(spark, sf, "manifest").withColumns({"ext": paths.ext_key(F.col("path")), "run": F.col("ord") % 2})
    out = rows.groupBy("ext").pivot("run", [0, 1]).agg(F.count(F.lit(1))).na.fill(0)
    return out.select("ext", (F.col("0") + F.col("1")).alias("files"), F.col("0").alias("run_0"), F.col("1").alias("run_1"))


@query("j18_three_way_ext", sql(f"WITH e AS (SELECT {_EXT} AS ext, * FROM manifest), c AS (SELECT ext, count(*) AS files FROM e GROUP BY ext), d AS (SELECT ext, count(*) AS kept FROM e WHERE bytes > 150000 GROUP BY ext), x AS (SELECT ext, count(DISTINCT sha) AS sent FROM e WHERE action = 'written' GROUP BY ext) SELECT c.ext, files, coalesce(kept, 0) AS kept, coalesce(sent, 0) AS sent FROM c LEFT JOIN d USING (ext) LEFT JOIN x USING (ext)", "manifest"))
def three_way_ext(spark, sf):
    """Counts of history, of the text delta and of the extraction, brought together by extension."""
    rows = role(spark, sf, "manifest").withColumn("ext", paths.ext_key(F.col("path")))
    kept = rows.where("bytes > 150000").groupBy("ext").agg(F.count("*").alias("kept"))
    sent = rows.where("action = 'written'").select("ext", "sha").distinct().groupBy("ext").agg(F.count("*").alias("sent"))
    files = rows.groupBy("ext").agg(F.count("*").alias("files"))
    return files.join(kept, "ext", "left").join(sent, "ext", "left").na.fill(0, ["kept", "sent"])


@query("j39_conservation", sql(f"WITH b AS (SELECT {_EXT} AS ext, action, bytes FROM manifest) SELECT ext, count(*) FILTER (bytes > 20000) AS before, count(*) FILTER (action <> 'failed') AS after, count(*) FILTER (bytes <= 20000 AND action <> 'failed') AS new, count(*) FILTER (bytes > 20000 AND action = 'failed') AS gone, count(*) FILTER (action <> 'failed') - count(*) FILTER (bytes > 20000) = count(*) FILTER (bytes <= 20000 AND action <> 'failed') - count(*) FILTER (bytes > 20000 AND action = 'failed') AS holds FROM b GROUP BY ext", "manifest"))
def conservation(spark, sf):
    rows = role(spark, sf, "manifest").withColumn("ext", paths.ext_key(F.col("path")))
    was, now = F.col("bytes") > 20000, F.col("action") != "failed"
    out = rows.groupBy("ext").agg(F.count_if(was).alias("before"), F.count_if(now).alias("after"), F.count_if(~was & now).alias("new"), F.count_if(was & ~now).alias("gone"))
    return out.withColumn("holds", F.col("after") - F.col("before") == F.col("new") - F.col("gone"))


@query("w15_samples", sql("SELECT repo, path, ord FROM (SELECT repo, path, ord, row_number() OVER (PARTITION BY repo ORDER BY ord) AS rn FROM manifest) WHERE rn <= 2 ORDER BY repo, ord LIMIT 40", "manifest"))
def samples(spark, sf):
    return planning.per_group(role(spark, sf, "manifest").select("repo", "path", "ord"), "repo", 2, ["ord"]).orderBy("repo", "ord").limit(40)


@query("w14_batches", sql("WITH u AS (SELECT repo, sum(bytes) AS bytes FROM manifest GROUP BY repo), r AS (SELECT *, row_number() OVER (ORDER BY bytes DESC, repo) AS rn FROM u), t AS (SELECT *, CASE WHEN rn <= 3 THEN 'G' WHEN rn <= 10 THEN 'L' ELSE 'S' END AS tier FROM r) SELECT repo, CAST(bytes AS BIGINT) AS bytes, tier, CAST((row_number() OVER (PARTITION BY tier ORDER BY bytes DESC, repo) - 1) % 4 AS INTEGER) AS batch FROM t", "manifest"))
def batches(spark, sf):
    units = role(spark, sf, "manifest").groupBy("repo").agg(F.sum("bytes").alias("bytes"))
    return planning.deal(planning.tiers(units, "bytes", "repo", {"G": 3, "L": 7}), "tier", "repo", 4, "bytes")


@query("w16_seeded_sample", sql("SELECT repo, path, ord, CAST(turn AS INTEGER) AS turn FROM (SELECT repo, path, ord, row_number() OVER (PARTITION BY repo ORDER BY md5('7|' || ord), ord) AS turn FROM manifest) ORDER BY turn, md5('7|' || repo), repo LIMIT 50", "manifest"))
def seeded_sample(spark, sf):
    return planning.seeded_sample(role(spark, sf, "manifest").select("repo", "path", "ord"), "repo", "ord", 7, 50)


@query("f35_hashes", "SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256, sha1(concat('blob ', strlen(text), chr(0), text)) AS git_blob, strlen(text) AS bytes FROM documents")
def hashes(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", *content.file_hashes(F.col("text").cast("binary")))


@query("f27_magic", "SELECT CASE length(url) % 8 WHEN 0 THEN 'zip' WHEN 1 THEN 'gz' WHEN 2 THEN 'bz2' WHEN 3 THEN 'xz' WHEN 4 THEN '7z' WHEN 5 THEN 'tar' WHEN 6 THEN CASE WHEN starts_with(html, '<!DOCTYPE html') THEN 'html' ELSE '' END ELSE '' END AS kind, count(*) AS n FROM pages GROUP BY 1")
def magic(spark, sf):
    """Pages, most of them behind the first bytes of another format."""
    heads = ["504B0304", "1F8B08", "425A68", "FD377A585A00", "377ABCAF271C", "20" * 257 + "7573746172", "", "FF"]
    head = F.get(F.array(*[F.unhex(F.lit(h)) for h in heads]), F.length("url") % 8)
    kind = content.detect(F.concat(head, F.col("html").cast("binary")))
    return spark.read.parquet(f"{sf}/pages.parquet").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("f14_file_classes", "SELECT CASE p_size % 6 WHEN 0 THEN 'code' WHEN 1 THEN 'config/data' WHEN 2 THEN 'doc' WHEN 3 THEN 'binary' WHEN 4 THEN 'no-ext' ELSE 'other' END AS class, count(*) AS files FROM part GROUP BY 1")
def file_classes(spark, sf):
    ends = F.get(F.array(*[F.lit(e) for e in (".PY", ".x.yaml", ".md", ".tar", "", ".mp3")]), F.col("p_size") % 6)
    name = F.concat(F.lit("src.d/f"), "p_partkey", ends)
    return spark.read.parquet(f"{sf}/part.parquet").groupBy(paths.file_class(name).alias("class")).agg(F.count("*").alias("files"))


@query("f04_vendor", "SELECT CASE p_size % 5 WHEN 0 THEN 'node_modules' WHEN 1 THEN 'wwwroot/lib' WHEN 2 THEN 'build' ELSE '' END AS vendor, count(*) AS files FROM part GROUP BY 1")
def vendor(spark, sf):
    """Of several vendored folders the first in the list counts; a file's own name does not."""
    folder = F.get(F.array(*[F.lit(p) for p in ("x/build/node_modules/", "wwwroot/lib/a/", "BUILD/obj/", "builder/my-dist/", "src/a/vendor")]), F.col("p_size") % 5)
    path = F.concat(folder, F.when(F.col("p_size") % 5 == 4, "").otherwise(F.concat(F.lit("f"), "p_partkey")))
    return spark.read.parquet(f"{sf}/part.parquet").groupBy(paths.vendor_of(path).alias("vendor")).agg(F.count("*").alias("files"))


@query("a07_mortality", sql("WITH l AS (SELECT repo, path, arg_max(status, ord) AS s FROM changes GROUP BY ALL) SELECT split_part(path, '/', 2) AS top, count(*) AS files, count(*) FILTER (s = 'D') AS dead, round(count(*) FILTER (s = 'D') * 1.0 / count(*), 4) AS mortality FROM l GROUP BY 1", "changes"))
def mortality(spark, sf):
    last = role(spark, sf, "changes").groupBy("repo", "path").agg(F.max_by("status", "ord").alias("s"))
    dead = F.count_if(F.col("s") == "D")
    return last.groupBy(F.split_part("path", F.lit("/"), F.lit(2)).alias("top")).agg(F.count("*").alias("files"), dead.alias("dead"), F.round(dead / F.count("*"), 4).alias("mortality"))


@query("a27_year_reason", "SELECT date_part('year', o_orderdate) AS year, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1")
def year_reason(spark, sf):
    rows = spark.read.parquet(f"{sf}/orders.parquet").groupBy(F.year("o_orderdate").cast("long").alias("year")).pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).na.fill(0)
    return rows.select("year", F.col("F").alias("f"), F.col("O").alias("o"), F.col("P").alias("p"))


@query("a37_vendored_gap", sql("SELECT org, action = 'written' AS at_head, count(*) AS files FROM manifest GROUP BY CUBE (org, at_head)", "manifest"))
def vendored_gap(spark, sf):
    rows = role(spark, sf, "manifest").withColumn("at_head", F.col("action") == "written")
    return rows.cube("org", "at_head").agg(F.count("*").alias("files"))


@query("a41_extension_research", sql(f"WITH k AS (SELECT {_EXT} AS ext, repo, count(*) AS n FROM manifest GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY ext ORDER BY n DESC, repo) AS rn FROM k) SELECT ext, string_agg(concat(repo, ':', n), '|' ORDER BY rn) AS top FROM r WHERE rn <= 3 GROUP BY ext", "manifest"))
def extension_research(spark, sf):
    per = role(spark, sf, "manifest").groupBy(paths.ext_key(F.col("path")).alias("ext"), "repo").agg(F.count("*").alias("n"))
    rn = F.row_number().over(Window.partitionBy("ext").orderBy(F.desc("n"), "repo"))
    top = per.withColumn("rn", rn).where("rn <= 3").groupBy("ext").agg(F.sort_array(F.collect_list(F.struct("rn", F.concat_ws(":", "repo", "n").alias("t")))).alias("t"))
    return top.select("ext", F.array_join(F.transform("t", lambda x: x["t"]), "|").alias("top"))


@query("w10_split_parts", "WITH n AS (SELECT conv_id, turn, max(length(text)) AS v FROM conversations GROUP BY ALL), s AS (SELECT conv_id, min(turn) = 0 AND max(turn) + 1 = count(*) AS whole FROM n GROUP BY conv_id) SELECT c.conv_id, c.turn, CASE WHEN NOT whole THEN 'incomplete_set' WHEN length(text) = n.v THEN 'split_part' ELSE 'split_part_older_version' END AS status, count(*) AS rows FROM conversations c JOIN n USING (conv_id, turn) JOIN s USING (conv_id) GROUP BY ALL")
def split_parts(spark, sf):
    """Turns as the parts of a set, numbered from 1; the longest text is a part's newest version."""
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", (F.col("turn") + 1).alias("part"), F.length("text").alias("version"))
    return split_part_status(rows, "conv_id", "part", "version").groupBy("conv_id", (F.col("part") - 1).alias("turn"), "status").agg(F.count("*").alias("rows"))
