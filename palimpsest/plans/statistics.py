"""Queries on profiles of extensions, archives, object stores, steps and path lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions import paths
from palimpsest.operators import sampling, statistics

from .catalog import query
from .standins import role, sql

_EXT = "CASE WHEN path LIKE '%.%' THEN substr(path, strpos(path, '.') + 1) ELSE '' END"
_KEY = ["org", "repo", "path"]


def _common(column: str, name: str) -> str:
    return f"{name} AS (SELECT ext, string_agg(concat(x, ' (', n, ')'), ', ' ORDER BY n DESC, x) AS {name} FROM (SELECT *, row_number() OVER (PARTITION BY ext ORDER BY n DESC, x) AS rn FROM (SELECT ext, {column} AS x, count(*) AS n FROM f GROUP BY ALL)) WHERE rn <= 8 GROUP BY ext)"


@query(
    "a41_profile",
    sql(
        f"""WITH h AS (SELECT DISTINCT org, repo, path FROM changes), a AS (SELECT DISTINCT org, repo, path FROM active),
        f AS (SELECT *, {_EXT} AS ext, CASE WHEN (org, repo) IN (SELECT (org, repo) FROM active) THEN now END AS at_head FROM (SELECT coalesce(h.org, a.org) AS org, coalesce(h.repo, a.repo) AS repo, coalesce(h.path, a.path) AS path, h.path IS NOT NULL AS known, a.path IS NOT NULL AS now FROM h FULL JOIN a ON h.org = a.org AND h.repo = a.repo AND h.path = a.path)),
        v AS (SELECT {_EXT} AS ext, bytes FROM (SELECT org, repo, path, blob, max(bytes) AS bytes FROM changes GROUP BY ALL)),
        c AS (SELECT ext, count(*) FILTER (known) AS files_in_history, count(*) FILTER (known AND at_head) AS still_active, count(*) FILTER (known AND NOT at_head) AS history_only, count(*) FILTER (NOT known) AS active_only, count(*) FILTER (known AND path LIKE 'src/m1/%') AS vendored, count(DISTINCT (org, repo)) AS repos FROM f GROUP BY ext),
        s AS (SELECT ext, count(*) AS versions, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(floor(quantile_cont(bytes, 0.5)) AS BIGINT) AS median_bytes, max(bytes) AS largest_bytes FROM v GROUP BY ext),
        {_common("concat(org, '/', repo)", "top_repos")}, {_common("CASE WHEN length(path) - length(replace(path, '/', '')) > 1 THEN concat(split_part(path, '/', 1), '/', split_part(path, '/', 2), '/') ELSE concat(split_part(path, '/', 1), '/') END", "top_folders")}, {_common("regexp_extract(path, '[^/]*$')", "top_names")}
        SELECT c.*, coalesce(versions, 0) AS versions, coalesce(bytes, 0) AS bytes, median_bytes, largest_bytes, top_repos, top_folders, top_names FROM c LEFT JOIN s USING (ext) JOIN top_repos USING (ext) JOIN top_folders USING (ext) JOIN top_names USING (ext)""",
        "changes", "active",
    ),
)
def profile(spark, sf):
    """Each extension: where its files are, sizes of its versions, its most common repositories, folders and names."""
    changes, active = role(spark, sf, "changes"), role(spark, sf, "active")
    history = changes.select(*_KEY).distinct().withColumn("in_history", F.lit(True))
    now = active.select(*_KEY).distinct().withColumn("_now", F.lit(True))
    repos = active.select("org", "repo").distinct().withColumn("_has", F.lit(True))
    files = history.join(now, _KEY, "full_outer").join(repos, ["org", "repo"], "left")
    vendored = F.when(F.col("path").like("src/m1/%"), "m1").otherwise("")
    files = files.select(*_KEY, paths.ext_key(F.col("path")).alias("ext"), F.coalesce("in_history", F.lit(False)).alias("in_history"), F.when(F.col("_has"), F.coalesce("_now", F.lit(False))).alias("at_head"), vendored.alias("vendored"))
    versions = changes.groupBy(*_KEY, "blob").agg(F.max("bytes").alias("bytes")).withColumn("ext", paths.ext_key(F.col("path")))
    return statistics.extension_research(files, versions)


@query(
    "a41_samples",
    """WITH d AS (SELECT *, coalesce(lang, '') AS ext, concat('d', doc_id) AS path FROM documents), u AS (SELECT ext, source, row_number() OVER (PARTITION BY ext ORDER BY md5('7|o|' || coalesce(source, '')), source) AS unit_at FROM (SELECT DISTINCT ext, source FROM d)),
    r AS (SELECT d.*, unit_at, row_number() OVER (PARTITION BY d.ext, d.source ORDER BY md5('7|' || path || '|' || doc_id), path, doc_id) AS turn FROM d JOIN u ON u.ext = d.ext AND u.source IS NOT DISTINCT FROM d.source),
    s AS (SELECT *, row_number() OVER (PARTITION BY ext ORDER BY turn, unit_at) AS place FROM r)
    SELECT ext, CAST(place AS INTEGER) AS place, source AS repo, path, CASE WHEN text IS NULL THEN '' ELSE CASE n_chars % 5 WHEN 0 THEN 'zip' WHEN 1 THEN 'pdf' WHEN 2 THEN 'sqlite' WHEN 3 THEN 'other binary' ELSE CASE text WHEN '' THEN 'empty' ELSE 'text-like' END END END AS signature FROM s WHERE place <= 40""",
)
def samples(spark, sf):
    """A seeded sample of each language's documents, spread over sources, and what their contents begin with; most stand behind another format's first bytes."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    head = F.get(F.array(*[F.unhex(F.lit(h)) for h in ("504B0304", "25504446", "53514C69746520666F726D61742033", "0001", "")]), (F.col("n_chars") % 5).cast("int"))
    versions = docs.select(F.coalesce("lang", F.lit("")).alias("ext"), F.lit("o").alias("org"), F.col("source").alias("repo"), F.concat(F.lit("d"), "doc_id").alias("path"), F.col("doc_id").alias("blob"))
    contents = docs.select(F.col("doc_id").alias("blob"), F.concat(head, F.col("text").cast("binary")).alias("content"))
    return statistics.sampled_versions(versions, contents, 40, 7).select("ext", "place", "repo", "path", "signature")


@query("w16_bottom_k", sql("SELECT repo, path, ord, CAST(place AS INTEGER) AS place FROM (SELECT repo, path, ord, row_number() OVER (PARTITION BY repo ORDER BY md5('11|' || ord), ord) AS place FROM manifest) WHERE place <= 12", "manifest"))
def bottom_k(spark, sf):
    rows = role(spark, sf, "manifest").select("repo", "path", "ord").withColumn("_draw", sampling.draw(11, "ord"))
    return sampling.bottom_k(rows, ["repo"], "_draw", ["ord"], 12).drop("_draw")


_TYPED = "m AS (SELECT *, CASE WHEN ext = '' THEN '_noext' WHEN ext = 't~mp' THEN 'tmp' ELSE lower(ext) END AS type FROM members WHERE inner_path <> '')"


@query(
    "a22_by_type",
    sql(
        f"""WITH {_TYPED}, t AS (SELECT type, min(route) AS route, count(*) FILTER (action <> 'opened_nested') AS occurrences, count(*) FILTER (action = 'written') AS "distinct", coalesce(sum(bytes) FILTER (action = 'written'), 0) AS bytes,
        count(*) FILTER (action = 'too_large') AS not_stored, count(*) FILTER (action = 'opened_nested') AS opened_nested, count(DISTINCT CASE WHEN action <> 'opened_nested' THEN (org, repo) END) AS repos FROM m GROUP BY type)
        SELECT type, route, occurrences, "distinct", round(bytes / 1e9, 3) AS gb_distinct, not_stored, opened_nested, repos FROM t
        UNION ALL SELECT 'total', NULL, CAST(sum(occurrences) AS BIGINT), CAST(sum("distinct") AS BIGINT), round(sum(bytes) / 1e9, 3), CAST(sum(not_stored) AS BIGINT), NULL, NULL FROM t""",
        "members",
    ),
)
def members_by_type(spark, sf):
    return statistics.members_by_type(role(spark, sf, "members"))


@query(
    "a22_by_archive_type",
    sql(
        """WITH x AS (SELECT CASE source WHEN 'split_set' THEN '001' ELSE lower(substr(archive_path, strpos(archive_path, '.') + 1)) END AS archive_type, CASE WHEN source <> 'split_set' THEN split_part(status, ':', 1) END AS s, members FROM archives)
        SELECT archive_type, count(s) AS versions, CAST(coalesce(sum(members), 0) AS BIGINT) AS files_inside, count(*) FILTER (s = 'ok') AS ok, count(*) FILTER (s = 'split_part') AS split_part, count(*) FILTER (s = 'failed') AS failed, count(*) FILTER (s = 'too_large') AS too_large, count(*) FILTER (s = 'encrypted') AS other_status FROM x GROUP BY 1""",
        "archives",
    ),
)
def archives_by_type(spark, sf):
    return statistics.archives_by_type(role(spark, sf, "archives"), ["ok", "split_part", "failed", "too_large"])


@query(
    "a22_by_repo",
    sql(
        """WITH a AS (SELECT org, repo, count(*) FILTER (source <> 'split_set') AS archive_versions, count(*) FILTER (source <> 'split_set' AND status = 'ok') AS opened, CAST(coalesce(sum(members), 0) AS BIGINT) AS files_inside FROM archives GROUP BY ALL),
        m AS (SELECT org, repo, count(*) FILTER (action = 'written') AS written, count(*) FILTER (action = 'deduped') AS deduped, count(*) FILTER (action = 'too_large') AS not_stored, coalesce(sum(bytes) FILTER (action = 'written'), 0) AS bytes FROM members WHERE inner_path <> '' AND action <> 'opened_nested' GROUP BY ALL)
        SELECT coalesce(a.org, m.org) AS org, coalesce(a.repo, m.repo) AS repo, coalesce(archive_versions, 0) AS archive_versions, coalesce(opened, 0) AS opened, coalesce(files_inside, 0) AS files_inside, coalesce(written, 0) AS written, coalesce(deduped, 0) AS deduped, coalesce(not_stored, 0) AS not_stored, round(coalesce(bytes, 0) / 1e9, 3) AS gb_written FROM a FULL JOIN m ON a.org = m.org AND a.repo = m.repo""",
        "archives", "members",
    ),
)
def archives_by_repo(spark, sf):
    return statistics.archives_by_repo(role(spark, sf, "archives"), role(spark, sf, "members"))


@query("a22_problems", sql("SELECT org, repo, archive_path, source, status, members FROM archives WHERE status <> 'ok' AND NOT (status = 'split_part' AND source <> 'split_set')", "archives"))
def archive_problems(spark, sf):
    return statistics.archive_problems(role(spark, sf, "archives"))


@query(
    "j39_steps",
    sql(
        """WITH i AS (SELECT concat('u', repo) AS unit, CASE WHEN ext = 'csv' THEN 'hig' WHEN ext = 'zip' THEN 'low' ELSE lower(ext) END AS type, sha, side FROM members, (VALUES ('before'), ('after')) s(side) WHERE CASE side WHEN 'before' THEN ts < TIMESTAMP '1997-01-01 00:00:00' ELSE ts >= TIMESTAMP '1994-01-01 00:00:00' END),
        n AS (SELECT type, count(*) AS inside_new_distinct FROM (SELECT unit, sha, max(type) AS type FROM i GROUP BY ALL HAVING bool_and(side = 'after')) GROUP BY type), h AS (SELECT type, count(*) FILTER (side = 'before') AS inside_before, count(*) FILTER (side = 'after') AS inside_after FROM i GROUP BY type),
        s AS (SELECT type, step, count(*) FILTER (ts < TIMESTAMP '1998-01-01 00:00:00') AS out_before, count(*) FILTER (ts >= TIMESTAMP '1993-01-01 00:00:00') AS out_after, count(*) FILTER (ts >= TIMESTAMP '1993-01-01 00:00:00' AND NOT (step = 'stepP' AND bytes > 490000)) AS manifest, count(*) FILTER (ts >= TIMESTAMP '1998-01-01 00:00:00') AS delta_new, count(*) FILTER (ts < TIMESTAMP '1993-01-01 00:00:00') AS delta_gone, step = 'stepF' AND type = 'hig' AS unnamed FROM outputs GROUP BY ALL)
        SELECT coalesce(s.type, h.type) AS type, coalesce(step, '') AS step, coalesce(inside_before, 0) AS inside_before, coalesce(inside_after, 0) AS inside_after, coalesce(inside_after - inside_before, 0) AS inside_added, coalesce(inside_new_distinct, 0) AS inside_new_distinct, coalesce(out_before, 0) AS out_before, coalesce(out_after, 0) AS out_after,
        CASE WHEN unnamed THEN NULL ELSE coalesce(manifest, 0) END AS manifest, coalesce(delta_new, 0) AS delta_new, coalesce(delta_gone, 0) AS delta_gone, CASE WHEN step IS NULL THEN 'not processed' WHEN (unnamed OR out_after = manifest) AND out_after - out_before = delta_new - delta_gone THEN 'ok' ELSE 'CHECK' END AS "check" FROM s FULL JOIN h ON h.type = s.type LEFT JOIN n ON n.type = coalesce(s.type, h.type)""",
        "members", "outputs",
    ),
)
def steps(spark, sf):
    """Steps over the types: one writes no names for a type, one has files that its manifest lacks."""
    year = lambda y: F.lit(f"{y}-01-01").cast("timestamp")
    members, out = role(spark, sf, "members"), role(spark, sf, "outputs")
    kind = F.when(F.col("ext") == "csv", "hig").when(F.col("ext") == "zip", "low").otherwise(F.lower("ext"))
    inside = members.select(F.concat(F.lit("u"), "repo").alias("unit"), kind.alias("type"), "sha", "ts")
    sides = lambda df, end, start: df.where(F.col("ts") < year(end)).withColumn("side", F.lit("before")).unionByName(df.where(F.col("ts") >= year(start)).withColumn("side", F.lit("after")))
    unnamed = (F.col("step") == "stepF") & (F.col("type") == "hig")
    manifest = out.where((F.col("ts") >= year(1993)) & ~((F.col("step") == "stepP") & (F.col("bytes") > 490000))).withColumn("output", F.when(~unnamed, F.col("output")))
    status = F.when(F.col("ts") >= year(1998), "new").when(F.col("ts") < year(1993), "gone")
    return statistics.conservation(sides(inside, 1997, 1994), sides(out, 1998, 1993), manifest, out.withColumn("status", status).where("status IS NOT NULL"))


_REASON = "CASE WHEN bytes < 20000 THEN 'vendored' WHEN bytes < 60000 THEN 'macos' WHEN bytes < 100000 THEN 'docfx_cache' ELSE 'unreadable' END"
_SCOPE = "count(*) AS {0}_paths, CAST(sum(versions) AS BIGINT) AS {0}_versions"


@query(
    "a20_scope",
    sql(
        f"""WITH e AS (SELECT *, {_EXT} AS ext FROM manifest), m AS (SELECT ext, org, repo, path, count(*) AS versions, count(DISTINCT sha) AS contents, sum(bytes) AS bytes FROM e WHERE action <> 'failed' GROUP BY ALL),
        o AS (SELECT ext, org, repo, path, {_REASON} AS reason, count(*) AS versions FROM e WHERE action = 'failed' GROUP BY ALL),
        a AS (SELECT ext, true AS m, versions, contents, bytes, '' AS reason FROM m UNION ALL SELECT ext, false, versions, 0, 0, reason FROM o)
        SELECT coalesce(ext, 'total') AS ext, count(*) AS scope_paths, CAST(sum(versions) AS BIGINT) AS scope_files, count(*) FILTER (m) AS merged_paths, CAST(coalesce(sum(versions) FILTER (m), 0) AS BIGINT) AS merged_versions, CAST(sum(contents) AS BIGINT) AS contents, CAST(sum(bytes) AS BIGINT) AS bytes,
        count(*) FILTER (reason = 'vendored') AS left_vendored, count(*) FILTER (reason = 'macos') AS left_macos, count(*) FILTER (reason = 'docfx_cache') AS left_docfx_cache, count(*) FILTER (reason = 'unreadable') AS left_other, CAST(coalesce(sum(versions) FILTER (NOT m), 0) AS BIGINT) AS left_versions FROM a GROUP BY ROLLUP (ext)""",
        "manifest",
    ),
)
def scope(spark, sf):
    """Paths merged and paths left out, with a reason that is none of the known ones."""
    rows = role(spark, sf, "manifest").withColumn("ext", paths.ext_key(F.col("path")))
    kept = rows.where("action <> 'failed'")
    contents = kept.groupBy("ext", *_KEY, "sha").agg(F.count("*").alias("_n"), F.sum("bytes").alias("_b"))
    merged = contents.groupBy("ext", *_KEY).agg(F.sum("_n").alias("versions"), F.count("*").alias("contents"), F.sum("_b").alias("bytes"))
    left = rows.where("action = 'failed'").groupBy("ext", *_KEY, F.expr(_REASON).alias("reason")).agg(F.count("*").alias("versions"))
    return statistics.scope(merged, left, ["contents", "bytes"])


def _part(name: str, *columns: str) -> str:
    keys = " || ' | ' || ".join(columns) or "''"
    return f"SELECT '{name}' AS section, {keys} AS keys, count(*) AS versions, CAST(sum(bytes) AS BIGINT) AS bytes FROM s GROUP BY ALL"


@query("a15_reason_sections", sql(f"WITH s AS (SELECT {_EXT} AS ext, action AS why, CASE WHEN path LIKE 'd1/%' THEN 'vendored' ELSE 'own' END AS whose, CASE WHEN bytes < 20000 THEN '????' ELSE CAST(date_part('year', ts) AS VARCHAR) END AS year, bytes FROM manifest) {_part('total')} UNION ALL {_part('reason', 'ext', 'why')} UNION ALL {_part('whose', 'ext', 'whose')} UNION ALL {_part('year', 'ext', 'year')}", "manifest"))
def reason_sections(spark, sf):
    rows = role(spark, sf, "manifest")
    vendored = F.when(F.col("path").like("d1/%"), "d1").otherwise("")
    return statistics.reason_sections(rows.select(paths.ext_key(F.col("path")).alias("ext"), F.col("action").alias("why"), vendored.alias("vendored"), F.when(F.col("bytes") >= 20000, F.col("ts")).alias("first_date"), "bytes"))


def _dead(name: str, column: str) -> str:
    return f"SELECT '{name}' AS section, {column} AS keys, count(*) AS files, count(*) FILTER (NOT alive) AS gone, CAST(sum(commits) AS BIGINT) AS commits, CAST(sum(chars) AS BIGINT) AS chars, CAST(sum(lines) AS BIGINT) AS lines, CAST(round_even(count(*) FILTER (NOT alive) * 100.0 / count(*), 0) AS BIGINT) AS mortality FROM r GROUP BY 2"


@query("a07_mortality_sections", sql(f"""WITH r AS (SELECT path, arg_max(status, ord) <> 'D' AS alive, count(*) AS commits, sum(bytes) AS chars, sum(added) AS lines, CASE {_EXT} WHEN 'csv' THEN 'config/data' WHEN 'txt' THEN 'doc' WHEN '' THEN 'no-ext' ELSE 'code' END AS class FROM changes GROUP BY repo, path)
{_dead('class', 'class')} UNION ALL {_dead('extension', f"CASE {_EXT} WHEN '' THEN '(none)' ELSE {_EXT} END")} UNION ALL {_dead('folder', "split_part(path, '/', 1)")}""", "changes"))
def mortality_sections(spark, sf):
    records = role(spark, sf, "changes").groupBy("repo", "path").agg((F.max_by("status", "ord") != "D").alias("alive"), F.count("*").alias("commits"), F.sum("bytes").alias("chars"), F.sum("added").alias("lines"))
    return statistics.mortality(records)


def _kinds(name: str, where: str) -> str:
    return ", ".join(f"count(*) FILTER ({where} AND type = '{k}') AS {name}_{k}s" for k in ("commit", "tree", "blob", "tag"))


@query("a29_object_stores", sql(f"""WITH o AS (SELECT repo, object, max(type) AS type, max(bytes) AS bytes, bool_or(loose) AS loose FROM objects GROUP BY ALL) SELECT repo, count(*) FILTER (NOT loose AND type IS NOT NULL) AS packed_objects, CAST(coalesce(sum(bytes) FILTER (NOT loose AND type IS NOT NULL), 0) AS BIGINT) AS packed_bytes, count(*) FILTER (loose) AS loose_objects,
CAST(coalesce(sum(bytes) FILTER (loose AND type IS NOT NULL), 0) AS BIGINT) AS loose_bytes, count(*) FILTER (loose AND type IS NULL) AS loose_unparsed, {_kinds('packed', 'NOT loose')}, {_kinds('loose', 'loose')}, {_kinds('total', 'true')} FROM o GROUP BY repo""", "objects"))
def object_stores(spark, sf):
    return statistics.object_stores(role(spark, sf, "objects"))


_FOLDER = "SELECT repo, count(*) FILTER (rel LIKE 'pack/%') AS packs, count(*) FILTER (rel NOT LIKE 'pack/%' AND rel NOT LIKE 'info/%') AS loose, sum(bytes) AS bytes FROM {} GROUP BY repo"


@query("a30_repacked", sql(f"WITH a AS ({_FOLDER.format('folder_before')}), b AS ({_FOLDER.format('folder_after')}) SELECT coalesce(a.repo, b.repo) AS repo, round(a.bytes / 1e6, 2) AS size_before_mb, round(b.bytes / 1e6, 2) AS size_after_mb, round((a.bytes - b.bytes) / 1e6, 2) AS reclaimed_mb, a.packs AS packs_before, b.packs AS packs_after, a.loose AS loose_before, b.loose AS loose_after, CASE WHEN b.repo IS NULL THEN 'not_run' WHEN a.repo IS NULL THEN 'new' WHEN b.loose > 0 THEN 'loose_left' ELSE 'ok' END AS status FROM a FULL JOIN b ON a.repo = b.repo", "folder_before", "folder_after"))
def repacked(spark, sf):
    return statistics.repacked(role(spark, sf, "folder_before"), role(spark, sf, "folder_after"))


_LISTED = f"""l AS (SELECT org, repo, path, {_EXT} AS ext, count(DISTINCT commit) AS commits, min(ts) AS first_date, max(ts) AS last_date, arg_max(status, ord) AS last_event, arg_max(bytes, ord) AS latest_bytes, max(bytes) AS max_bytes, path LIKE 'src/m1/%' AS vendored,
CASE WHEN (org, repo) IN (SELECT (org, repo) FROM active) THEN (org, repo, path) IN (SELECT (org, repo, path) FROM active) END AS at_head FROM changes GROUP BY org, repo, path)"""


def _listed(spark, sf):
    changes, active = role(spark, sf, "changes"), role(spark, sf, "active")
    commits = changes.select(*_KEY, "commit").distinct().groupBy(*_KEY).agg(F.count("*").alias("commits"))
    last = changes.groupBy(*_KEY).agg(F.max_by("status", "ord").alias("last_event"), F.max_by("bytes", "ord").alias("latest_bytes"), F.max("bytes").alias("max_bytes"))
    now = active.select(*_KEY).distinct().withColumn("_now", F.lit(True))
    repos = active.select("org", "repo").distinct().withColumn("_has", F.lit(True))
    files = commits.join(last, _KEY).join(now, _KEY, "left").join(repos, ["org", "repo"], "left")
    head, vendored = F.when(F.col("_has"), F.coalesce("_now", F.lit(False))), F.when(F.col("path").like("src/m1/%"), "m1").otherwise("")
    files = files.withColumns({"at_head": head, "vendored": vendored, "in_history": F.lit(True), "ext": paths.ext_key(F.col("path"))})
    versions = changes.groupBy(*_KEY, "blob").agg(F.min("ts").alias("first_date"), F.max("ts").alias("last_date"))
    return statistics.path_list(files, versions)


@query("a33_unique_paths", sql(f"WITH {_LISTED} SELECT * FROM l", "changes", "active"))
def unique_paths(spark, sf):
    return _listed(spark, sf)


@query("a33_paths_by_extension", sql(f"WITH {_LISTED} SELECT coalesce(ext, 'total') AS ext, count(*) AS paths, CAST(sum(commits) AS BIGINT) AS commits, count(*) FILTER (at_head) AS still_today, count(*) FILTER (vendored) AS vendored, count(DISTINCT (org, repo)) AS repos FROM l GROUP BY ROLLUP (ext)", "changes", "active"))
def paths_by_extension(spark, sf):
    return statistics.path_list_by_extension(_listed(spark, sf))


_WRITTEN = "w AS (SELECT org, repo, path LIKE 'd1/%' AS vendored, CASE WHEN bytes > 150000 THEN 'at HEAD' WHEN bytes > 20000 THEN 'not at HEAD' ELSE 'HEAD unknown' END AS head FROM manifest WHERE action = 'written')"


def _explained(spark, sf):
    rows = role(spark, sf, "manifest")
    head = F.when(F.col("bytes") > 150000, True).when(F.col("bytes") > 20000, False)
    files = rows.select("org", "repo", F.regexp_replace("path", "^d1/", "node_modules/").alias("path"), F.when(F.col("action") == "written", F.col("sha")).otherwise("").alias("output"), head.alias("at_head"))
    return statistics.explained_counts(files, role(spark, sf, "archives").groupBy("org", "repo").agg(F.count("*").alias("listed")))


@query("a37_kinds", sql(f"WITH {_WRITTEN} SELECT concat(CASE WHEN vendored THEN 'vendored' ELSE 'own code' END, ', ', head) AS kind, count(*) AS files, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM w GROUP BY 1", "manifest"))
def written_kinds(spark, sf):
    return _explained(spark, sf)[0]


@query("a37_gaps", sql(f"WITH {_WRITTEN}, i AS (SELECT org, repo, count(*) AS listed FROM archives GROUP BY ALL), p AS (SELECT org, repo, count(*) AS written, count(*) FILTER (vendored) AS vendored, count(*) FILTER (head = 'not at HEAD') AS not_at_head FROM w GROUP BY ALL) SELECT org, repo, written, vendored, not_at_head, written - vendored - not_at_head AS own_at_head, listed, written - listed AS gap FROM p JOIN i USING (org, repo)", "manifest", "archives"))
def inventory_gaps(spark, sf):
    return _explained(spark, sf)[1]
