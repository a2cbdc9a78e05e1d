"""Queries that compare inventories, stores, manifests and deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions import buckets
from palimpsest.operators import compare, dedup, reconcile

from .catalog import query
from .standins import role, sql

_FULL = """f AS (SELECT coalesce(a.repo, b.repo) AS repo, coalesce(a.path, b.path) AS path, a.hash AS value_a, b.hash AS value_b, CASE WHEN b.hash IS NULL THEN 'only_a' WHEN a.hash IS NULL THEN 'only_b'
    WHEN a.hash = b.hash THEN 'identical' ELSE 'changed' END AS status FROM inv_a a FULL JOIN inv_b b ON a.repo = b.repo AND a.path = b.path)"""


def _compared(spark, sf):
    return compare.path_lens(role(spark, sf, "inv_a"), role(spark, sf, "inv_b"), ["repo", "path"], "hash")


@query("j08_inventory_path_lens", sql(f"WITH {_FULL} SELECT * FROM f", "inv_a", "inv_b"))
def path_lens(spark, sf):
    return _compared(spark, sf)


@query(
    "j09_content_lens",
    sql(
        """SELECT (SELECT count(*) FROM (SELECT hash FROM inv_a INTERSECT SELECT hash FROM inv_b)) AS shared, (SELECT count(*) FROM (SELECT hash FROM inv_a EXCEPT SELECT hash FROM inv_b)) AS only_a,
        (SELECT count(*) FROM (SELECT hash FROM inv_b EXCEPT SELECT hash FROM inv_a)) AS only_b, (SELECT count(*) FROM inv_a WHERE hash IN (SELECT hash FROM inv_b)) AS rows_a_in_b,
        (SELECT count(*) FROM inv_b WHERE hash IN (SELECT hash FROM inv_a)) AS rows_b_in_a""",
        "inv_a", "inv_b",
    ),
)
def content_lens(spark, sf):
    return compare.content_lens(role(spark, sf, "inv_a"), role(spark, sf, "inv_b"), "hash")


@query(
    "j10_repo_lens",
    sql(
        f"""WITH {_FULL} SELECT repo, count(*) FILTER (status = 'identical') AS identical, count(*) FILTER (status = 'changed') AS changed, count(*) FILTER (status = 'only_a') AS only_a,
        count(*) FILTER (status = 'only_b') AS only_b, count(*) FILTER (status <> 'identical') > 0 AS drifted FROM f GROUP BY repo""",
        "inv_a", "inv_b",
    ),
)
def repo_lens(spark, sf):
    return compare.repo_lens(_compared(spark, sf))


@query(
    "j07_hash_presence",
    sql(
        """SELECT repo, count(*) AS files, count(*) FILTER (hash IN (SELECT hash FROM inv_b)) AS present, round(count(*) FILTER (hash IN (SELECT hash FROM inv_b)) * 100.0 / count(*), 2) AS pct FROM inv_a GROUP BY repo""",
        "inv_a", "inv_b",
    ),
)
def hash_presence(spark, sf):
    return compare.presence(role(spark, sf, "inv_a"), role(spark, sf, "inv_b"), ["hash"])


@query("j07_missing_hashes", sql("SELECT repo, path, hash FROM inv_a a WHERE NOT EXISTS (SELECT 1 FROM inv_b b WHERE b.repo = a.repo AND b.hash = a.hash)", "inv_a", "inv_b"))
def missing_hashes(spark, sf):
    return role(spark, sf, "inv_a").join(role(spark, sf, "inv_b").select("repo", "hash"), ["repo", "hash"], "left_anti").select("repo", "path", "hash")


@query(
    "j11_three_hashes",
    sql(
        """SELECT coalesce(a.repo, b.repo) AS repo, coalesce(a.path, b.path) AS path, CASE WHEN a.path IS NULL THEN 'right_only' WHEN b.path IS NULL THEN 'left_only'
        WHEN a.hash = b.hash AND a.bytes = b.bytes THEN 'match' ELSE 'differs' END AS status FROM inv_a a FULL JOIN inv_b b ON a.repo = b.repo AND a.path = b.path""",
        "inv_a", "inv_b",
    ),
)
def three_hashes(spark, sf):
    """A match needs every hash to agree; hash and size stand in for them."""
    side = lambda n, x: role(spark, sf, n).select("repo", "path", F.struct("hash", "bytes").alias(x))
    rows = side("inv_a", "l").join(side("inv_b", "r"), ["repo", "path"], "full_outer")
    status = F.when(F.col("l").isNull(), "right_only").when(F.col("r").isNull(), "left_only").when(F.col("l") == F.col("r"), "match").otherwise("differs")
    return rows.select("repo", "path", status.alias("status"))


@query(
    "j12_positional_zip",
    sql(
        """WITH x AS (SELECT repo, row_number() OVER (PARTITION BY repo ORDER BY path) AS n, hash FROM inv_a), y AS (SELECT repo, row_number() OVER (PARTITION BY repo ORDER BY path) AS n, hash FROM inv_b)
        SELECT coalesce(x.repo, y.repo) AS repo, CAST(coalesce(x.n, y.n) AS INTEGER) AS n, x.hash AS value_a, y.hash AS value_b FROM x FULL JOIN y ON x.repo = y.repo AND x.n = y.n""",
        "inv_a", "inv_b",
    ),
)
def positional_zip(spark, sf):
    return compare.zipped(role(spark, sf, "inv_a"), role(spark, sf, "inv_b"), "repo", ["path"], "hash")


@query(
    "j13_mapped_check",
    sql(
        """SELECT repo, path, CASE WHEN b_hash IS NULL THEN 'MISSING' WHEN b_hash = hash THEN 'YES' ELSE 'NO' END AS in_active FROM (SELECT a.*, b.hash AS b_hash FROM inv_a a LEFT JOIN inv_b b
        ON b.repo = a.repo AND b.path = a.path)""",
        "inv_a", "inv_b",
    ),
)
def mapped_check(spark, sf):
    b = role(spark, sf, "inv_b").select("repo", "path", F.col("hash").alias("_b"))
    rows = role(spark, sf, "inv_a").join(b, ["repo", "path"], "left")
    return rows.select("repo", "path", F.when(F.col("_b").isNull(), "MISSING").when(F.col("_b") == F.col("hash"), "YES").otherwise("NO").alias("in_active"))


_TREE = """fj AS (SELECT coalesce(a.repo, b.repo) AS repo, coalesce(a.path, b.path) AS p, a.hash AS ha, b.hash AS hb FROM inv_a a FULL JOIN inv_b b ON a.repo = b.repo AND a.path = b.path),
    xa AS (SELECT repo, ha AS sha, p, row_number() OVER (PARTITION BY repo, ha ORDER BY p) AS n FROM fj WHERE hb IS NULL), xb AS (SELECT repo, hb AS sha, p, row_number() OVER (PARTITION BY repo, hb ORDER BY p) AS n FROM fj WHERE ha IS NULL),
    td AS (SELECT repo, p AS path_a, p AS path_b, CASE WHEN ha = hb THEN 'same' ELSE 'differs' END AS status FROM fj WHERE ha IS NOT NULL AND hb IS NOT NULL UNION ALL
    SELECT coalesce(xa.repo, xb.repo), xa.p, xb.p, CASE WHEN xa.p IS NULL THEN 'only_b' WHEN xb.p IS NULL THEN 'only_a' ELSE 'moved' END FROM xa FULL JOIN xb ON xa.repo = xb.repo AND xa.sha = xb.sha AND xa.n = xb.n)"""


@query("j14_tree_diff", sql(f"WITH {_TREE} SELECT * FROM td", "inv_a", "inv_b"))
def tree_diff(spark, sf):
    return compare.tree_diff(role(spark, sf, "inv_a"), role(spark, sf, "inv_b"), ["repo"], "path", "hash")


@query(
    "f42_tree_verdicts",
    sql(
        f"""WITH {_TREE}, c AS (SELECT repo, count(*) FILTER (status = 'differs') AS differs, count(*) FILTER (status = 'only_a') AS only_a, count(*) FILTER (status = 'only_b') AS only_b,
        count(*) FILTER (status = 'moved') AS moved FROM td GROUP BY repo) SELECT *, CASE WHEN differs = 0 AND only_a = 0 AND only_b = 0 THEN CASE WHEN moved = 0 THEN 'IDENTICAL' ELSE 'IDENTICAL CONTENT, PATHS MOVED' END
        WHEN differs = 0 AND only_a = 0 THEN 'A IS A SUBSET OF B' WHEN differs = 0 AND only_b = 0 THEN 'B IS A SUBSET OF A' ELSE 'DIVERGED' END AS verdict FROM c""",
        "inv_a", "inv_b",
    ),
)
def tree_verdicts(spark, sf):
    rows = compare.tree_diff(role(spark, sf, "inv_a"), role(spark, sf, "inv_b"), ["repo"], "path", "hash")
    names = ["differs", "only_a", "only_b", "moved"]
    rows = rows.groupBy("repo").agg(*[F.count_if(F.col("status") == s).alias(s) for s in names])
    return rows.withColumn("verdict", buckets.tree_verdict(*[F.col(n) for n in names]))


@query(
    "j15_object_diff",
    sql(
        """SELECT hash, min(path) AS path, count(DISTINCT path) - 1 AS more, 'a' AS side FROM inv_a WHERE hash NOT IN (SELECT hash FROM inv_b) GROUP BY hash UNION ALL
        SELECT hash, min(path), count(DISTINCT path) - 1, 'b' FROM inv_b WHERE hash NOT IN (SELECT hash FROM inv_a) GROUP BY hash""",
        "inv_a", "inv_b",
    ),
)
def object_diff(spark, sf):
    return compare.object_diff(role(spark, sf, "inv_a"), role(spark, sf, "inv_b"), "hash", "path")


@query(
    "j16_subset_check",
    sql("SELECT count(*) AS missing, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM (SELECT hash FROM inv_a EXCEPT SELECT hash FROM inv_b)", "inv_a", "inv_b"),
)
def subset_check(spark, sf):
    return compare.subset_check(role(spark, sf, "inv_a"), role(spark, sf, "inv_b"), "hash")


@query("j33_step_delta", sql("SELECT coalesce(a.repo, b.repo) AS repo, coalesce(a.path, b.path) AS path, CASE WHEN a.path IS NULL THEN 'new' WHEN b.path IS NULL THEN 'gone' WHEN a.hash = b.hash AND a.bytes = b.bytes THEN 'unchanged' ELSE 'changed' END AS status FROM inv_a a FULL JOIN inv_b b ON a.repo = b.repo AND a.path = b.path", "inv_a", "inv_b"))
def step_delta(spark, sf):
    return compare.step_delta(role(spark, sf, "inv_a"), role(spark, sf, "inv_b"), ["repo", "path"], ["hash", "bytes"])


@query("f23_crlf_shaped", sql("SELECT a.repo, count(*) AS changed, count(*) FILTER (b.bytes > a.bytes AND b.bytes - a.bytes <= greatest(1, a.bytes // 2)) AS crlf FROM inv_a a JOIN inv_b b ON a.repo = b.repo AND a.path = b.path WHERE a.hash <> b.hash GROUP BY a.repo", "inv_a", "inv_b"))
def crlf(spark, sf):
    a, b = role(spark, sf, "inv_a"), role(spark, sf, "inv_b").select("repo", "path", F.col("hash").alias("hb"), F.col("bytes").alias("bb"))
    rows = a.join(b, ["repo", "path"]).where("hash <> hb")
    return rows.groupBy("repo").agg(F.count("*").alias("changed"), F.count_if(buckets.crlf_shaped(F.col("bytes"), F.col("bb"))).alias("crlf"))


@query("w17_last_wins", sql("SELECT repo, path, max(ord) AS ord, arg_max(sha, ord) AS sha, count(*) AS copies FROM manifest GROUP BY repo, path", "manifest"))
def last_wins(spark, sf):
    return compare.last_wins(role(spark, sf, "manifest"), ["repo", "path"], "ord").select("repo", "path", "ord", "sha", "copies")


@query("u01_key_sets", sql("SELECT 'both' AS part, count(*) AS n FROM (SELECT repo, path FROM inv_a INTERSECT SELECT repo, path FROM inv_b) UNION ALL SELECT 'a', count(*) FROM (SELECT repo, path FROM inv_a EXCEPT SELECT repo, path FROM inv_b) UNION ALL SELECT 'b', count(*) FROM (SELECT repo, path FROM inv_b EXCEPT SELECT repo, path FROM inv_a) UNION ALL SELECT 'any', count(*) FROM (SELECT repo, path FROM inv_a UNION SELECT repo, path FROM inv_b)", "inv_a", "inv_b"))
def key_sets(spark, sf):
    a, b = (role(spark, sf, n).select("repo", "path") for n in ("inv_a", "inv_b"))
    parts = {"both": a.intersect(b), "a": a.subtract(b), "b": b.subtract(a), "any": a.union(b).distinct()}
    out = None
    for name, df in parts.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("u04_rows_missing", sql("SELECT unit, rel, bytes FROM source EXCEPT ALL SELECT unit, rel, bytes FROM share", "source", "share"))
def rows_missing(spark, sf):
    return role(spark, sf, "source").exceptAll(role(spark, sf, "share"))


_RECONCILE = """s AS (SELECT unit, rel, max(bytes) AS bytes FROM source GROUP BY ALL), h AS (SELECT unit, rel, max(bytes) AS bytes FROM share GROUP BY ALL),
    low AS (SELECT unit, lower(rel) AS low, count(*) AS n, bool_or(true) AS has FROM h GROUP BY ALL),
    rc AS (SELECT coalesce(s.unit, h.unit) AS unit, coalesce(s.rel, h.rel) AS rel, CASE WHEN s.rel IS NULL THEN CASE WHEN regexp_matches(h.rel, '\\.tmp\\.[0-9]+$') THEN 'temp' WHEN EXISTS (SELECT 1 FROM s s2 WHERE s2.unit = h.unit
    AND lower(s2.rel) = lower(h.rel)) THEN 'case_twin' ELSE 'extra' END WHEN h.rel IS NOT NULL THEN CASE WHEN s.bytes = h.bytes THEN 'ok' ELSE 'size_differs' END WHEN low.n IS NOT NULL THEN 'other_case' ELSE 'missing' END AS status
    FROM s FULL JOIN h ON s.unit = h.unit AND s.rel = h.rel LEFT JOIN low ON low.unit = s.unit AND low.low = lower(s.rel))"""


@query("j24_reconcile", sql(f"WITH {_RECONCILE} SELECT * FROM rc", "source", "share"))
def reconciled(spark, sf):
    return reconcile.reconcile(role(spark, sf, "source"), role(spark, sf, "share"))


@query("k11_reconcile_summary", sql(f"WITH {_RECONCILE} SELECT coalesce(unit, 'total') AS unit, status, count(*) AS n FROM rc GROUP BY GROUPING SETS ((unit, status), (status))", "source", "share"))
def reconcile_summary(spark, sf):
    rows = reconcile.reconcile(role(spark, sf, "source"), role(spark, sf, "share"))
    return rows.groupingSets([[F.col("unit"), F.col("status")], [F.col("status")]], "unit", "status").agg(F.count("*").alias("n")).withColumn("unit", F.coalesce("unit", F.lit("total")))


@query("w08_case_twins", sql("SELECT unit, rel, CAST(row_number() OVER (PARTITION BY unit, lower(rel) ORDER BY rel) AS INTEGER) AS n, count(*) OVER (PARTITION BY unit, lower(rel)) AS twins FROM (SELECT DISTINCT unit, rel FROM share)", "share"))
def case_twins(spark, sf):
    return dedup.case_twins(role(spark, sf, "share"), "unit", "rel")


@query(
    "j20_occurrences",
    sql("SELECT w.sha, coalesce(m.repo, 'NOT FOUND') AS repo, m.path FROM (SELECT DISTINCT concat('s', user_id * 7) AS sha FROM events) w LEFT JOIN (SELECT DISTINCT sha, repo, path FROM manifest WHERE action <> 'failed') m USING (sha)", "manifest"),
)
def occurrences(spark, sf):
    wanted = spark.read.parquet(f"{sf}/events.parquet").select(F.concat(F.lit("s"), F.col("user_id") * 7).alias("sha")).distinct()
    return reconcile.occurrences(wanted, role(spark, sf, "manifest").where("action <> 'failed'"), "sha", ["repo", "path"], "repo")


@query(
    "j21_occurrence_lists",
    sql("SELECT sha, count(*) AS n, string_agg(DISTINCT repo, '|' ORDER BY repo) AS repos FROM manifest WHERE action IN ('written', 'deduped') GROUP BY sha", "manifest"),
)
def occurrence_lists(spark, sf):
    rows = role(spark, sf, "manifest").where("action IN ('written', 'deduped')")
    return rows.groupBy("sha").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("repo")), "|").alias("repos"))


@query(
    "j22_store_by_prefix",
    sql(
        """WITH st AS (SELECT * FROM (VALUES ('d1', 'store1'), ('d1/f1', 'store11'), ('d2', 'store2'), ('d', 'root'), ('d8/f99', 'store8')) v(prefix, store))
        SELECT path, arg_max(store, length(prefix)) AS store FROM (SELECT DISTINCT path FROM manifest) m LEFT JOIN st ON starts_with(m.path, st.prefix) GROUP BY path""",
        "manifest",
    ),
)
def store_by_prefix(spark, sf):
    stores = spark.createDataFrame([("d1", "store1"), ("d1/f1", "store11"), ("d2", "store2"), ("d", "root"), ("d8/f99", "store8")], "prefix string, store string")
    return reconcile.by_prefix(role(spark, sf, "manifest").select("path").distinct(), "path", stores, "prefix", "store")


@query(
    "j23_repo_lookup",
    sql(
        """WITH w AS (SELECT DISTINCT repo FROM manifest), p AS (SELECT * FROM (VALUES ('x', 'repo1'), ('x', 'Repo_2'), ('y', 'REPO-3'), ('y', 'repo1')) v(place, name)), pl AS (SELECT DISTINCT place FROM p)
        SELECT w.repo, pl.place, CASE WHEN EXISTS (SELECT 1 FROM p WHERE p.place = pl.place AND p.name = w.repo) THEN 'exact'
        WHEN EXISTS (SELECT 1 FROM p WHERE p.place = pl.place AND regexp_replace(lower(p.name), '[^a-z0-9]', '', 'g') = regexp_replace(lower(w.repo), '[^a-z0-9]', '', 'g')) THEN 'fuzzy' ELSE 'missing' END AS found FROM w, pl""",
        "manifest",
    ),
)
def repo_lookup(spark, sf):
    places = spark.createDataFrame([("x", "repo1"), ("x", "Repo_2"), ("y", "REPO-3"), ("y", "repo1")], "place string, name string")
    return reconcile.lookup_places(role(spark, sf, "manifest").select("repo").distinct(), "repo", places)


@query("j27_active_vs_stored", sql("SELECT org, repo, path, blob, CASE WHEN EXISTS (SELECT 1 FROM processed p WHERE p.blob = a.blob) THEN 'in_stored' WHEN row_number() OVER (PARTITION BY blob ORDER BY org, repo, path) > 1 THEN 'deduped' ELSE 'written' END AS action FROM active a", "active", "processed"))
def active_vs_stored(spark, sf):
    return reconcile.store_actions(role(spark, sf, "active"), role(spark, sf, "processed"), "blob", ["org", "repo", "path"]).select("org", "repo", "path", "blob", "action")


@query("j38_resend", sql("WITH k AS (SELECT DISTINCT sha FROM manifest WHERE action = 'written' AND bytes > 100000) SELECT sha, min(path) AS path FROM manifest WHERE (action = 'written' AND ts < TIMESTAMP '1995-06-01 00:00:00') OR (action = 'deduped' AND sha NOT IN (SELECT sha FROM k)) GROUP BY sha", "manifest"))
def resend(spark, sf):
    rows = role(spark, sf, "manifest")
    kept = rows.where("action = 'written' AND bytes > 100000").select("sha")
    again = rows.where("action = 'written' AND ts < TIMESTAMP '1995-06-01 00:00:00'").unionByName(rows.where("action = 'deduped'").join(kept, "sha", "left_anti").select(rows.columns))
    return again.groupBy("sha").agg(F.min("path").alias("path"))


@query("j36_unreachable", sql("WITH RECURSIVE r AS (SELECT sha FROM commits c WHERE branch = 'view' AND NOT EXISTS (SELECT 1 FROM commits d WHERE d.parent = c.sha) UNION SELECT c.parent FROM r JOIN commits c ON c.sha = r.sha WHERE c.parent IS NOT NULL) SELECT sha FROM commits WHERE sha NOT IN (SELECT sha FROM r)", "commits"))
def unreachable(spark, sf):
    from palimpsest.operators import lineage

    commits = role(spark, sf, "commits")
    childless = commits.join(commits.select(F.col("parent").alias("sha")), "sha", "left_anti")
    tips = childless.where("branch = 'view'").select("sha")
    return commits.select("sha").join(lineage.reachable(tips, commits.where("parent IS NOT NULL"), "sha", "parent"), "sha", "left_anti")
