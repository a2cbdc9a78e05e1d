"""Queries over trees, commit graphs, identities and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.operators import graph, identity, naming, planning, shared, trees

from .catalog import query
from .standins import role, sql

_BOTH = """SELECT coalesce(a.unit, b.unit) AS unit, coalesce(a.path, b.path) AS path, CASE WHEN a.path IS NULL THEN 'A' WHEN b.path IS NULL THEN 'D' ELSE 'M' END AS status,
a.blob AS old_blob, b.blob AS new_blob FROM (SELECT unit, path, max(blob) AS blob FROM old_files GROUP BY ALL) a FULL JOIN (SELECT unit, path, max(blob) AS blob FROM new_files GROUP BY ALL) b
ON a.unit = b.unit AND a.path = b.path WHERE a.blob IS DISTINCT FROM b.blob"""


@query("s10_tree_changes", sql(_BOTH, "old_files", "new_files"))
def tree_changes(spark, sf):
    """Two states of each unit as trees; what differs is found by going down only where trees differ."""
    side = lambda name, k: role(spark, sf, name).withColumn("side", F.lit(k))
    roots, entries = trees.store(side("old_files", 0).unionByName(side("new_files", 1)), ["unit", "side"])
    tree = lambda k: F.max(F.when(F.col("side") == k, F.col("tree")))
    pairs = roots.groupBy("unit").agg(tree(0).alias("old_tree"), tree(1).alias("new_tree"))
    return trees.changes(pairs, entries).select("unit", "path", "status", "old_blob", "new_blob")


@query("s07_tree_files", sql("SELECT unit, path, max(blob) AS id FROM new_files GROUP BY ALL", "new_files"))
def tree_files(spark, sf):
    roots, entries = trees.store(role(spark, sf, "new_files"), ["unit"])
    return trees.listed(roots, entries).select("unit", "path", "id")


_LEVELS = """p AS (SELECT sha, parent FROM history WHERE parent IS NOT NULL UNION ALL SELECT sha, merged FROM history WHERE merged IS NOT NULL),
l AS (SELECT sha, 0 AS g FROM history WHERE parent IS NULL AND merged IS NULL UNION SELECT p.sha, l.g + 1 FROM l JOIN p ON p.parent = l.sha),
o AS (SELECT repo, sha, row_number() OVER (PARTITION BY repo ORDER BY g, ts, sha) AS ord FROM (SELECT sha, max(g) AS g FROM l GROUP BY sha) JOIN history USING (sha))"""
_TIPS = """t AS (SELECT repo, sha AS tip FROM history WHERE sha NOT IN (SELECT parent FROM p)),
r AS (SELECT tip, tip AS sha FROM t UNION SELECT r.tip, p.parent FROM r JOIN p ON p.sha = r.sha)"""
_HELD = """s AS (SELECT r.tip, h.repo, h.path, arg_max(h.status, o.ord) AS status, arg_max(h.blob, o.ord) AS blob FROM r JOIN history h USING (sha) JOIN o USING (sha) GROUP BY ALL)"""


def _commits(spark, sf):
    rows = role(spark, sf, "history")
    edges = rows.select("sha", "parent").unionByName(rows.select("sha", F.col("merged").alias("parent")))
    return rows, edges.where("parent IS NOT NULL")


def _tips(rows, edges):
    """Commits without children, numbered in their repository."""
    ends = shared.cut(rows.join(shared.dealt(edges.select(F.col("parent").alias("sha"))), "sha", "left_anti").select("repo", "sha"))
    return graph.tip_numbers(ends, ["repo"], "sha")


def _with_tips(spark, sf):
    """Commits, with the bitmap of the tips (commits without children) of their repository; the tips."""
    rows, edges = _commits(spark, sf)
    tips = _tips(rows, edges)
    return rows.join(shared.dealt(graph.tips_of_commits(rows, edges, tips, "sha")), "sha"), edges, tips


@query("s02_commit_order", sql(f"WITH RECURSIVE {_LEVELS} SELECT repo, sha, ord FROM o", "history"))
def commit_order(spark, sf):
    rows, edges = _commits(spark, sf)
    return graph.commit_order(rows, edges, ["repo"], "ts", "sha").select("repo", "sha", "ord")


@query("s13_commit_tips", sql(f"WITH RECURSIVE {_LEVELS.split('l AS', 1)[0]}{_TIPS} SELECT h.repo, h.sha, count(r.tip) AS tips, min(r.tip) AS first_tip, max(r.tip) AS last_tip FROM history h LEFT JOIN r USING (sha) GROUP BY ALL", "history"))
def commit_tips(spark, sf):
    rows, _, tips = _with_tips(spark, sf)
    rows = rows.select("repo", "sha", graph.n_set(F.col("bitmap")).alias("tips"), graph.members(F.col("bitmap")).alias("m"))
    names = tips.select("repo", F.col("sha").alias("name"), "tip")
    for end, place in (("first_tip", F.get("m", F.lit(0))), ("last_tip", F.get("m", F.size("m") - 1))):
        rows = rows.withColumn("tip", place.cast("long")).join(names.withColumnRenamed("name", end), ["repo", "tip"], "left").drop("tip")
    return rows.drop("m")


def _state(spark, sf):
    """Changes with the bitmap of tips and the place of their commit: generation, time and name order as the numbers of commit_order do, without numbering."""
    rows, _, tips = _with_tips(spark, sf)
    generations = graph.generations(*_commits(spark, sf), "sha")
    rows = rows.join(shared.dealt(generations), "sha").select("repo", "path", "status", "bitmap", F.struct("generation", "ts", "sha").alias("ord"))
    return shared.cut(rows), tips


def _named(state, tips):
    """Bitmaps as the tips' names, joined."""
    held = graph.named(state, tips, ["repo"], ["repo", "path"], "sha")
    return held.select("repo", "path", "tips", F.array_join(F.transform("names", lambda s: s.cast("string")), "|").alias("held_by"))


@query("j28_path_tips", sql(f"WITH RECURSIVE {_LEVELS}, {_TIPS}, {_HELD} SELECT repo, path, count(*) AS tips, string_agg(CAST(tip AS VARCHAR), '|' ORDER BY tip) AS held_by FROM s WHERE status <> 'D' GROUP BY ALL", "history"))
def path_tips(spark, sf):
    rows, tips = _state(spark, sf)
    return _named(graph.state_at_tips(rows, ["repo", "path"], "ord"), tips)


@query(
    "j35_exclusive_paths",
    sql(f"WITH RECURSIVE {_LEVELS}, {_TIPS}, {_HELD}, d AS (SELECT max(tip) AS tip FROM t GROUP BY repo), b AS (SELECT repo, path FROM s WHERE status <> 'D' AND tip IN (SELECT tip FROM d) UNION SELECT h.repo, h.path FROM r JOIN history h USING (sha) WHERE h.status = 'A' AND r.tip IN (SELECT tip FROM d)) SELECT repo, path, count(*) AS tips, string_agg(CAST(tip AS VARCHAR), '|' ORDER BY tip) AS held_by FROM s WHERE status <> 'D' AND (repo, path) NOT IN (SELECT (repo, path) FROM b) GROUP BY ALL", "history"),
)
def exclusive_paths(spark, sf):
    """Paths of branch tips that the default branch (the last tip) neither has nor ever added."""
    rows, tips = _state(spark, sf)
    state = shared.cut(graph.state_at_tips(rows, ["repo", "path"], "ord"))
    default = tips.groupBy("repo").agg(F.max("tip").alias("_d"))
    has = lambda df: df.join(shared.dealt(default), "repo").where(graph.has(F.col("bitmap"), F.col("_d"))).select("repo", "path")
    ever = has(state).unionByName(has(rows.where("status = 'A'")))
    return _named(graph.only_at_tips(state, ever, ["repo", "path"]), tips)


@query("a34_renamed_counts")
def renamed_counts(spark, sf):
    """Counts of changes that follow renames; no SQL, as a name's record depends on all renames before."""
    return identity.record_counts(role(spark, sf, "moves"), ["repo"])


@query(
    "w09_case_names",
    sql("SELECT unit, rel, CASE WHEN there OR n = 1 THEN rel ELSE regexp_replace(rel, '(\\.[^./]*)?$', concat('__case', n, '\\1')) END AS name FROM (SELECT *, CASE WHEN NOT there THEN row_number() OVER (PARTITION BY unit, lower(rel), there ORDER BY rel) END + CASE WHEN lower(rel) IN (SELECT lower(rel) FROM source z WHERE z.unit = y.unit) THEN 1 ELSE 0 END AS n FROM (SELECT DISTINCT unit, rel, (unit, rel) IN (SELECT (unit, rel) FROM source) AS there FROM share) y)", "share", "source"),
)
def case_names(spark, sf):
    """Names of delivered files on a share where those of the source are already."""
    return naming.keep_apart(role(spark, sf, "share"), "unit", "rel", role(spark, sf, "source"))


@query(
    "w14_balanced",
    sql("WITH RECURSIVE u AS (SELECT org, repo, bytes, row_number() OVER (PARTITION BY org ORDER BY bytes DESC, repo) AS k FROM (SELECT org, repo, sum(bytes) AS bytes FROM manifest GROUP BY ALL)), w AS (SELECT org, 0 AS k, [0, 0, 0, 0] :: HUGEINT[] AS l, '' AS repo, 0 AS batch FROM (SELECT DISTINCT org FROM u) UNION ALL SELECT w.org, u.k, list_transform(range(1, 5), lambda i: l[i] + CASE WHEN i = list_position(l, list_min(l)) THEN u.bytes ELSE 0 END), u.repo, CAST(list_position(l, list_min(l)) - 1 AS INTEGER) FROM w JOIN u ON u.org = w.org AND u.k = w.k + 1) SELECT org, repo, batch FROM w WHERE k > 0", "manifest"),
)
def balanced(spark, sf):
    units = role(spark, sf, "manifest").groupBy("org", "repo").agg(F.sum("bytes").alias("bytes"))
    return planning.balanced(units, "repo", "bytes", 4, "org")
