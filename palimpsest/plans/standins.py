"""Given tables in the roles of the data model, as select lists that Spark and SQL read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_PATH = "concat('src/m', {0} % 4, '/f', {0}, CASE {0} % 5 WHEN 0 THEN '.py' WHEN 1 THEN '.java' WHEN 2 THEN '.txt' WHEN 3 THEN '' ELSE '.csv' END)"
_PLACE = ["concat('org', {0} % 7 % 3) AS org", "concat('repo', {0} % 7) AS repo", _PATH + " AS path"]
_STATUS = "CASE event_type WHEN 'signup' THEN 'A' WHEN 'error' THEN 'D' WHEN 'purchase' THEN 'R' WHEN 'click' THEN 'T' ELSE 'M' END AS status"
_BLOB = ["concat('b', CAST(floor(value) AS BIGINT)) AS blob", "CAST(floor(value) AS BIGINT) * 37 % 5000 AS bytes"]
_DAY = "concat(CAST(year(l_shipdate) AS VARCHAR(4)), '/', CAST(month(l_shipdate) AS VARCHAR(2)), '/', CAST(day(l_shipdate) AS VARCHAR(2)), '/', CAST(l_orderkey AS VARCHAR(20))) AS path"

_STORED = "CASE o_orderstatus WHEN 'F' THEN concat('pack/pack-', o_orderkey, '.pack') WHEN 'O' THEN concat(substr(md5(concat('', o_orderkey)), 1, 2), '/', md5(concat('', o_orderkey))) ELSE concat('info/x', o_orderkey) END AS rel"

def _place(key: str) -> list[str]:
    return [x.format(key) for x in _PLACE]


#: Role: table, select list, filter.
ROLES: dict[str, tuple[str, list[str], str]] = {
    "changes": (
        "events",
        [*_place("user_id"), "event_id AS ord", "concat('c', event_id % 2500) AS commit", "ts", "concat('a', event_id % 11) AS author", _STATUS, *_BLOB, "CAST(floor(value) AS BIGINT) AS added", "event_id % 97 AS deleted"],
        "true",
    ),
    # The history's repo3 has no active copy; another one, repo9, has nothing else.
    "active": ("customer", ["concat('org', c_custkey % 7 % 3) AS org", "CASE c_custkey % 7 WHEN 3 THEN 'repo9' ELSE concat('repo', c_custkey % 7) END AS repo", _PATH.format("c_custkey") + " AS path", "concat('b', c_custkey % 490) AS blob", "c_custkey % 490 * 37 % 5000 AS bytes"], "true"),
    "processed": ("part", ["concat('repo', p_partkey % 7) AS repo", "concat('b', p_partkey % 123 * 4) AS blob"], "true"),
    "inv_a": ("documents", ["source AS repo", "concat(lang, CASE WHEN doc_id % 3 = 0 THEN '/old/d' ELSE '/d' END, doc_id, '.txt') AS path", "md5(text) AS hash", "n_chars AS bytes"], "true"),
    "inv_b": (
        "documents",
        ["source AS repo", "concat(lang, CASE WHEN doc_id % 4 = 0 THEN '/new/d' ELSE '/d' END, CASE WHEN doc_id % 10 = 2 THEN -doc_id ELSE doc_id END, '.txt') AS path", "CASE WHEN doc_id % 10 = 1 THEN md5(concat(text, 'x')) ELSE md5(text) END AS hash", "CASE WHEN doc_id % 10 = 1 THEN n_chars + 1 ELSE n_chars END AS bytes"],
        "true",
    ),
    "packs": ("lineitem", ["l_suppkey AS pack", "l_partkey AS object", "CAST(floor(l_quantity) AS BIGINT) AS bytes"], "true"),
    "manifest": (
        "orders",
        ["concat('org', o_custkey % 5) AS org", "concat('repo', o_custkey % 40) AS repo", "concat('d', o_orderkey % 9, '/f', o_orderkey % 1000, '.', lower(substr(o_orderpriority, 3, 3))) AS path", "o_orderkey AS ord", "concat('s', o_orderkey % 700) AS sha", "CAST(floor(o_totalprice) AS BIGINT) AS bytes", "CASE o_orderstatus WHEN 'O' THEN 'written' WHEN 'F' THEN 'deduped' ELSE 'failed' END AS action", "o_orderdate AS ts"],
        "true",
    ),
    "urls": ("pages", ["page_id", "url", "regexp_replace(regexp_replace(url, '^https?://[^/]+/', ''), '[?#].*$', '') AS path", "html"], "true"),
    "share": (
        "orders",
        ["concat('unit', o_custkey % 11) AS unit", "concat(CASE WHEN o_orderkey % 13 = 0 THEN 'F' WHEN o_orderkey % 5 = 0 THEN 'only/f' ELSE 'f' END, o_orderkey % 3000, CASE WHEN o_orderkey % 50 = 7 THEN '.tmp.12' ELSE '' END) AS rel", "o_orderkey % 3000 + CASE WHEN o_orderkey % 29 = 0 THEN 1 ELSE 0 END AS bytes"],
        "true",
    ),
    "source": ("orders", ["concat('unit', o_custkey % 11) AS unit", "concat(CASE WHEN o_orderkey % 4 = 0 THEN 'here/f' ELSE 'f' END, o_orderkey % 3000) AS rel", "o_orderkey % 3000 AS bytes"], "true"),
    "runs": ("events", ["concat('repo', user_id) AS unit", "event_id % 6 AS run", "ts AS finished", "event_id AS ord", "CASE WHEN event_type IN ('view', 'click') THEN 'ok' WHEN event_type = 'error' THEN 'timeout' ELSE 'failed' END AS status"], "true"),
    "old_files": ("lineitem", ["l_linenumber AS unit", _DAY, "concat('b', CAST(floor(l_quantity) AS BIGINT)) AS blob"], "l_shipdate < TIMESTAMP '1998-10-01 00:00:00'"),
    "new_files": ("lineitem", ["l_linenumber AS unit", _DAY, "concat('b', CAST(floor(l_quantity) AS BIGINT), CASE WHEN l_returnflag = 'R' AND l_quantity > 49 THEN 'x' ELSE '' END) AS blob"], "l_shipdate >= TIMESTAMP '1992-03-01 00:00:00'"),
    # A main line of 200 commits a repository; every ten commits a branch of three, merged back or left as a tip.
    "history": (
        "events",
        ["concat('repo', CAST(floor(event_id / 200) AS BIGINT)) AS repo", "event_id AS sha", "ts", _PATH.format("user_id") + " AS path", _STATUS, *_BLOB,
         "CASE WHEN event_id % 200 = 0 THEN NULL WHEN event_id % 10 = 6 THEN event_id - 4 ELSE event_id - 1 END AS parent", "CASE WHEN event_id % 10 = 6 AND event_type <> 'view' THEN event_id - 1 END AS merged"],
        "true",
    ),
    "lfs_changes": ("events", [*_place("user_id"), "event_id AS ord", "concat('c', event_id % 2500) AS commit", _STATUS, "concat('b', CAST(floor(value) AS BIGINT)) AS blob", "CAST(floor(value) AS BIGINT) * 37 % 5000 AS bytes", "CASE WHEN CAST(floor(value) AS BIGINT) % 6 = 0 THEN concat('o', CAST(floor(value) AS BIGINT)) END AS lfs_oid", "CASE WHEN CAST(floor(value) AS BIGINT) % 6 = 0 THEN CAST(floor(value) AS BIGINT) * 1000 END AS lfs_bytes"], "true"),
    "lfs_active": ("customer", [*_place("c_custkey"), "CASE WHEN c_nationkey <> 7 THEN concat('b', c_custkey % 190) END AS blob", "concat('o', c_custkey % 190) AS sha256", "CASE WHEN c_nationkey = 3 THEN NULL WHEN c_custkey % 190 % 6 = 0 AND c_nationkey > 12 THEN c_custkey % 190 * 1000 ELSE c_custkey % 190 * 37 % 5000 END AS bytes"], "c_mktsegment <> 'BUILDING'"),
    "moves": ("events", ["concat('repo', user_id % 7) AS repo", "event_id AS ord", "ts", "concat('c', event_id) AS commit", "CASE WHEN event_type = 'purchase' AND value >= 100 THEN 'R100' WHEN event_type = 'signup' THEN 'A' WHEN event_type = 'error' THEN 'D' ELSE 'M' END AS status", "CASE WHEN event_type = 'purchase' AND value >= 100 THEN concat('f', user_id + 7) ELSE concat('f', user_id) END AS path", "CASE WHEN event_type = 'purchase' AND value >= 100 THEN concat('f', user_id) END AS old_path"], "true"),
    # Files in archives and archives themselves; two listings of object folders; objects; what steps wrote.
    "members": (
        "lineitem",
        ["concat('org', l_suppkey % 3) AS org", "concat('repo', l_suppkey % 40) AS repo", "CASE l_linenumber WHEN 7 THEN '' ELSE concat('x/f', l_partkey) END AS inner_path", "CASE l_partkey % 6 WHEN 0 THEN 'PY' WHEN 1 THEN 'py' WHEN 2 THEN 't~mp' WHEN 3 THEN '' WHEN 4 THEN 'zip' ELSE 'csv' END AS ext",
         "CASE l_partkey % 6 WHEN 0 THEN 'code' WHEN 1 THEN 'code' WHEN 2 THEN 'other' WHEN 3 THEN 'no_extension' WHEN 4 THEN 'archive' ELSE 'table' END AS route", "concat('s', l_partkey) AS sha", "CAST(floor(l_extendedprice) AS BIGINT) AS bytes", "l_shipdate AS ts",
         "CASE WHEN l_partkey % 6 = 4 AND l_linestatus = 'O' THEN 'opened_nested' WHEN l_returnflag = 'A' THEN 'written' WHEN l_returnflag = 'N' THEN 'deduped' ELSE 'too_large' END AS action"],
        "true",
    ),
    "archives": (
        "orders",
        ["concat('org', o_custkey % 3) AS org", "concat('repo', o_custkey % 41) AS repo", "concat('a/b', o_orderkey, '.', substr(o_orderpriority, 3, 3)) AS archive_path", "CASE o_custkey % 9 WHEN 0 THEN 'split_set' ELSE 'version' END AS source",
         "CASE WHEN o_orderstatus = 'O' THEN 'ok' WHEN o_orderstatus = 'P' THEN 'too_large' WHEN o_orderpriority = '5-LOW' THEN 'split_part' WHEN o_orderpriority = '2-HIGH' THEN 'encrypted' ELSE 'failed: bad header' END AS status", "CASE WHEN o_orderstatus <> 'F' THEN o_orderkey % 50 END AS members"],
        "true",
    ),
    "folder_before": ("orders", ["concat('repo', o_custkey % 40) AS repo", _STORED, "CAST(floor(o_totalprice) AS BIGINT) AS bytes"], "o_custkey % 40 <> 4"),
    "folder_after": ("orders", ["concat('repo', o_custkey % 40) AS repo", _STORED, "CAST(floor(o_totalprice) AS BIGINT) AS bytes"], "o_custkey % 40 <> 3 AND (o_orderstatus = 'F' AND o_totalprice > 300000 OR o_orderstatus = 'O' AND o_totalprice > 490000)"),
    "objects": ("lineitem", ["l_suppkey AS repo", "l_partkey AS object", "CASE l_partkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'commit' WHEN 2 THEN 'tree' WHEN 3 THEN 'tag' ELSE 'blob' END AS type", "l_partkey * 7 % 5000 AS bytes", "l_returnflag = 'R' AS loose"], "true"),
    "outputs": ("orders", ["concat('unit', o_custkey % 11) AS unit", "lower(substr(o_orderpriority, 3, 3)) AS type", "concat('step', o_orderstatus) AS step", "concat('f', o_orderkey) AS output", "o_orderdate AS ts", "CAST(floor(o_totalprice) AS BIGINT) AS bytes"], "true"),
    "commits": ("events", ["event_id AS sha", "CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_id - 1 - event_id % 3 END AS parent", "event_type AS branch"], "true"),
}


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table in a role."""
    table, columns, where = ROLES[name]
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").where(where).selectExpr(*columns)


def sql(query: str, *names: str) -> str:
    """A query over roles, as SQL over the given tables."""
    parts = []
    for name in names:
        table, columns, where = ROLES[name]
        parts.append(f"{name} AS (SELECT {', '.join(columns)} FROM {table} WHERE {where})")
    lead = "WITH RECURSIVE " if "RECURSIVE" in query else "WITH "
    query = query.replace("RECURSIVE ", "", 1) if "RECURSIVE" in query else query
    return lead + ", ".join(parts) + (", " + query.strip()[5:] if query.strip().upper().startswith("WITH ") else "\n" + query)
