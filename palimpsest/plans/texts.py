"""Queries on what tools print: the given tables are written as listings and patches, which the sources read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions import content, paths
from palimpsest.sources import listings

from .catalog import query
from .standins import role, sql

_ID = "sha256(blob)"


def _values(rows, *parts):
    return rows.select(F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("value"))


@query("s07_tree_listing", sql(f"SELECT '100644' AS mode, {_ID} AS blob, CASE WHEN bytes % 10 = 0 THEN -1 ELSE bytes END AS bytes, path FROM active WHERE bytes % 13 <> 5", "active"))
def tree_listing(spark, sf):
    rows, size = role(spark, sf, "active"), F.col("bytes").cast("string")
    kind = F.when(F.col("bytes") % 13 == 5, "160000 commit ").otherwise("100644 blob ")
    return listings.tree_entries(_values(rows, kind, F.sha2("blob", 256), " ", F.lpad(F.when(F.col("bytes") % 10 == 0, "-").otherwise(size), 7, " "), "\t", F.col("path")))


@query("s08_object_sizes", sql(f"SELECT object, min(type) AS type, max(bytes) AS bytes FROM (SELECT {_ID} AS object, CASE WHEN bytes % 7 = 0 THEN 'missing' ELSE 'blob' END AS type, CASE WHEN bytes % 7 <> 0 THEN bytes END AS bytes FROM changes) GROUP BY object", "changes"))
def object_sizes(spark, sf):
    rest = F.when(F.col("bytes") % 7 == 0, " missing").otherwise(F.concat(F.lit(" blob "), F.col("bytes").cast("string")))
    found = listings.object_entries(_values(role(spark, sf, "changes"), F.sha2("blob", 256), rest))
    return found.groupBy("object").agg(F.min("type").alias("type"), F.max("bytes").alias("bytes"))


@query("s11_references", "SELECT sha256(CAST(c_custkey AS VARCHAR)) AS object, CASE c_custkey % 4 WHEN 0 THEN 'heads' WHEN 1 THEN 'tags' WHEN 2 THEN 'remotes' ELSE 'other' END AS kind, CASE c_custkey % 4 WHEN 3 THEN 'refs/stash/' WHEN 2 THEN 'origin/' ELSE '' END || replace(c_name, ' ', '_') AS name FROM customer WHERE c_custkey % 4 <> 2 OR c_custkey % 3 <> 0")
def references(spark, sf):
    rows = spark.read.parquet(f"{sf}/customer.parquet")
    place = F.expr("CASE c_custkey % 4 WHEN 0 THEN 'heads/' WHEN 1 THEN 'tags/' WHEN 2 THEN 'remotes/origin/' ELSE 'stash/' END")
    name = F.when((F.col("c_custkey") % 4 == 2) & (F.col("c_custkey") % 3 == 0), "HEAD").otherwise(F.translate("c_name", " ", "_"))
    return listings.reference_entries(_values(rows, F.sha2(F.col("c_custkey").cast("string"), 256), " refs/", place, name)).select("object", "kind", "name")


@query("s16_pack_listing", "SELECT sha256(CAST(l_partkey AS VARCHAR)) AS object, count(*) AS n, CAST(sum(floor(l_quantity)) AS BIGINT) AS packed, count(*) FILTER (l_linenumber > 3) AS deltas FROM lineitem GROUP BY l_partkey")
def pack_listing(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet")
    key, base = F.sha2(F.col("l_partkey").cast("string"), 256), F.sha2(F.col("l_suppkey").cast("string"), 256)
    delta = F.when(F.col("l_linenumber") > 3, F.concat(F.lit(" "), F.col("l_linenumber").cast("string"), F.lit(" "), base)).otherwise("")
    found = listings.pack_entries(_values(rows, key, " blob   99 ", F.floor("l_quantity").cast("string"), " ", F.col("l_orderkey").cast("string"), delta))
    return found.groupBy("object").agg(F.count("*").alias("n"), F.sum("packed").alias("packed"), F.count("depth").alias("deltas"))


@query(
    "s04_patch_lines",
    """WITH d AS (SELECT doc_id, concat(source, '/d ', doc_id, '.txt') AS path, string_split(text, chr(10)) AS t FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, path, len(t) AS lines, CASE WHEN len(t) > 1 THEN t[2] END AS second, md5(array_to_string(t, chr(10))) AS hash FROM d""",
)
def patch_lines(spark, sf):
    """Every document as one commit that adds its lines."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").where("text IS NOT NULL")
    path = F.concat("source", F.lit("/d "), F.col("doc_id").cast("string"), F.lit(".txt"))
    added = F.array_join(F.transform(F.split("text", "\n", -1), lambda x: F.concat(F.lit("+"), x)), "\n")
    parts = ["\n\ndiff --git a/", path, " b/", path, "\n--- /dev/null\n+++ b/", path, "\n@@ -0,0 +1 @@\n", added, "\n\\ No newline at end of file"]
    records = rows.select("doc_id", F.concat(F.sha2(F.col("doc_id").cast("string"), 256), *[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("value"))
    found = listings.patch_lines(records).groupBy("doc_id", "path").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    text = F.col("l")["line"]
    return found.select("doc_id", "path", F.size("l").cast("long").alias("lines"), F.get(text, F.lit(1)).alias("second"), F.md5(F.array_join(text, "\n")).alias("hash"))


_CHANGED = "CASE doc_id % 4 WHEN 2 THEN chr(8364) || text WHEN 3 THEN chr(233) || chr(10) || text ELSE text END"


@query("f25_decoded", rf"SELECT doc_id, md5({_CHANGED}) AS plain, md5(array_to_string(string_split({_CHANGED}, chr(10)), '|')) AS lines, doc_id % 4 < 2 AS looks FROM documents WHERE regexp_full_match(text, '[\x01-\x7f]*')")
def decoded(spark, sf):
    """ASCII texts: as they are, as UTF-16 behind a mark, and with a first character that only code page 1252 has."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").where(F.col("text").rlike(r"\A[\x01-\x7f]*\z"))
    plain, k = F.col("text").cast("binary"), F.col("doc_id") % 4
    wide = F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-16LE"))
    data = F.when(k == 1, wide).when(k == 2, F.concat(F.unhex(F.lit("80")), plain)).when(k == 3, F.concat(F.unhex(F.lit("E90A")), plain)).otherwise(plain)
    rows = rows.withColumn("data", data)
    lines_ = F.array_join(content.decoded_lines(F.col("data")), "|")
    return rows.select("doc_id", F.md5(content.decoded(F.col("data"))).alias("plain"), F.md5(lines_).alias("lines"), content.looks_text(F.col("data")).alias("looks"))


@query("f05_full_path", "SELECT c_custkey AS id, p AS path, CASE c_custkey % 3 WHEN 2 THEN p || '|All/ORG/repo/' || p ELSE p END AS candidates FROM (SELECT c_custkey, 'src/m' || c_custkey % 4 || '/f' || c_custkey || '.py' AS p FROM customer)")
def full_paths(spark, sf):
    """Whole path, folder and name, and path with organisation and repository in front."""
    rows = spark.read.parquet(f"{sf}/customer.parquet")
    k = F.col("c_custkey")
    name, folder = F.concat(F.lit("f"), k.cast("string"), F.lit(".py")), F.concat(F.lit("src/m"), (k % 4).cast("string"))
    rel = F.when(k % 3 == 0, F.concat_ws("/", folder, name)).when(k % 3 == 1, F.concat(F.lit(" ./"), folder, F.lit("//"))).otherwise(F.concat_ws("\\", F.lit("All"), F.lit("ORG"), F.lit("repo"), F.translate(folder, "/", "\\")))
    args = [rel, name, F.lit("org"), F.lit("Repo")]
    return rows.select(k.alias("id"), paths.full_path(*args).alias("path"), F.array_join(paths.candidates(*args), "|").alias("candidates"))


@query("f48_name_relation", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'includes' WHEN 1 THEN 'conflict' WHEN 2 THEN 'directory' ELSE 'empty' END AS relation FROM pages")
def name_relations(spark, sf):
    k = F.col("page_id")
    rel = F.when(k % 4 == 0, F.concat(F.lit("a\\p"), k.cast("string"), F.lit(".html"))).when(k % 4 == 1, "a/other.html").when(k % 4 == 2, "a/v1.2").otherwise("")
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", paths.name_relation(rel, F.concat(F.lit("p"), k.cast("string"), F.lit(".html"))).alias("relation"))
