"""Queries on readers of formats, pages of documents, and names of files and branches."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions import paths
from palimpsest.operators import pages
from palimpsest.sources import binaries, history, readers

from .catalog import query
from .standins import role, sql


def _lines(spark, sf, value):
    """Each order's lines in order, as one array: no more than an order has. ``value`` of a line is made of its keys only when they are there.

    Orders are dealt by number, as the readers behind work longer on a row than its size tells.
    """
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("line"))
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey").groupBy("l_orderkey")
    return rows.agg(F.transform(F.array_sort(F.collect_list("line")), value).alias("items"))


@query("s26_arrays", "SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS ord, concat('part', l_partkey) AS text FROM lineitem")
def arrays(spark, sf):
    """Each order's parts as a saved array of texts, read back."""
    rows = _lines(spark, sf, lambda x: F.concat(F.lit("part"), x["l_partkey"].cast("string")))
    head = F.concat(F.lit("{'descr': '|S24', 'fortran_order': False, 'shape': ("), F.size("items").cast("string"), F.lit(",), }"))
    padded = F.concat(F.rpad(head, F.lit(117), F.lit(" ")), F.lit("\n")).cast("binary")
    cells = F.unhex(F.array_join(F.transform("items", lambda x: F.rpad(F.hex(x.cast("binary")), F.lit(48), F.lit("0"))), ""))
    content = F.concat(F.unhex(F.lit("934E554D505901007600")), padded, cells)
    found = binaries.npy_text(rows.select(F.col("l_orderkey").cast("string").alias("path"), content.alias("content")))
    return found.where("status = 'text'").select(F.col("path").cast("long").alias("l_orderkey"), "ord", "text")


@query("s27_placemarks", "SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS ord, concat('n<', l_partkey) AS name, concat('a   b  ', l_partkey) AS description, concat('k=', l_suppkey, '; s=', l_partkey) AS fields, concat(l_suppkey, ',', l_partkey, ',0') AS point FROM lineitem")
def placemarks(spark, sf):
    """Each order as a map file with a placemark a line."""
    def mark(x):
        p, s = x["l_partkey"].cast("string"), x["l_suppkey"].cast("string")
        return F.concat(
            F.lit("<Placemark><name>n&lt;"), p, F.lit("</name><name>later</name><description><![CDATA[a <b> b </b>"), p, F.lit("]]></description><ExtendedData><Data name='k'><value>"), s,
            F.lit("</value></Data><SchemaData><SimpleData name='s'>"), p, F.lit("</SimpleData></SchemaData></ExtendedData><Point><coordinates> "), s, F.lit(","), p, F.lit(",0 </coordinates></Point></Placemark>"),
        )

    text = F.concat(F.lit("<kml xmlns='http://www.opengis.net/kml/2.2'><Document><name>orders</name>"), F.array_join("items", "\n"), F.lit("</Document></kml>"))
    rows = _lines(spark, sf, mark).select(F.col("l_orderkey").cast("string").alias("path"), text.cast("binary").alias("content"))
    return readers.placemarks(rows).select(F.col("path").cast("long").alias("l_orderkey"), "ord", "name", "description", "fields", "point")


_PAGES = """p AS (SELECT l_suppkey % 40 AS path, l_orderkey AS version, l_linenumber AS page, min(l_partkey % 900) AS print, min(l_quantity) AS chars FROM lineitem GROUP BY ALL),
f AS (SELECT *, row_number() OVER (PARTITION BY path, print ORDER BY version, page) AS nth, (path, print) IN (SELECT (p_partkey % 40, p_partkey % 900) FROM part WHERE p_size > 25) AS now FROM p),
s AS (SELECT *, CASE WHEN now THEN 'in_today' WHEN nth > 1 THEN 'duplicate' WHEN chars < 20 THEN 'kept_ocr_needed' ELSE 'kept' END AS status FROM f)"""


def _pages(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy((F.col("l_suppkey") % 40).alias("path"), F.col("l_orderkey").alias("version"), F.col("l_linenumber").alias("page"))
    today = spark.read.parquet(f"{sf}/part.parquet").where("p_size > 25").select((F.col("p_partkey") % 40).alias("path"), (F.col("p_partkey") % 900).alias("print"))
    return pages.page_status(rows.agg(F.min(F.col("l_partkey") % 900).alias("print"), F.min("l_quantity").alias("chars")), today)


@query("w04_page_status", f"WITH {_PAGES} SELECT path, version, page, print, status, CASE WHEN status LIKE 'kept%' THEN CAST(count(*) FILTER (status LIKE 'kept%') OVER (PARTITION BY path ORDER BY version, page) AS BIGINT) END AS merged_page FROM s")
def page_status(spark, sf):
    return _pages(spark, sf).drop("chars")


@query("w04_page_counts", f"WITH {_PAGES} SELECT path, count(DISTINCT version) AS versions, count(*) AS pages, count(*) FILTER (status LIKE 'kept%') AS kept, count(*) FILTER (status = 'kept_ocr_needed') AS ocr_needed, count(*) FILTER (status = 'duplicate') AS duplicates, count(*) FILTER (status = 'in_today') AS in_today, count(DISTINCT version) = 1 AND count(*) FILTER (status LIKE 'kept%') = count(*) AS whole_file FROM s GROUP BY path")
def page_counts(spark, sf):
    return pages.page_counts(_pages(spark, sf))


@query("f36_temporary", sql("SELECT unit, rel LIKE '%.tmp.12' AS temporary, count(*) AS files FROM share GROUP BY ALL", "share"))
def temporary(spark, sf):
    return role(spark, sf, "share").groupBy("unit", paths.is_temporary(F.col("rel")).alias("temporary")).agg(F.count("*").alias("files"))


@query("f34_under_files", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN concat('py/', o_orderkey) WHEN 'F' THEN concat('x/files/', o_orderkey) ELSE '' END AS place, o_orderpriority = '5-LOW' AS too_long FROM orders")
def under_files(spark, sf):
    """Stored paths, relative, absolute and elsewhere; some too long in one part."""
    k = F.col("o_orderkey").cast("string")
    stored = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("files\\py/"), k)).when(F.col("o_orderstatus") == "F", F.concat(F.lit("/data/files/x/files/"), k)).otherwise(F.concat(F.lit("/data/profiles/"), k))
    name = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("a/"), F.repeat(F.lit("é"), 128))).otherwise(F.repeat(F.lit("abc/"), 999))
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", paths.under_files(stored).alias("place"), paths.too_long(name).alias("too_long"))


@query("f50_branches", "SELECT event_type, event_type NOT IN ('view', 'click', 'error') OR (event_type = 'view' AND event_id % 2 = 0) AS plausible, count(*) AS n FROM events GROUP BY ALL")
def branches(spark, sf):
    """Names as reflogs give them: branches, references in full and cut short, commits and place-holders."""
    even = F.col("event_id") % 2 == 0
    name = F.when(F.col("event_type") == "view", F.when(even, "refs/heads/x").otherwise("refs/x")).when(F.col("event_type") == "click", F.sha1(F.col("event_id").cast("string"))).when(F.col("event_type") == "error", F.when(even, "HEAD").otherwise("-")).otherwise(F.concat(F.lit("fix/"), "event_id"))
    return spark.read.parquet(f"{sf}/events.parquet").groupBy("event_type", history.plausible_branch(name).alias("plausible")).agg(F.count("*").alias("n"))
