"""Writing results: content store, tables in Markdown, CSV with a totals row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _has_files(rows: DataFrame, path: str) -> bool:
    """Whether anything is stored under the path, in any file system that Spark reads."""
    spark = rows.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(at) and any(s.isDirectory() for s in files.listStatus(at))


def content_store(contents: DataFrame, path: str, ext: str = "ext", blob: str = "blob", content: str = "content") -> DataFrame:
    """Write each (ext, blob) that the store lacks once, parted by ext; returns what was refused because its bytes do not hash to its id."""
    head = F.concat(F.lit("blob ").cast("binary"), F.octet_length(content).cast("string").cast("binary"), F.unhex(F.lit("00")))
    rows = contents.withColumn("_ok", F.sha1(F.concat(head, F.col(content))) == F.col(blob))
    good = rows.where("_ok").dropDuplicates([ext, blob]).select(ext, blob, F.octet_length(content).cast("long").alias("bytes"), content)
    if _has_files(contents, path):
        schema = good.schema
        stored = contents.sparkSession.read.schema(schema).parquet(path).select(F.coalesce(ext, F.lit("")).alias(ext), blob)
        good = good.join(stored, [F.coalesce(good[ext], F.lit("")) == stored[ext], good[blob] == stored[blob]], "left_anti")
    good.write.mode("append").partitionBy(ext).parquet(path)
    return rows.where("NOT coalesce(_ok, false)").select(ext, blob)


def markdown(rows: DataFrame, most: int = 1000) -> str:
    """A small result as a Markdown table; of more than ``most`` rows the first ones and a note."""
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    found = rows.take(most + 1)
    out = ["| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    out += ["| " + " | ".join(map(cell, r)) + " |" for r in found[:most]]
    return "\n".join(out + ["", f"(first {most} rows)"] * (len(found) > most))


def csv_lines(rows: DataFrame, path: str, sums: list[str], label: str, order: list[str]) -> None:
    """CSV with CR LF line ends, sorted, and a last row of totals. For small summaries: one file."""
    columns = rows.columns
    total = rows.agg(*[F.sum(c).alias(c) for c in sums]).select(*[F.col(c) if c in sums else F.lit("total" if c == label else None).cast(rows.schema[c].dataType).alias(c) for c in columns])
    quote = lambda c: F.when(F.col(c).cast("string").rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(F.col(c).cast("string"), F.lit("")))
    body = rows.withColumn("_k", F.lit(1)).unionByName(total.withColumn("_k", F.lit(2)))
    body = body.select("_k", *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.concat_ws(",", *[quote(c) for c in columns]).alias("value"))
    head = body.sparkSession.createDataFrame([(0, ",".join(columns))], "_k int, value string")
    lines = body.unionByName(head, allowMissingColumns=True).orderBy("_k", *[f"_o{i}" for i in range(len(order))])
    lines.select("value").coalesce(1).write.option("lineSep", "\r\n").mode("overwrite").text(path)


def line_files(lines: DataFrame, path: str, unit: list[str], order: list[str], line: str = "line") -> None:
    """Ordered lines as text, a folder for each unit: sorted within a unit, without collecting it."""
    lines.repartition(*unit).sortWithinPartitions(*unit, *order).select(*unit, F.col(line).alias("value")).write.mode("overwrite").partitionBy(*unit).text(path)
