"""Texts of files of many formats below a folder, each read by the reader that its extension names."""

from __future__ import annotations

import html
import re
import xml.etree.ElementTree as ElementTree
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.paths import ext_key

from . import binaries

#: Bytes of a map file that are parsed at once.
PIECE = 1 << 20
PLACEMARKS = "path string, ord bigint, name string, description string, address string, fields string, point string, status string"


def placemarks(files: DataFrame, block: int = 4096) -> DataFrame:
    """Placemarks of map files (KML): path, ord, name, description (without tags), address, fields ('name=value; ...'), point, status ('not_read' for what is no XML).

    The first name and address of a placemark count. A file is parsed as it is read, and a placemark is let go when it is done.
    """
    plain = lambda text: (text or "").strip()
    short: dict[str, str] = {}  # of each tag what follows its namespace
    tags = re.compile("<[^>]+>")
    wanted = {"name", "address", "description", "SimpleData", "Data", "Point"}

    def local(tag: str) -> str:
        if tag not in short:
            if len(short) > 10_000:
                short.clear()
            short[tag] = tag.rsplit("}", 1)[-1]
        return short[tag]

    def below(part: ElementTree.Element, end: str) -> list[str]:
        return [plain(x.text) for x in part if x.tag.endswith(end)]

    def fields(mark: ElementTree.Element) -> tuple[str, ...]:
        found: dict[str, str] = {}
        data: list[str] = []
        for part in mark.iter():
            tag = short.get(part.tag) or local(part.tag)
            if tag not in wanted:
                continue
            if tag in ("name", "address", "description"):
                found[tag] = found.get(tag) or plain(part.text)
            elif tag == "SimpleData":
                data.append(f"{part.get('name', '')}={plain(part.text)}")
            elif tag == "Data":
                data.append(f"{part.get('name', '')}={''.join(below(part, 'value'))}")
            elif tag == "Point":
                found["point"] = " ".join(below(part, "coordinates"))
        description = found.get("description", "")
        if "<" in description:
            description = tags.sub(" ", description)
        if "&" in description:
            description = html.unescape(description)
        return found.get("name", ""), description, found.get("address", ""), "; ".join(data), found.get("point", "")

    def at_once(content: bytes) -> list[tuple[str, ...]] | None:
        """Of a small file; None if it is to be read in pieces: no XML, or a placemark within another."""
        try:
            root = ElementTree.fromstring(content)
        except ElementTree.ParseError:
            return None
        marks = [x for name in {x.tag for x in root.iter()} if local(name) == "Placemark" for x in root.iter(name)]
        names = {x.tag for x in marks}
        if len(names) > 1 or any(x is not m for name in names for m in marks for x in m.iter(name)):
            return None
        return [fields(m) for m in marks]

    def in_pieces(content: bytes) -> Iterator[tuple[str, ...] | None]:
        """None at the end of what is no XML."""
        parser = ElementTree.XMLPullParser(["end"])
        try:
            for at in range(0, len(content) + 1, PIECE):
                parser.feed(content[at : at + PIECE])
                if at + PIECE > len(content):
                    parser.close()
                for _, part in parser.read_events():
                    if local(part.tag) == "Placemark":
                        yield fields(part)
                        part.clear()
        except ElementTree.ParseError:
            yield None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("bigint") else pa.string()) for c in PLACEMARKS.split(", ")])
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        for batch in batches:
            rows: list[tuple] = []
            for path, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                content = value.as_py()
                found = at_once(content) if len(content) < PIECE else None
                for n, mark in enumerate(in_pieces(content) if found is None else found):
                    rows.append((path, n, *mark, "ok") if mark is not None else (path, n, None, None, None, None, None, "not_read"))
                    if len(rows) >= block:
                        yield batch_of(rows)
                        rows = []
            if rows:
                yield batch_of(rows)

    return files.where("content IS NOT NULL").select(F.col("path").cast("string").alias("path"), "content").mapInArrow(run, PLACEMARKS)


def _members(files: DataFrame, end: str) -> DataFrame:
    """The members of archives with an ending, as files '<path>!<member>'; what could not be opened has no content."""
    return binaries.archive_members(files, depth=1).where(F.lower("member").endswith(end)).select(F.concat_ws("!", "path", "member").alias("path"), "content", "status")


def _within(files: DataFrame, end: str, reader: Callable[[DataFrame], DataFrame]) -> DataFrame:
    found = _members(files, end)
    shut = found.where("content IS NULL").select("path", F.lit(None).cast("bigint").alias("ord"), F.lit(None).cast("string").alias("text"), "status")
    return reader(found.where("content IS NOT NULL").select("path", "content")).unionByName(shut)


def npz_text(files: DataFrame) -> DataFrame:
    """Strings in archives of saved arrays: as ``npy_text``, with the path '<path>!<array>.npy'."""
    return _within(files, ".npy", binaries.npy_text)


def placemark_text(files: DataFrame) -> DataFrame:
    """Placemarks as lines: path, ord, text (cells joined by ' | '), status."""
    return placemarks(files).select("path", "ord", F.concat_ws(" | ", "name", "description", "address", "fields", "point").alias("text"), "status")


def _plain(df: DataFrame, text: str = "text") -> DataFrame:
    return df.select("path", "ord", F.col(text).alias("text"), "status")


def _notebooks(files: DataFrame) -> DataFrame:
    return binaries.notebook_outputs(files).select("path", (F.col("cell") * 1_000_000 + F.col("output")).cast("bigint").alias("ord"), "text", F.lit("ok").alias("status"))


#: What reads which extensions: (path, content) to (path, ord, text, status). ``ord`` is in order within a path, or within its table.
READERS: dict[str, tuple[list[str], Callable[[DataFrame], DataFrame]]] = {
    "arrays": (["npy"], binaries.npy_text),
    "array archives": (["npz"], npz_text),
    "columnar": (["arrow", "feather"], binaries.columnar_rows),
    "pickles": (["pkl", "pickle"], lambda files: _plain(binaries.pickle_strings(files))),
    "databases": (["sqlite", "db"], lambda files: _plain(binaries.sqlite_rows(files), "row")),
    "notebooks": (["ipynb"], _notebooks),
    "maps": (["kml"], placemark_text),
    "map archives": (["kmz"], lambda files: _within(files, ".kml", placemark_text)),
}


def _glob(exts: list[str]) -> str:
    either = lambda c: f"[{c.lower()}{c.upper()}]" if c.isalpha() else c
    return "*.{" + ",".join("".join(map(either, e)) for e in exts) + "}"


def texts(spark: SparkSession, root: str, readers: dict[str, tuple[list[str], Callable[[DataFrame], DataFrame]]] = READERS) -> DataFrame:
    """Texts of the files below a folder: path, reader, ord, text, status. Files that no reader takes have status 'no_reader' and no text.

    Each reader lists only its own names, so a file's content is read once, by one reader; those without a reader are listed and not read.
    Files of no bytes are left out by Spark's file sources.
    """
    source = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = [read(source.option("pathGlobFilter", _glob(exts)).load(root).select("path", "content")).withColumn("reader", F.lit(name)) for name, (exts, read) in readers.items()]
    known = [e for exts, _ in readers.values() for e in exts]
    every = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rest = every.where(~ext_key(F.col("path")).isin(known)).select("path", F.lit(None).cast("bigint").alias("ord"), F.lit(None).cast("string").alias("text"), F.lit("no_reader").alias("status"), F.lit("").alias("reader"))
    return reduce(DataFrame.unionByName, [*found, rest]).select("path", "reader", "ord", "text", "status")
