"""Binary files as rows: archives, pack indexes, pickles, notebooks, embedded databases.

Each reader takes a DataFrame with ``path`` and ``content`` (as the binaryFile source gives) and returns a row per thing
found. A file that cannot be read gives a row with its status; nothing that a file contains is ever executed.
"""

from __future__ import annotations

import bz2
import gzip
import hashlib
import io
import lzma
import pickletools
import re
import sqlite3
import struct
import tarfile
import tempfile
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import feather
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMBERS = "path string, member string, depth int, bytes bigint, sha256 string, content binary, status string"
ARCHIVE_ENDS = (".zip", ".jar", ".tar", ".tgz", ".gz", ".bz2", ".xz", ".lzma", ".nupkg", ".war")


def _kind(data: bytes) -> str:
    heads = {b"PK\x03\x04": "zip", b"PK\x05\x06": "zip", b"\x1f\x8b": "gz", b"BZh": "bz2", b"\xfd7zXZ\x00": "xz"}
    for head, name in heads.items():
        if data.startswith(head):
            return name
    return "tar" if data[257:262] == b"ustar" else ""


def _limited(f, most: int) -> bytes:
    data = f.read(most + 1)
    if len(data) > most:
        raise OverflowError("too_large")
    return data


def _open(data: bytes, name: str, most: int) -> Iterator[tuple[str, bytes | None, str]]:
    """(member name, bytes, status) of one archive."""
    kind = _kind(data)
    if kind == "zip":
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for info in z.infolist():
                if info.is_dir():
                    continue
                if info.flag_bits & 1:
                    yield info.filename, None, "encrypted"
                elif info.file_size > most:
                    yield info.filename, None, "too_large"
                else:
                    with z.open(info) as f:
                        yield info.filename, _limited(f, most), "ok"
    elif kind == "tar":
        with tarfile.open(fileobj=io.BytesIO(data), mode="r:") as t:
            for m in t:
                if m.isfile():
                    yield m.name, None if m.size > most else t.extractfile(m).read(), "too_large" if m.size > most else "ok"
    else:
        opener = {"gz": gzip.open, "bz2": bz2.open, "xz": lzma.open}[kind]
        with opener(io.BytesIO(data), "rb") as f:
            stem = name.rsplit("/", 1)[-1]
            for end in (".gz", ".bz2", ".xz", ".lzma"):
                stem = stem.removesuffix(end)
            yield (stem[:-4] + ".tar" if stem.endswith(".tgz") else stem), _limited(f, most), "ok"


def archive_members(files: DataFrame, depth: int = 5, most: int = 64 << 20, members: int = 100_000) -> DataFrame:
    """Members of archives, and of archives within them down to ``depth``: a row each, with what became of it.

    status: ok, archive (opened further), too_large, encrypted, damaged, too_deep, too_many. Limits are per file.
    """

    def walk(path: str, name: str, data: bytes, level: int, left: list[int]) -> Iterator[tuple]:
        try:
            for member, inner, status in _open(data, name, most):
                left[0] -= 1
                if left[0] < 0:
                    yield path, f"{name}!{member}" if level else member, level, None, None, None, "too_many"
                    return
                full = f"{name}!{member}" if level else member
                if inner is None:
                    yield path, full, level, None, None, None, status
                    continue
                nested = bool(_kind(inner)) and member.lower().endswith(ARCHIVE_ENDS)
                status = "ok" if not nested else "archive" if level + 1 < depth else "too_deep"
                yield path, full, level, len(inner), hashlib.sha256(inner).hexdigest(), None if status == "archive" else inner, status
                if status == "archive":
                    yield from walk(path, full, inner, level + 1, left)
        except OverflowError:
            yield path, name, level, None, None, None, "too_large"
        except (zipfile.BadZipFile, tarfile.TarError, OSError, EOFError, zlib.error, lzma.LZMAError, NotImplementedError, RuntimeError):
            yield path, name, level, None, None, None, "damaged"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MEMBERS.split(", ")]
        for pdf in frames:
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                if not _kind(data):
                    yield pd.DataFrame([(path, path, 0, len(data), None, None, "not_an_archive")], columns=names)
                    continue
                batch: list[tuple] = []
                size = 0
                for row in walk(path, path, data, 0, [members]):
                    batch.append(row)
                    size += len(row[5] or b"")
                    if size > 8 << 20 or len(batch) > 5000:
                        yield pd.DataFrame(batch, columns=names)
                        batch, size = [], 0
                if batch:
                    yield pd.DataFrame(batch, columns=names)

    return files.select("path", "content").mapInPandas(run, MEMBERS)


def split_part_status(parts: DataFrame, key: str, part: str, version: str) -> DataFrame:
    """The rows with ``status``: split_part (the newest version of its part, in a set that has parts 1 to n),
    split_part_older_version, or incomplete_set. Partial aggregates; ``version`` tells the versions of a part apart.
    """
    newest = parts.groupBy(key, part).agg(F.max(version).alias("_v"))
    sets = newest.groupBy(key).agg(F.count("*").alias("_n"), F.min(part).alias("_a"), F.max(part).alias("_b"))
    rows = parts.join(newest, [key, part]).join(sets.select(key, ((F.col("_a") == 1) & (F.col("_b") == F.col("_n"))).alias("_whole")), key)
    status = F.when(~F.col("_whole"), "incomplete_set").when(F.col(version) == F.col("_v"), "split_part").otherwise("split_part_older_version")
    return rows.withColumn("status", status).drop("_v", "_whole")


def join_split_sets(parts: DataFrame, key: str, part: str, content: str, version: str | None = None, most: int = 1 << 30) -> DataFrame:
    """Sets of numbered parts: the joined bytes if parts 1 to n are all there, else null and the status 'gap'.

    Of several versions of a part the newest counts. A set of more than ``most`` bytes is never brought together: its status is
    'too_large', and its parts are to be read in order, part by part. Sizes are added up before any bytes are moved.
    """
    rows = parts.select(key, F.col(part).alias("n"), F.col(content).alias("c"), (F.col(version) if version else F.lit(0)).alias("v"))
    newest = rows.groupBy(key, "n").agg(F.max(F.struct("v", F.octet_length("c").cast("long").alias("b"))).alias("m")).select(key, "n", "m.v", "m.b")
    sets = newest.groupBy(key).agg(F.count("*").alias("parts"), F.min("n").alias("a"), F.max("n").alias("z"), F.sum("b").alias("b"))
    status = F.when((F.col("a") != 1) | (F.col("z") != F.col("parts")), "gap").when(F.col("b") > most, "too_large").otherwise("ok")
    sets = sets.select(key, F.col("parts").cast("int").alias("parts"), status.alias("status"))
    whole = rows.join(newest.drop("b"), [key, "n", "v"]).join(sets.where("status = 'ok'").select(key), key, "left_semi")
    joined = whole.dropDuplicates([key, "n"]).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("n", "c"))).alias("p"))
    # Some parts together, then these together, so that bytes are not copied once for each part.
    whole_of = lambda parts: F.aggregate(parts, F.lit(b""), lambda a, c: F.concat(a, c))
    some = F.transform(F.sequence(F.lit(1), F.size("p"), F.lit(32)), lambda k: whole_of(F.transform(F.slice("p", k, F.lit(32)), lambda x: x["c"])))
    joined = joined.select(key, whole_of(some).alias("content"))
    return sets.join(joined, key, "left").select(key, "parts", "status", "content")


def columnar_rows(files: DataFrame, block: int = 4096) -> DataFrame:
    """Rows of Arrow files and streams and of Feather files: path, ord, text (cells joined by ' | ', nested ones as JSON), status. A header row first."""
    import json

    def cell(v: object) -> str:
        text = json.dumps(v, default=str, ensure_ascii=False) if isinstance(v, (list, dict)) else "" if v is None else str(v)
        return re.sub(r"\r\n|\r|\n", " ", text)

    def batches(data: bytes) -> Iterator[pa.RecordBatch]:
        if data[:6] == b"ARROW1":
            reader = pa.ipc.open_file(pa.py_buffer(data))
            for k in range(reader.num_record_batches):
                yield reader.get_batch(k)
        elif data[:4] == b"FEA1":
            yield from feather.read_table(pa.BufferReader(data)).to_batches(block)
        else:
            yield from pa.ipc.open_stream(pa.py_buffer(data))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "ord", "text", "status"]
        for pdf in frames:
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                n = 0
                try:
                    for batch in batches(data):
                        if not n:
                            yield pd.DataFrame([(path, 0, " | ".join(batch.schema.names), "ok")], columns=names)
                        for k in range(0, batch.num_rows, block):
                            part = batch.slice(k, block)
                            rows = [(path, n + 1 + i, " | ".join(map(cell, r)), "ok") for i, r in enumerate(zip(*(c.to_pylist() for c in part.columns), strict=True))]
                            n += len(rows)
                            yield pd.DataFrame(rows, columns=names)
                except (pa.ArrowInvalid, OSError, ValueError) as e:
                    yield pd.DataFrame([(path, n + 1, None, f"not_read: {str(e)[:40]}")], columns=names)

    return files.select("path", "content").mapInPandas(run, "path string, ord bigint, text string, status string")


def npy_text(files: DataFrame, block: int = 65536) -> DataFrame:
    """Strings in saved arrays: path, ord, text, status (text, numeric, object, structured or bad_header; only the first has text). Nothing is unpickled."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = lambda rows: pd.DataFrame(rows, columns=["path", "ord", "text", "status"]).astype({"ord": "Int64"})
        for pdf in frames:
            rows: list[tuple] = []  # of several files, so that small ones are not handed on one by one
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                stream = io.BytesIO(data)
                try:
                    major = np.lib.format.read_magic(stream)[0]
                    _, _, kind = (np.lib.format.read_array_header_1_0 if major == 1 else np.lib.format.read_array_header_2_0)(stream)
                except (ValueError, EOFError, SyntaxError):
                    rows.append((path, None, None, "bad_header"))
                    continue
                what = "structured" if kind.names else "object" if kind.kind == "O" else "text" if kind.kind in "US" and kind.itemsize else "numeric"
                if what != "text":
                    rows.append((path, None, None, what))
                    continue
                many = (len(data) - stream.tell()) // kind.itemsize
                for k in range(0, many, block):
                    part = np.frombuffer(data, kind, min(block, many - k), stream.tell() + k * kind.itemsize)
                    texts = [x.decode("utf-8", "replace") if isinstance(x, bytes) else x for x in part.tolist()]
                    rows.extend((path, k + i, t, "text") for i, t in enumerate(texts) if t)
                    if len(rows) >= block:
                        yield frame(rows)
                        rows = []
            if rows:
                yield frame(rows)

    return files.select("path", "content").mapInPandas(run, "path string, ord bigint, text string, status string")


def pack_index(files: DataFrame) -> DataFrame:
    """Object ids of pack indexes (version 2, SHA-1): path, object, crc32, pack offset. A bad layout gives one row with its status."""

    def parse(data: bytes) -> pd.DataFrame:
        if data[:8] != b"\xfftOc\x00\x00\x00\x02" or len(data) < 8 + 1024 + 40:
            raise ValueError("not_v2")
        fan = np.frombuffer(data, ">u4", 256, 8)
        n = int(fan[-1])
        at = 8 + 1024
        if (np.diff(fan.astype(np.int64)) < 0).any() or len(data) < at + n * 28 + 40:
            raise ValueError("bad_layout")
        ids = np.frombuffer(data, np.uint8, n * 20, at).reshape(n, 20)
        crc = np.frombuffer(data, ">u4", n, at + n * 20)
        small = np.frombuffer(data, ">u4", n, at + n * 24).astype(np.int64)
        large = np.frombuffer(data, ">u8", (len(data) - 40 - at - n * 28) // 8, at + n * 28)
        far = small >> 31 == 1
        small[far] = large[small[far] & 0x7FFFFFFF].astype(np.int64)
        return pd.DataFrame({"object": [x.tobytes().hex() for x in ids], "crc32": crc.astype(np.int64), "offset": small, "status": "ok"})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    out = parse(data)
                except (ValueError, IndexError) as e:
                    out = pd.DataFrame({"object": [None], "crc32": [None], "offset": [None], "status": [str(e)[:40]]})
                yield out.assign(path=path)[["path", "object", "crc32", "offset", "status"]]

    return files.select("path", "content").mapInPandas(run, "path string, object string, crc32 bigint, offset bigint, status string")


def loose_objects(files: DataFrame) -> DataFrame:
    """Loose objects: id (from the path), type, size, whether the bytes hash to the id."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                name = "".join(path.split("/")[-2:])
                try:
                    raw = zlib.decompress(data)
                    head = raw.partition(b"\x00")[0].split(b" ")
                    rows.append((name, head[0].decode("ascii"), int(head[1]), hashlib.sha1(raw).hexdigest() == name, "ok"))
                except (zlib.error, ValueError, IndexError):
                    rows.append((name, None, None, False, "damaged"))
            yield pd.DataFrame(rows, columns=["object", "type", "size", "verified", "status"])

    return files.select("path", "content").mapInPandas(run, "object string, type string, size bigint, verified boolean, status string")


def pickle_strings(files: DataFrame, least: int = 4) -> DataFrame:
    """Strings and names in pickles, read from their opcodes; a pickle is never loaded. Several pickles may follow each other."""

    def texts(data: bytes) -> Iterator[tuple[str, str]]:
        f = io.BytesIO(data)
        while f.tell() < len(data):
            for op, arg, _ in pickletools.genops(f):
                if op.name == "GLOBAL":
                    yield "class", arg.replace(" ", ".")
                elif isinstance(arg, str):
                    yield "text", arg
                elif isinstance(arg, bytes | bytearray):
                    yield "text", bytes(arg).decode("utf-8", "replace")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "ord", "kind", "text", "status"]
        for pdf in frames:
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                rows: list[tuple] = []
                try:
                    for kind, text in texts(data):
                        if len(text) >= least:
                            rows.append((path, len(rows), kind, text, "ok"))
                except (ValueError, EOFError, IndexError, struct.error, KeyError, UnicodeDecodeError):
                    rows.append((path, len(rows), None, None, "not_read"))
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return files.select("path", "content").mapInPandas(run, "path string, ord bigint, kind string, text string, status string")


def sqlite_rows(files: DataFrame, block: int = 4096) -> DataFrame:
    """Rows of all tables of embedded databases as JSON text: path, table, ord, row, status. Handed on ``block`` rows at a time."""
    import json

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "table", "ord", "row", "status"]
        for pdf in frames:
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                rows: list[tuple] = []
                with tempfile.NamedTemporaryFile(suffix=".db") as tmp:
                    tmp.write(data)
                    tmp.flush()
                    try:
                        db = sqlite3.connect(f"file:{tmp.name}?mode=ro&immutable=1", uri=True)
                        for (table,) in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name").fetchall():
                            quoted = table.replace('"', '""')
                            found = db.execute(f'SELECT * FROM "{quoted}"')
                            cols = [d[0] for d in found.description]
                            for k, row in enumerate(found):
                                rows.append((path, table, k, json.dumps(dict(zip(cols, row, strict=True)), default=str), "ok"))
                                if len(rows) == block:
                                    yield pd.DataFrame(rows, columns=names)
                                    rows = []
                        db.close()
                    except sqlite3.DatabaseError:
                        rows.append((path, None, None, None, "not_read"))
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return files.select("path", "content").mapInPandas(run, "path string, table string, ord bigint, row string, status string")


def notebook_outputs(files: DataFrame) -> DataFrame:
    """Text outputs of notebook cells, without Python: path, cell, output, text."""
    schema = "struct<cells:array<struct<cell_type:string,outputs:array<struct<output_type:string,text:array<string>,data:map<string,array<string>>>>>>>"
    book = F.from_json(F.decode("content", "UTF-8"), schema)
    cells = files.select("path", F.posexplode(book["cells"]).alias("cell", "c"))
    outs = cells.select("path", "cell", F.posexplode("c.outputs").alias("output", "o"))
    plain = F.coalesce(F.col("o.text"), F.try_element_at("o.data", F.lit("text/plain")))
    return outs.select("path", "cell", "output", F.array_join(plain, "").alias("text")).where("text IS NOT NULL")


def hash_names(lines: DataFrame, column: str = "value") -> DataFrame:
    """'<hex>.<ext>' names in free text, with the first md5 on the line."""
    name = r"\b([0-9a-f]{40}|[0-9a-f]{64})\.([A-Za-z0-9]+)\b"
    md5 = F.nullif(F.regexp_extract(F.lower(column), r"(?<![0-9a-f])([0-9a-f]{32})(?![0-9a-f])", 1), F.lit(""))
    rows = lines.select(F.explode(F.regexp_extract_all(F.lower(column), F.lit(name), F.lit(0))).alias("name"), md5.alias("md5"))
    return rows.select(F.substring_index("name", ".", 1).alias("blob"), F.substring_index("name", ".", -1).alias("ext"), "md5")


def html_table_rows(pages: DataFrame, column: str = "value") -> DataFrame:
    """Cells of the rows of HTML tables (exports that call themselves spreadsheets): row (array of texts), in order."""
    cells = F.transform(F.regexp_extract_all(F.col("_r"), F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]*>", ""), "&nbsp;", " ")))
    return pages.select(F.posexplode(F.regexp_extract_all(F.col(column), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row_no", "_r")).select("row_no", cells.alias("row"))
