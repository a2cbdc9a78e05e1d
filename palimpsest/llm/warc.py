"""WARC archives: a deduplicating writer and a salvage reader.

The writer stores each payload once; pages with an equal payload become revisit records. The salvage reader
checks every record (gzip checksum, version line, lengths, block and payload digests). After a failed check it
searches for the next gzip member or version line that begins a valid record, goes on from there, and
reports the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_path, written

#: Bytes of records after which a new archive is begun; bounds what one reading task gets.
ROLL = 32 << 20
#: Bytes that the reader asks for at once.
CHUNK = 1 << 18
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
BLANK = b"\r\n\r\n"
RECORD = "<urn:palimpsest:page:"
_LINE = re.compile(rb"([!-9;-~]+):[ \t]*(.*)")


def sha1(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC/1.0 record; a revisit, which has the HTTP header but no payload, if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = page_id if page_id is not None else f"none-{uuid.uuid4().hex}"
    head = [f"WARC/1.0\r\nWARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {RECORD}{name}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {RECORD}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    head += [
        f"WARC-Payload-Digest: sha1:{sha1(payload)}",
        f"WARC-Block-Digest: sha1:{sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}\r\n\r\n",
    ]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def gzipped(data: bytes, level: int = 1) -> bytes:
    """A gzip member of its own."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Damaged(ValueError):
    """What a check found."""


def _headers(lines: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines.split(b"\r\n")[1:]:
        m = _LINE.fullmatch(line)
        if not m:
            raise Damaged("header line")
        out.setdefault(m[1].decode("ascii").lower(), m[2].decode("utf-8", "replace").strip())
    return out


class Source:
    """Bytes of a file at any place, read a chunk at a time."""

    def __init__(self, read_at: Callable[[int, int], bytes], size: int):
        self._read, self.size = read_at, size
        self._at, self._chunk = -1, b""

    def get(self, start: int, n: int) -> bytes:
        n = min(n, self.size - start)
        if n <= 0:
            return b""
        if not self._at <= start or start + n > self._at + len(self._chunk) or self._at < 0:
            self._at, self._chunk = start, self._read(start, max(n, min(CHUNK, self.size - start)))
        k = start - self._at
        return self._chunk[k : k + n]

    def find(self, what: bytes, start: int) -> int:
        """Where ``what`` is next, from ``start`` on; the size if nowhere."""
        ask = 4096  # small at first, so that marks close together are found in what is read already
        while start < self.size:
            chunk = self.get(start, ask)
            ask = min(2 * ask, CHUNK)
            if (k := chunk.find(what)) >= 0:
                return start + k
            start += max(1, len(chunk) - len(what) + 1) if start + len(chunk) < self.size else len(chunk)
        return self.size


class Ahead:
    """Where a mark is next, looked up once while reading goes forward: however many places ask, the bytes are searched once."""

    def __init__(self, find: Callable[[bytes, int], int]):
        self._find, self._known = find, {}

    def next(self, mark: bytes, start: int) -> int:
        since, at = self._known.get(mark, (0, -1))
        if not since <= start <= at:
            at = self._find(mark, start)
            self._known[mark] = start, at
        return at


def _parse(get: Callable[[int, int], bytes], ahead: Ahead, start: int, size: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record that begins at ``start``; every check must pass. Headers may be of any length."""
    if get(start, len(VERSION)) != VERSION:
        raise Damaged("no version line")
    k = ahead.next(BLANK, start) - start
    if start + k >= size:
        raise Damaged("header has no end")
    head = get(start, k)
    headers = _headers(head[:k])
    if not headers.get("content-length", "").isdigit() or "warc-type" not in headers:
        raise Damaged("header fields")
    length, begin = int(headers["content-length"]), start + k + 4
    if begin + length + 4 > size:
        raise Damaged("cut short")
    block = get(begin, length)
    if get(begin + length, 4) != b"\r\n\r\n":
        raise Damaged("record has no end mark")
    said = headers.get("warc-block-digest", "")
    if said.startswith("sha1:") and said[5:] != sha1(block):
        raise Damaged("block digest")
    if headers["warc-type"] == "response" and headers.get("content-type", "").startswith("application/http"):
        said = headers.get("warc-payload-digest", "")
        if said.startswith("sha1:") and said[5:] != sha1(block.partition(b"\r\n\r\n")[2]):
            raise Damaged("payload digest")
    return headers, block, begin + length + 4


def _member(source: Source, start: int) -> tuple[bytes, int, str]:
    """The data and the end of the gzip member that begins at ``start``; of a damaged one what could be read, and the reason."""
    z, out, at, ask = zlib.decompressobj(31), [], start, 4096
    try:
        while not z.eof:
            chunk = source.get(at, ask)
            ask = min(2 * ask, CHUNK)
            if not chunk:
                return b"".join(out), at, "member cut short"
            out.append(z.decompress(chunk))
            at += len(chunk)
            if len(out) == 1 and out[0] and not VERSION.startswith(out[0][:7]) and out[0][:7] != VERSION:
                return b"", at, "member is no record"
    except zlib.error as e:
        return b"".join(out), at, f"gzip: {str(e)[:60]}"
    return b"".join(out), at - len(z.unused_data), ""


def _inside(data: bytes) -> tuple[list[tuple[dict[str, str], bytes]], str]:
    """The valid records of a member's data, and the reason of the first gap between them."""
    found, reason, k = [], "", 0
    ahead = Ahead(lambda mark, start: at if (at := data.find(mark, start)) >= 0 else len(data))
    while 0 <= k < len(data):
        try:
            headers, block, k = _parse(lambda s, n: data[s : s + n], ahead, k, len(data))
            found.append((headers, block))
        except Damaged as e:
            reason = reason or str(e)
            k = data.find(VERSION, k + 1)
    return found, reason


def salvage(source: Source) -> Iterator[tuple]:
    """('record', start, end, headers, block) and ('gap', start, end, reason), in order; they cover the file.

    Records that are valid within a damaged member are recovered too: they come before the member's gap, with no length.
    """
    at = 0
    bad: list = []  # start and reason of the gap that is open
    ahead = Ahead(source.find)
    while at < source.size:
        found, reason, end = [], "", at
        if source.get(at, 3) == GZIP:
            data, end, reason = _member(source, at)
            found, inner = _inside(data)
            reason = reason or inner
        else:
            try:
                headers, block, end = _parse(source.get, ahead, at, source.size)
                found = [(headers, block)]
            except Damaged as e:
                reason = str(e)
        if bad and (found or not reason):
            yield ("gap", bad[0], at, bad[1])
            bad = []
        for headers, block in found:
            yield ("record", at, at if reason else end, headers, block)
        if not reason:
            at = end
            continue
        bad = bad or [at, reason]
        at = min(ahead.next(mark, at + 1) for mark in (GZIP, VERSION))
    if bad:
        yield ("gap", bad[0], source.size, bad[1])


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def revisits(pages: DataFrame, id_col: str, html_col: str, min_bytes: int = 0) -> DataFrame:
    """The digests of payloads that more than one page has, with the smallest id: a row each, written out.

    Counted with partial aggregates, so a payload that a third of all pages share is no large group.
    """
    html = F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary")
    rows = pages.where(pages[id_col].isNotNull() & (F.length(html) >= min_bytes))
    groups = rows.groupBy(F.sha2(html, 256).alias("_sha")).agg(F.min(id_col).alias("_first"), F.max(id_col).alias("_last"))
    return written(groups.where("_first <> _last").select("_sha", "_first"), "payloads")


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, compress: bool = True
) -> DataFrame:
    """Write a record per page into archives under ``folder``; returns the list of archives: path, records, bytes.

    Of the pages with equal payloads of at least ``min_bytes`` bytes, that with the smallest id is the response;
    the others revisit it. Null html: empty payload. Null id: always a response. Repeated rows: a record each. Empty table: no
    archives. A payload is held whole while its record is written.
    A task writes under a name of its own and moves the file when it is whole; a file of a task that was
    lost is not in the list, so it is never read. Other columns are not read.
    """
    html = F.coalesce(pages[html_col].cast("string"), F.lit(""))
    owners = revisits(pages, id_col, html_col, min_bytes)
    rows = pages.select(pages[id_col].cast("bigint").alias("_id"), pages[url_col].cast("string").alias("_url"), html.alias("_html"))
    rows = rows.withColumn("_sha", F.when(F.octet_length("_html") >= min_bytes, F.sha2(F.col("_html").cast("binary"), 256)))
    refers = F.when(F.col("_first") != F.col("_id"), F.col("_first"))
    rows = rows.join(owners, "_sha", "left").select("_id", "_url", "_html", refers.cast("bigint").alias("_refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        k, out, n, size = 0, None, 0, 0
        suffix = "warc.gz" if compress else "warc"

        def closed() -> pa.RecordBatch:
            out.close()
            fs.move(f"{root}/.{name}-{k}.{suffix}", f"{root}/{name}-{k}.{suffix}")
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}-{k}.{suffix}"], "records": [n], "bytes": [size]})

        for batch in batches:
            for i, u, h, r in zip(*(c for c in batch.columns), strict=True):
                if out is None:
                    out = fs.open_output_stream(f"{root}/.{name}-{k}.{suffix}", compression=None)
                data = record(i.as_py(), u.as_py(), h.as_buffer().to_pybytes() if h.is_valid else b"", r.as_py())
                data = gzipped(data) if compress else data
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= ROLL:
                    yield closed()
                    k, out, n, size = k + 1, None, 0, 0
        if out is not None:
            yield closed()

    return written(rows.mapInArrow(run, "path string, records bigint, bytes bigint"), "archives")


def read_archives(archives: DataFrame, payload: bool = False) -> DataFrame:
    """Read archives (a column ``path``) through the salvage reader: a row per record or quarantined gap.

    kind ('record' or 'gap'), path, start, end, reason, record_type, page_id, url, payload_bytes,
    payload_digest, refers_to, payload (null unless asked for, and for revisits). Null paths are left out. Empty table: no rows.
    """
    schema = (
        "kind string, path string, start bigint, end bigint, reason string, record_type string, page_id bigint, url string, "
        "payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
    )
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[x.split()[1]]) for n, x in zip(names, schema.split(", "), strict=True)])

    def page(uri: str | None) -> int | None:
        text = (uri or "").removeprefix(RECORD).removesuffix(">")
        return int(text) if re.fullmatch(r"-?\d+", text) else None

    def one(path: str) -> Iterator[list]:
        fs, local = _filesystem(path)
        with fs.open_input_file(local) as f:
            source = Source(lambda start, n: f.read_at(n, start), f.size())
            for what, start, end, *rest in salvage(source):
                if what == "gap":
                    yield ["gap", path, start, end, rest[0], *[None] * 7]
                    continue
                headers, block = rest
                http, _, body = block.partition(b"\r\n\r\n")
                length = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
                response = headers["warc-type"] == "response"
                yield [
                    "record", path, start, end, None, headers["warc-type"], page(headers.get("warc-record-id")), headers.get("warc-target-uri"),
                    len(body) if response else int(length[1]) if length else None,
                    headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                    page(headers.get("warc-refers-to")), body if payload and response else None,
                ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for row in one(path):
                    rows.append(row)
                    size += len(row[-1] or b"") + 200
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kinds)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kinds)

    paths = archives.where("path IS NOT NULL").select("path")
    parts = max(1, min(paths.count(), 4 * paths.sparkSession.sparkContext.defaultParallelism * 64))
    return paths.repartition(parts).mapInArrow(run, schema)


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Write the pages into archives in the shared folder and read the archives back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, **columns))
