"""Streams of length-prefixed objects: a line with id, kind and size, then so many bytes and a line feed, again and again.

Read in two passes. The first one goes from head to head in each file and gives an index, without contents. The second one deals out
ranges of the index by bytes, and reads each range where it lies, so that one large file is read by many tasks and no task has more
than a range. An object of more than PIECE bytes is given in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.files import filesystem
from palimpsest.operators.shared import cut

#: Bytes of contents in a range, and in a piece of one object.
RANGE, PIECE = 32 << 20, 16 << 20
#: Bytes that are asked for at once while looking for the end of a head.
HEAD = 4096
INDEX = "path string, n bigint, id string, kind string, size bigint, start bigint, status string"


def rendered(ids: Column, kind: Column, content: Column) -> Column:
    """An object as the stream has it."""
    head = F.concat_ws(" ", ids, kind, F.octet_length(content).cast("string"))
    return F.concat(head.cast("binary"), F.unhex(F.lit("0A")), content, F.unhex(F.lit("0A")))


def object_index(files: DataFrame) -> DataFrame:
    """From a column ``path``: path, n (from 0), id, kind, size, start (of the content), status: ok, missing, ambiguous, cut_short or bad_head.

    A file is read from head to head; after a bad head, or one whose content goes over the file's end, nothing more is read of it.
    """

    def heads(path: str) -> Iterator[tuple]:
        fs, at = filesystem(path)
        with fs.open_input_file(at) as f:
            size, start, n = f.size(), 0, 0
            while start < size:
                f.seek(start)
                line, more = b"", True
                while b"\n" not in line and more:
                    more = f.read(HEAD)
                    line += more
                line, end, _ = line.partition(b"\n")
                parts = line.decode("utf-8", "replace").split(" ")
                begin = start + len(line) + 1
                if end and len(parts) == 2 and parts[1] in ("missing", "ambiguous"):
                    yield path, n, parts[0], None, None, None, parts[1]
                    start = begin
                elif end and len(parts) == 3 and parts[2].isdigit():
                    length = int(parts[2])
                    whole = begin + length < size
                    yield path, n, parts[0], parts[1], length, begin, "ok" if whole else "cut_short"
                    if not whole:
                        return
                    start = begin + length + 1
                else:
                    yield path, n, parts[0][:80], None, None, None, "bad_head"
                    return
                n += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in INDEX.split(", ")]
        rows: list[tuple] = []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in heads(path):
                    rows.append(row)
                    if len(rows) == 1 << 16:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return files.select("path").where("path IS NOT NULL").distinct().mapInArrow(run, INDEX)


def objects(files: DataFrame, wanted: DataFrame | None = None, size: int = RANGE, piece: int = PIECE) -> DataFrame:
    """path, n, id, kind, size, piece, content, task of the objects in the files that a column ``path`` names; ``wanted`` (id): only these.

    An object has a row for each ``piece`` bytes, from 0; an empty one has one row. ``task`` is the range that it was read in. Objects without
    content are in ``object_index`` only.
    """
    index = object_index(files).where("status = 'ok'")
    if wanted is not None:
        index = index.join(wanted.select("id").distinct(), "id", "left_semi")
    index = cut(index.select("path", "n", "id", "kind", "size", "start"))
    pieces = index.withColumn("piece", F.explode(F.sequence(F.lit(0), F.when(F.col("size") > 0, ((F.col("size") - 1) / piece).cast("long")).otherwise(0).cast("int"))))
    pieces = pieces.withColumn("at", F.col("start") + F.col("piece").cast("long") * piece).withColumn("length", F.least(F.lit(piece).cast("long"), F.col("size") - F.col("piece").cast("long") * piece))
    # Where a piece begins in its file tells its range: no running sum, so no file's index in one task.
    ranges = pieces.withColumn("task", F.concat_ws(":", (F.col("at") / size).cast("long"), "path"))
    kinds = "path string, n bigint, id string, kind string, size bigint, piece int, content binary, task string"
    columns = ["path", "n", "id", "kind", "size", "piece", "at", "length", "task"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, f = None, None
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in columns}
            done = 0
            while done < batch.num_rows:
                data, total, k = [], 0, done
                while k < batch.num_rows and (k == done or total < piece):
                    if cols["path"][k] != path:
                        path = cols["path"][k]
                        f = filesystem(path)[0].open_input_file(filesystem(path)[1])
                    f.seek(cols["at"][k])
                    data.append(f.read(cols["length"][k]))
                    total += cols["length"][k]
                    k += 1
                part = batch.slice(done, k - done)
                own = [part.column(c) for c in ("path", "n", "id", "kind", "size", "piece")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(data, pa.binary()), part.column("task")], [c.split()[0] for c in kinds.split(", ")])
                done = k

    return ranges.select(columns).repartition("task").sortWithinPartitions("path", "at").mapInArrow(run, kinds)


def verified(rows: DataFrame) -> DataFrame:
    """Objects in one piece with ``ok``: their bytes have the id that they go by (SHA-1 of kind, size and content)."""
    head = F.concat(F.concat_ws(" ", "kind", F.col("size").cast("string")).cast("binary"), F.unhex(F.lit("00")))
    return rows.withColumn("ok", F.sha1(F.concat(head, "content")) == F.col("id"))
