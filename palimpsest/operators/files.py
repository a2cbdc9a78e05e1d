"""Rows as files: each row's bytes become a file of its own, all or none of a write's files appear.

A Spark data source. A task writes below a staging folder of the run and says how many files it has; only when all tasks are done does
the driver move the files to their places, names only. A task that is lost leaves files that no commit names; an aborted run takes its
staging folder away. A file that is there with the same bytes is not written again.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "palimpsest_files"
_registered: set[str] = set()


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path there; a path without a scheme is a local one that all machines share."""
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def inside(rel: str) -> bool:
    """Whether a relative path stays below its folder."""
    return bool(rel) and not rel.startswith("/") and not any(p in ("", ".", "..") for p in rel.split("/"))


def _same(fs: pafs.FileSystem, path: str, data: bytes) -> bool:
    info = fs.get_file_info(path)
    if info.type != pafs.FileType.File or info.size != len(data):
        return False
    old = hashlib.sha256()
    with fs.open_input_stream(path) as f:
        while block := f.read(1 << 20):
            old.update(block)
    return old.digest() == hashlib.sha256(data).digest()


@dataclass
class Written(WriterCommitMessage):
    """What a task has staged: its folder, files, and how many were there already."""

    staged: str
    files: int
    there: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root, self.run = root, f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = filesystem(self.root)
        own = f"{root}/{self.run}/{uuid.uuid4().hex}"  # of this attempt
        files = there = 0
        for batch in iterator:
            for rel, data in zip(batch.column("rel").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if rel is None or not inside(rel):
                    raise ValueError(f"not a relative path: {rel!r}")
                data = data or b""
                if _same(fs, f"{root}/{rel}", data):
                    there += 1
                    continue
                fs.create_dir(os.path.dirname(f"{own}/{rel}"), recursive=True)
                with fs.open_output_stream(f"{own}/{rel}") as f:
                    f.write(data)
                files += 1
        return Written(own, files, there)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = filesystem(self.root)
        made: set[str] = set()
        for m in messages:
            if m is None or not m.files:
                continue
            for info in fs.get_file_info(pafs.FileSelector(m.staged, recursive=True)):
                if info.type == pafs.FileType.File:
                    target = root + info.path.removeprefix(m.staged)
                    folder = os.path.dirname(target)
                    if folder not in made:
                        fs.create_dir(folder, recursive=True)
                        made.add(folder)
                    fs.move(info.path, target)
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        fs, root = filesystem(self.root)
        if fs.get_file_info(f"{root}/{self.run}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.run}")


class FileSink(DataSource):
    """Columns rel (string) and content (binary); the option ``path`` names the folder."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"].rstrip("/"))


def register(spark: SparkSession) -> None:
    """Make the source known to the session, once for each application."""
    if spark.sparkContext.applicationId not in _registered:
        spark.dataSource.register(FileSink)
        _registered.add(spark.sparkContext.applicationId)


def write_files(rows: DataFrame, folder: str, rel: str = "rel", content: str = "content") -> None:
    """Each row's bytes as the file ``rel`` below the folder. Paths have to be distinct and to stay below it; null content is empty.

    A file that is there with other bytes is replaced when the write commits. Moving is one call a file on the driver, without its bytes.
    """
    register(rows.sparkSession)
    rows.selectExpr(f"CAST(`{rel}` AS STRING) AS rel", f"CAST(`{content}` AS BINARY) AS content").write.format(NAME).mode("append").option("path", folder).save()
