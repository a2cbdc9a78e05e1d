"""Vector best-fit packing of documents into sequences.

Pieces are tokenized on the executors. Only the histogram of piece lengths, at most one number for each
possible length, goes to the driver; there best-fit decreasing fills bins under three capacities (tokens,
documents, attention cost), equal bins at once. The plan says which ranks of which length go where, and
the executors look up each piece's place by its rank among the pieces of its length.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import Memory, blocks, flattened
from .common import written
from .wordbpe import LETTERS, WordMerger

#: Words in a generation of what a worker remembers; two generations take about 150 bytes a word.
REMEMBERED = 400_000
#: Words tokenized in one call; bounds the library's own objects.
FRESH = 8192
#: Separators that Python takes for white space and the tokenizer does not.
_ODD = re.compile("[\x1c-\x1f]")
#: Characters that normalization or lower-casing could treat by their neighbours.
_WIDE = re.compile("[^\x00-\u02ff]")
_coders: dict[str, WordCoder] = {}


def _words(text: str) -> list[str]:
    """Split at white space, as the tokenizer does."""
    return text.split() if not _ODD.search(text) else re.split("[\t\n\r ]+", text)


class Numbers(dict):
    """Numbers keys as they come."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class WordCoder:
    """One worker's tokenizer and what it remembers; kept from task to task."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.coder.no_padding()
        self.coder.no_truncation()
        self.memory = Memory()
        self.merger = WordMerger.load(path)

    def _library(self, words: list[str]) -> list[list[int]]:
        return [e.ids for k in range(0, len(words), FRESH) for e in self.coder.encode_batch_fast(words[k : k + FRESH], add_special_tokens=False)]

    def _ask(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids. Plain words are parted into letters and marks, and each distinct run of letters is merged once."""
        if self.merger is None:
            return flattened(self._library(words))
        split = LETTERS.fullmatch
        number, parts = Numbers(), []
        for w in words:
            m = split(w.lower()) if w.isascii() or not _WIDE.search(w) else None
            parts.append((number[m[1]], number[m[2]] if m[2] else -1) if m else (number[w], -1))
        letters = [w for w in number if w.isalpha() and LETTERS.fullmatch(w)]
        ids: list[list[int]] = [[]] * len(number)
        flat, counts = self.merger.merge(letters)
        flat = flat.tolist()
        at = 0
        for w, n in zip(letters, counts.tolist(), strict=True):
            ids[number[w]] = flat[at : at + n]
            at += n
        rest = [w for w in number if not (w.isalpha() and LETTERS.fullmatch(w))]
        for w, x in zip(rest, self._library(rest), strict=True):
            ids[number[w]] = x
        return flattened([ids[a] + ids[b] if b >= 0 else ids[a] for a, b in parts])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.memory) > REMEMBERED:
            self.memory = Memory(self.memory)
        number = self.memory.__getitem__
        codes = [np.fromiter(map(number, _words(t)), dtype=np.int64) for t in texts]
        self.memory.learn(self._ask)
        return self.memory.ids(codes)


def pieces(
    docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per piece: id, piece, start, length, ids (binary: little-endian unsigned 32-bit). No shuffle.

    A document's ids are the tokenizer's, without special tokens, then ``end_id``. Documents of more than
    ``size`` ids are cut there. Texts are split at white space and each distinct word is tokenized once,
    which gives the same ids for tokenizers that drop white space. A special token that a text spells out is
    that token, as the library has it. Null or empty text: only ``end_id`` (no piece if that is None). Null id: pieces
    like any other. Repeated rows: pieces each. Very long texts are blocks of their own. Empty table: no rows. Other
    columns are not read.
    """
    src = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"))
    last = [] if end_id is None else [end_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coders.get(tokenizer_path) or _coders.setdefault(tokenizer_path, WordCoder(tokenizer_path))
        for batch in batches:
            for at, block in blocks(batch.column(1)):
                every = coder.encode(block)
                out: list[list] = [[], [], [], [], []]
                for k, ids in enumerate(every):
                    ids = np.concatenate([ids, np.array(last, "<u4")])
                    for piece, start in enumerate(range(0, len(ids), size)):
                        part = ids[start : start + size]
                        for column, x in zip(out, (at + k, piece, start, len(part), part.tobytes()), strict=True):
                            column.append(x)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                rest = [pa.array(x, t) for x, t in zip(out[1:], kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(out[0], pa.int64())), *rest], ["_id", "piece", "start", "length", "ids"])

    kind = src.schema["_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"_id {kind}, piece int, start bigint, length bigint, ids binary")
    return out.withColumnRenamed("_id", id_col)


@dataclass(frozen=True)
class Capacity:
    """What a bin holds: tokens, documents, and attention cost (the sum of squared lengths)."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.float64)


def plan(
    histogram: dict[int, int], capacity: Capacity, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
) -> np.ndarray:
    """Best-fit decreasing over a histogram of lengths. Rows: length, first rank, items, first bin, items a bin, offset.

    Items go longest first into the bin of the smallest weighted norm of what would remain (``norm``), or
    of the smallest weighted dot product of item and residual (``dot``), among the bins that have room in
    every dimension; a new bin is opened where none has. The dot product is with what is left of a bin, not with
    what it holds, so the smallest one is the tightest fit in the dimensions that the item needs most. Both rules
    prefer the fullest bin, so a bin that takes an item takes the next equal one too. Bins with the same residual and contents are one class
    with a count, so the work depends on the number of lengths, not of pieces.
    """
    if rule not in ("norm", "dot"):
        raise ValueError("rule is norm or dot")
    full = capacity.vector()
    w = np.array(weights)
    residual = np.empty((1024, 3))
    count: list[int] = []  # bins in each class
    first: list[list[tuple[int, int]]] = []  # ranges of bins of each class: (first, number)
    used: list[int] = []  # tokens taken in each class
    rows, opened = [], 0

    def take(bins: list[tuple[int, int]], n: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        got = []
        while n:
            a, m = bins[0]
            k = min(m, n)
            got.append((a, k))
            bins = ([(a + k, m - k)] if m > k else []) + bins[1:]
            n -= k
        return got, bins

    def add(res: np.ndarray, bins: list[tuple[int, int]], tokens: int) -> None:
        nonlocal residual
        k = len(count)
        if k == len(residual):
            residual = np.vstack([residual, np.empty_like(residual)])
        residual[k] = res
        count.append(sum(m for _, m in bins))
        first.append(bins)
        used.append(tokens)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        item = np.array([length, 1, length * length], dtype=np.float64)
        if (item > full).any() or length < 0:
            raise ValueError(f"a piece of {length} tokens fits into no bin")

        def put(bins: list[tuple[int, int]], each: int, at: int, res: np.ndarray, length: int = length, item: np.ndarray = item) -> None:
            nonlocal rank, left
            for a, m in bins:
                rows.append((length, rank, m * each, a, each, at))
                rank += m * each
                left -= m * each
            add(res - each * item, bins, at + each * length)

        while left:
            live = np.array(count, dtype=np.int64)
            room = residual[: len(count)]
            ok = np.flatnonzero((room >= item).all(1) & (live > 0))
            if len(ok):
                if rule == "norm":
                    score = ((((room[ok] - item) / full) ** 2) * w).sum(1)
                else:
                    score = (room[ok] / full * (item / full) * w).sum(1)
                k = int(ok[np.argmin(score)])
                each = int((residual[k][item > 0] // item[item > 0]).min())
                whole = min(count[k], left // each)
                if whole:
                    bins, first[k] = take(first[k], whole)
                    count[k] -= whole
                    put(bins, each, used[k], residual[k].copy())
                else:
                    bins, first[k] = take(first[k], 1)
                    count[k] -= 1
                    put(bins, left, used[k], residual[k].copy())
            else:
                each = int((full[item > 0] // item[item > 0]).min())
                whole, each = (left // each, each) if left >= each else (1, left)
                put([(opened, whole)], each, 0, full.copy())
                opened += whole
    return np.array(rows, dtype=np.int64).reshape(-1, 6)


def pack(rows: DataFrame, capacity: Capacity, id_cols: list[str], length_col: str = "length", rule: str = "norm", parts: int = 0) -> DataFrame:
    """The rows with sequence_id and offset; offsets are gapless from 0 in each sequence.

    A third of all rows may have one length, and any number one id: the rows of a length are dealt evenly into
    ``parts`` (0: as many as shuffle partitions, 64 at least), which are counted first, and numbered in each by
    ``id_cols``. The rows are read twice, so they are written to the shared folder before. Lengths must lie between 0
    and the capacity. Null ids sort first. Empty table: no rows. Columns named sequence_id, offset, _len, _part or _at clash: rename them before.
    """
    spark = rows.sparkSession
    parts = parts or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = rows.columns
    rows = written(rows.withColumn("_at", F.monotonically_increasing_id()), "pieces")
    length = F.col(length_col)
    spread = F.pmod(F.xxhash64("_at"), F.lit(parts)).cast("int")
    counts = written(rows.groupBy(length.alias("_len"), spread.alias("_part")).agg(F.count("*").alias("_n")), "lengths")
    histogram = {r["_len"]: r["n"] for r in counts.groupBy("_len").agg(F.sum("_n").alias("n")).collect()}
    table = plan(histogram, capacity, rule)
    before = Window.partitionBy("_len").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_len", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_len", "_part").orderBy(*id_cols, "_at")
    ranked = (
        rows.withColumns({"_len": length, "_part": spread})
        .withColumn("_row", F.row_number().over(inside))
        .join(starts, ["_len", "_part"])
        .select(*names, (F.col("_before") + F.col("_row") - 1).alias("_rank"))
    )
    # Rows of the plan in order of (length, rank): a piece's row is the last one that begins at or before it.
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    shared = spark.sparkContext.broadcast(table)
    at = names.index(length_col)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        big = 1 << 40
        keys = t[:, 0] * big + t[:, 1]
        for batch in batches:
            n, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (at, len(names)))
            row = t[np.searchsorted(keys, n * big + rank, side="right") - 1] if len(t) else t
            inner = rank - row[:, 1]
            seq, off = row[:, 3] + inner // row[:, 4], row[:, 5] + inner % row[:, 4] * n
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(seq, pa.int64()), pa.array(off, pa.int64())], [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_at")
    return ranked.mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")
