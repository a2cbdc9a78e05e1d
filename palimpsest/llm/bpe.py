"""Byte-level BPE: encode whole texts to ids and decode ids to bytes.

Two-tier lookup. A minimal perfect hash over the vocabulary resolves pre-tokens that are tokens as they are,
for a whole block of new pre-tokens at once. Misses are merged with a heap over linked bytes. A worker
remembers a bounded number of pre-tokens between blocks.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblocks import BLOCK_BYTES, slices

#: Pre-tokens in a generation of what a worker remembers; bounds its memory.
REMEMBERED = 80_000
_U = np.uint64


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file: base64 and number on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)


def _hashes(blob: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each of the byte strings that lie one after another in ``blob``; none is empty."""
    starts = np.cumsum(lengths) - lengths
    inside = np.arange(len(blob)) - np.repeat(starts, lengths)
    terms = (blob.astype(np.uint64) + _U(1)) * _POWERS[inside & 4095] + (inside >> 12).astype(np.uint64)
    return _mix(np.add.reduceat(terms, starts) ^ (lengths.astype(np.uint64) << _U(48)))


class PerfectHash:
    """Minimal perfect hash by hash and displace: n keys on exactly n slots, one displacement for each bucket.

    Keys that hash into a bucket are placed together, largest buckets first, by the first displacement
    that puts them all on free slots. A lookup checks the stored key, so other strings miss.
    """

    def __init__(self, keys: list[bytes], values: list[int]):
        n = len(keys)
        lengths = np.array([len(k) for k in keys], dtype=np.int64)
        blob = np.frombuffer(b"".join(keys), dtype=np.uint8)
        self.n, self.buckets = n, max(1, n // 3)
        h = _hashes(blob, lengths)
        bucket = (h % _U(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        free = np.ones(n, dtype=bool)
        slot_of = np.empty(n, dtype=np.int64)
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        sizes = np.diff(edges)
        alone = []
        for b in np.argsort(-sizes, kind="stable"):
            own = order[edges[b] : edges[b + 1]]
            if not len(own):
                break
            if len(own) == 1:
                alone.append((b, own[0]))
                continue
            d, tries = 0, 64
            while True:  # displacements are tried a block at a time
                ds = np.arange(d, d + tries)
                at = self._slot(h[own][None, :], ds[:, None])
                fits = free[at].all(1)
                if fits.any():
                    for k in np.flatnonzero(fits):
                        if len(set(at[k].tolist())) == len(own):
                            break
                    else:
                        d += tries
                        continue
                    self.shift[b], slot_of[own] = ds[k], at[k]
                    free[at[k]] = False
                    break
                d += tries
                if d > 1 << 22:
                    raise ValueError("two keys are equal")
        # Buckets of one key take the free slots that are left, named directly.
        for (b, key), slot in zip(alone, np.flatnonzero(free), strict=True):
            self.shift[b], slot_of[key] = -1 - slot, slot
        by_slot = np.empty(n, dtype=np.int64)
        by_slot[slot_of] = np.arange(n)
        self.values = np.array(values, dtype=np.int64)[by_slot]
        self.lengths = lengths[by_slot]
        self.starts = (np.cumsum(lengths) - lengths)[by_slot]
        self.blob = blob

    def _slot(self, h: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (_mix(h + shift.astype(np.uint64) * _U(0x9E3779B97F4A7C15)) % _U(self.n)).astype(np.int64)

    def lookup(self, keys: list[bytes]) -> np.ndarray:
        """The value of each key, or -1."""
        if not keys:
            return np.empty(0, dtype=np.int64)
        lengths = np.array([len(k) for k in keys], dtype=np.int64)
        blob = np.frombuffer(b"".join(keys), dtype=np.uint8)
        h = _hashes(blob, lengths)
        shift = self.shift[(h % _U(self.buckets)).astype(np.int64)]
        slot = np.where(shift < 0, -1 - shift, self._slot(h, np.maximum(shift, 0)))
        same = self.lengths[slot] == lengths
        out = np.full(len(keys), -1, dtype=np.int64)
        if same.any():
            n = lengths[same]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            mine = blob[np.repeat((np.cumsum(lengths) - lengths)[same], n) + inner]
            theirs = self.blob[np.repeat(self.starts[slot[same]], n) + inner]
            equal = np.add.reduceat(mine != theirs, np.cumsum(n) - n) == 0
            out[np.flatnonzero(same)[equal]] = self.values[slot[same][equal]]
        return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: the neighbours of lowest rank, leftmost first, merge until none is in the vocabulary."""
    n = len(piece)
    after, before, width = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i]
        if not width[i] or j >= n or width[i] + width[j] != size:
            continue  # one of the two has been merged since
        width[i], width[j] = size, 0
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(piece[i : k + width[k]])) is not None:
                heapq.heappush(heap, (r, i, size + width[k]))
        if (h := before[i]) >= 0 and (r := ranks.get(piece[h : i + size])) is not None:
            heapq.heappush(heap, (r, h, width[h] + size))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : i + width[i]]])
        i = after[i]
    return out


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as counted, one range after another."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


class Memory(dict):
    """Numbers of pre-tokens, given out as they come; their ids lie one after another in ``flat``.

    Bounded by two generations: a full memory becomes the old one of a new memory, which looks there before it asks.
    """

    def __init__(self, old: Memory | None = None) -> None:
        self.fresh: list[str] = []
        self.starts, self.counts, self.flat = array("q"), array("q"), array("I")
        self.old = old
        if old is not None:
            old.old = None

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.fresh.append(key)
        return n

    def learn(self, ask: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> None:
        """Take the ids of the new pre-tokens from the old memory, or else from ``ask``: their ids and how many each has."""
        if not self.fresh:
            return
        old = self.old
        known = np.fromiter((old.get(k, -1) for k in self.fresh), np.int64, len(self.fresh)) if old is not None else np.full(len(self.fresh), -1)
        new = np.flatnonzero(known < 0)
        flat, n = ask([self.fresh[k] for k in new.tolist()] if old is not None else self.fresh)
        counts = np.empty(len(known), dtype=np.int64)
        counts[new] = n
        place = np.flatnonzero(known >= 0)
        if len(place):
            n_old = np.array(old.counts)[known[place]]
            counts[place] = n_old
            ids = np.empty(int(counts.sum()), dtype=np.uint32)
            starts = np.cumsum(counts) - counts
            ids[_ranges(starts[new], counts[new])] = flat
            ids[_ranges(starts[place], n_old)] = np.array(old.flat, dtype=np.uint32)[_ranges(np.array(old.starts)[known[place]], n_old)]
        else:
            ids = np.asarray(flat, dtype=np.uint32)
        self.starts.frombytes((np.cumsum(counts) - counts + len(self.flat)).astype(np.int64).tobytes())
        self.counts.frombytes(counts.tobytes())
        self.flat.frombytes(ids.tobytes())
        self.fresh.clear()

    def ids(self, codes: list[np.ndarray]) -> list[np.ndarray]:
        """The ids that each array of numbers stands for, as unsigned 32-bit little-endian integers."""
        starts, counts, flat = np.array(self.starts), np.array(self.counts), np.array(self.flat, dtype="<u4")
        out = []
        for c in codes:
            out.append(flat[_ranges(starts[c], counts[c])])
        return out


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, list[str]]]:
    """Where it begins and its texts, for consecutive texts of about so many bytes together; nulls become empty."""
    for a, b in slices(column, size):
        yield a, [t or "" for t in column.slice(a, b - a).to_pylist()]


def flattened(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, one list after another, and the lists' lengths."""
    counts = np.array([len(x) for x in ids], dtype=np.int64)
    return np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum())), counts


class Encoder:
    """One worker's tables."""

    def __init__(self, ranks: dict[bytes, int], table: PerfectHash, pattern: str):
        import regex

        self.ranks, self.table, self.find = ranks, table, regex.compile(pattern).findall
        self.memory = Memory()

    def _ask(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [k.encode() for k in keys]
        ids = [[v] if v >= 0 else merge(k, self.ranks) for k, v in zip(raw, self.table.lookup(raw).tolist(), strict=True)]
        return flattened(ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.memory) > REMEMBERED:
            self.memory = Memory(self.memory)
        number = self.memory.__getitem__
        codes = [np.fromiter(map(number, self.find(t)), dtype=np.int64) for t in texts]
        self.memory.learn(self._ask)
        return self.memory.ids(codes)


def rust_spaces(pattern: str) -> str:
    r"""A pattern whose \s means White_Space exactly, without the separators U+001C to U+001F."""
    inside = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    return pattern.replace(r"[^\s", f"[^{inside}").replace(r"\S", f"[^{inside}]").replace(r"\s", f"[{inside}]")


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids (binary: little-endian unsigned 32-bit). No shuffle.

    The tables go to the workers once, by broadcast; their size is the vocabulary's. Null or empty text:
    no ids. Null ids are ids like any other. Very long texts are read one at a time. Repeated rows: a row each. Empty table: no rows.
    Other columns are not read.
    """
    spark = docs.sparkSession
    ranks = load_ranks(rank_path)
    shared = spark.sparkContext.broadcast((ranks, PerfectHash(list(ranks), list(ranks.values()))))
    src = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"))
    pat = rust_spaces(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(*shared.value, pat)
        for batch in batches:
            for at, block in blocks(batch.column(1)):
                ids = coder.encode(block)
                out = [batch.column(0).slice(at, len(block)), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())]
                yield pa.RecordBatch.from_arrays(out, ["_id", "n_tokens", "ids"])

    out = src.mapInArrow(run, f"_id {src.schema['_id'].dataType.simpleString()}, n_tokens bigint, ids binary")
    return out.withColumnRenamed("_id", id_col)


def decode(rows: DataFrame, rank_path: str, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded``: the bytes that the ids stand for. Null ids: null. Empty table: no rows. A column ``decoded`` clashes: rename it before."""
    ranks = load_ranks(rank_path)
    tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
    for k, v in ranks.items():
        tokens[v] = k
    shared = rows.sparkSession.sparkContext.broadcast(tokens)
    names = rows.columns
    at = names.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            size = max(1, BLOCK_BYTES * 4 * batch.num_rows // max(1, batch.column(at).nbytes))
            for k in range(0, batch.num_rows, size):
                part = batch.slice(k, size)
                texts = [None if x is None else b"".join(map(token, np.frombuffer(x.as_buffer(), "<u4").tolist())) for x in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], [*names, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, decoded binary")


def digest(column: str):
    """Lower-case hexadecimal SHA-256 of a binary column."""
    return F.sha2(F.col(column), 256)
