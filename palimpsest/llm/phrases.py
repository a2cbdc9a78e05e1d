"""Phrase collocations by hashing passes (PCY, and DHP beyond pairs).

Pass 1 counts words and, in hash buckets, pairs of neighbouring words. Pass k counts phrases of k words exactly, but only
those that can be frequent: both phrases of k - 1 words in it are (Apriori), and so is the bucket it falls into. Meanwhile it
counts phrases of k + 1 words in buckets, but only where both parts passed. Buckets and frequent phrases are broadcast as
bitmaps of a fixed number of bits. A bit that is set in vain costs a count, never a result: what is kept has been counted
exactly, by its words, with its language.

A task's bucket counters stop at 255; a chunk of them is a row, as a list where few are not zero, so that counters are merged
by chunk over all tasks.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, written
from .textblocks import _LOWER, Words, mix, slices

#: Bytes that end a piece, and bytes between words of a piece (fixed values).
BREAKS = np.zeros(256, dtype=bool)
BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
GAPS = BREAKS.copy()
GAPS[[0x20, 0x09]] = True
#: Buckets in a chunk of counters.
CHUNK = 1 << 16
#: Bits of a bitmap, as a power of two: least and most; between them about one for so many bytes of text.
BITS_LEAST, BITS_MOST, BYTES_A_BUCKET = 16, 27, 48
#: Phrases that a task remembers before it passes its counts on.
REMEMBERED = 400_000
#: The score's unit: 1 / SCALE of a phrase's share in the occurrences of its parts (fixed value).
SCALE = 2_000_000
UNKNOWN = "und"
PASS = "lang string, phrase string, c bigint, chunk int, counts binary"
_U = np.uint64


def salt(lang: str) -> np.uint64:
    return _U(int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little"))


def put(buckets: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Which buckets' bits are set."""
    return (marks[buckets >> 3] >> (buckets & 7).astype(np.uint8)) & 1 == 1


class Counters:
    """Bucket counters of one task, each at most 255."""

    def __init__(self, bits: int):
        self.counts = np.zeros(1 << bits, dtype=np.uint8)

    def add(self, buckets: np.ndarray, weight: int = 1) -> None:
        at, n = np.unique(buckets, return_counts=True)
        self.counts[at] = np.minimum(255, self.counts[at] + n * weight).astype(np.uint8)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """A row for each chunk with a count: all counters, or the places and counts of those that are not zero."""
        for a in range(0, len(self.counts), CHUNK * 64):
            chunks, rows = [], []
            for k in range(a, min(len(self.counts), a + CHUNK * 64), CHUNK):
                own = self.counts[k : k + CHUNK]
                some = np.flatnonzero(own)
                if len(some):
                    chunks.append(k // CHUNK)
                    rows.append(some.astype("<u2").tobytes() + own[some].tobytes() if 3 * len(some) < CHUNK else own.tobytes())
            if rows:
                yield _batch(chunk=pa.array(chunks, pa.int32()), counts=pa.array(rows, pa.binary()))


def _batch(**columns: pa.Array) -> pa.RecordBatch:
    """A batch of a pass's output; columns that are not given are null."""
    n = len(next(iter(columns.values())))
    kinds = {"lang": pa.string(), "phrase": pa.string(), "c": pa.int64(), "chunk": pa.int32(), "counts": pa.binary()}
    return pa.RecordBatch.from_arrays([columns.get(k, pa.nulls(n, t)) for k, t in kinds.items()], list(kinds))


class Block:
    """A block of texts as words: pieces, languages and the hashes of phrases."""

    def __init__(self, texts: pa.Array, langs: list[str], bits: int):
        self.words, self.langs = Words(texts, lower=True, gaps=GAPS), langs
        w, self.shift = self.words, _U(64 - bits)
        row = w.row_of_words()
        self.lang = np.array([0] * len(langs))
        self.names = sorted(set(langs))
        self.lang = np.searchsorted(np.array(self.names, dtype=object), np.array(langs, dtype=object))[row] if len(row) else row
        self.salts = np.array([salt(x) for x in self.names], dtype=np.uint64)
        self.piece = np.cumsum(BREAKS[w.data])[w.starts] + row * (len(w.data) + 1) if len(row) else row
        self.low = memoryview(_LOWER[w.data].tobytes())

    def keys(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on, with the language of the first; the last k - 1 are left out."""
        h = self.words.hashes if k == 1 else self.words.grams(k)
        return mix(h ^ self.salts[self.lang[: len(h)]]) if len(h) else h

    def buckets(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> self.shift).astype(np.int64)

    def whole(self, k: int) -> np.ndarray:
        """Whether the k words from each word on are of one piece."""
        m = max(0, len(self.piece) - k + 1)
        return self.piece[:m] == self.piece[k - 1 : k - 1 + m]

    def count(self, k: int, keys: np.ndarray, at: np.ndarray, into: defaultdict) -> None:
        """Add the phrases of k words that begin at these words to the counts by language.

        Within a block phrases are told apart by 64-bit hashes; from block to block and task to task by their words.
        """
        _, first, n = np.unique(keys[at], return_index=True, return_counts=True)
        first = at[first]
        starts, ends, low = self.words.starts, self.words.ends, self.low
        edges = [np.stack([starts[first + j], ends[first + j]], 1).tolist() for j in range(k)]
        for lang, c, *spans in zip(self.lang[first].tolist(), n.tolist(), *edges, strict=True):
            into[self.names[lang]][b" ".join([low[a:b] for a, b in spans])] += c


def _blocks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[Block]:
    for batch in batches:
        for a, b in slices(batch.column(1)):
            yield Block(batch.column(1).slice(a, b - a), batch.column(0).slice(a, b - a).to_pylist(), bits)


def _phrases(into: defaultdict) -> Iterator[pa.RecordBatch]:
    """The counts as batches; then they are forgotten."""
    for lang, own in into.items():
        items = list(own.items())
        for k in range(0, len(items), 1 << 16):
            part = items[k : k + (1 << 16)]
            words, c = pa.array([x[0] for x in part], pa.binary()).cast(pa.string()), pa.array([x[1] for x in part], pa.int64())
            yield _batch(lang=pa.array([lang] * len(part), pa.string()), phrase=words, c=c)
    into.clear()


def _pass(texts: DataFrame, k: int, bits: int, last: bool, parts: Broadcast | None, buckets: Broadcast | None) -> DataFrame:
    """Rows with lang, phrase, c: partial counts of phrases of k words; rows with chunk, counts: those of k + 1 in buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into: defaultdict[str, Counter] = defaultdict(Counter)
        following = None if last else Counters(bits)
        for block in _blocks(batches, bits):
            keys = block.keys(k)
            passed = block.whole(k)
            if k > 1:
                part = put(block.buckets(block.keys(k - 1)), parts.value)
                passed &= part[:-1] & part[1:]
                passed[passed] = put(block.buckets(keys[passed]), buckets.value)
            at = np.flatnonzero(passed)
            block.count(k, keys, at, into)
            if following is not None:
                both = block.whole(k + 1) & passed[:-1] & passed[1:]
                following.add(block.buckets(block.keys(k + 1)[both]))
            if sum(map(len, into.values())) > REMEMBERED:
                yield from _phrases(into)
        yield from _phrases(into)
        if following is not None:
            yield from following.batches()

    return texts.mapInArrow(run, PASS)


def bitmap(chunks: DataFrame, bits: int, least: int) -> np.ndarray:
    """From rows with chunk, counts: a bit for each bucket whose counters together reach ``least`` (at most 255).

    Chunks are merged one row after another in the task that has them; 2^bits / 8 bytes come to the driver.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total = own.setdefault(chunk, np.zeros(CHUNK, dtype=np.uint16))
                if len(raw) == CHUNK:
                    total += np.frombuffer(raw, np.uint8)
                else:
                    n = len(raw) // 3
                    total[np.frombuffer(raw, "<u2", n)] += np.frombuffer(raw, np.uint8, n, 2 * n)
                np.minimum(total, 255, out=total)
        kinds = pa.array([*own], pa.int32())
        yield pa.RecordBatch.from_arrays([kinds, pa.array([np.packbits(v >= least, bitorder="little").tobytes() for v in own.values()], pa.binary())], ["chunk", "marks"])

    out = np.zeros(max(CHUNK, 1 << bits) // 8, dtype=np.uint8)
    for r in chunks.select("chunk", "counts").repartition("chunk").mapInArrow(merge, "chunk int, marks binary").collect():
        out[r["chunk"] * (CHUNK // 8) : (r["chunk"] + 1) * (CHUNK // 8)] = np.frombuffer(r["marks"], np.uint8)
    return out


def _marked(frequent: DataFrame, k: int, bits: int) -> np.ndarray:
    """A bitmap of frequent phrases of k words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counters(bits)
        for block in _blocks(batches, bits):
            seen.add(block.buckets(block.keys(k)[block.words.edges[:-1]]), 255)
        yield from seen.batches()

    return bitmap(frequent.select("lang", "phrase").mapInArrow(run, PASS), bits, 1)


def frequent_phrases(docs: DataFrame, most: int, least: int, hold: Scratch, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, a) for all phrases of up to ``most`` words that occur ``least`` times (2 to 255) or more; (lang, n): all words.

    The tables lie in ``hold``. The corpus is read once for each length, and once for its size.
    """
    spark = docs.sparkSession
    src = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(BITS_MOST, max(BITS_LEAST, (size // BYTES_A_BUCKET).bit_length()))
    tables, parts, buckets = [], None, None
    for k in range(1, most + 1):
        rows = hold.put(f"pass{k}", _pass(src, k, bits, k == most, parts, buckets))
        for old in (parts, buckets):
            if old is not None:
                old.unpersist()
        counted = rows.where("phrase IS NOT NULL").groupBy("lang", "phrase").agg(F.sum("c").alias("a"))
        tables.append(hold.put(f"frequent{k}", counted.where(F.col("a") >= least).select("lang", "phrase", F.lit(k).alias("size"), "a")))
        if k == 1:
            totals = hold.put("totals", rows.where("phrase IS NOT NULL").groupBy("lang").agg(F.sum("c").alias("n")))
        if k < most:
            parts = spark.sparkContext.broadcast(_marked(tables[-1], k, bits))
            buckets = spark.sparkContext.broadcast(bitmap(rows.where("chunk IS NOT NULL"), bits, least))
        hold.drop(f"pass{k}")
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out, totals


def _slice(words: Column, start: int, size) -> Column:
    return F.array_join(F.slice(words, start + 1, size), " ")


def scored(phrases: DataFrame, most: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) for phrases of two words and more, from (lang, phrase, size, a) of all frequent ones.

    The cut with the lowest score counts, of these the first. All parts of a frequent phrase are frequent, so each is found.
    """
    words = F.split("phrase", " ")
    sides = F.array(*[
        F.when(F.col("size") > k, F.struct(F.lit(k).alias("k"), F.lit(left).alias("left"), (_slice(words, 0, k) if left else _slice(words, k, F.col("size"))).alias("part")))
        for k in range(1, most) for left in (True, False)
    ])
    rows = phrases.where("size > 1").select("lang", "phrase", "a", F.explode(F.array_compact(sides)).alias("s")).select("lang", "phrase", "a", "s.*")
    known = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    found = rows.join(known, ["lang", "part"])
    side = lambda k, left: F.max(F.when((F.col("k") == k) & (F.col("left") == left), F.col("f"))).alias(f"{'l' if left else 'r'}{k}")
    found = found.groupBy("lang", "phrase", "a").agg(*[side(k, left) for k in range(1, most) for left in (True, False)])
    wide = "CAST({} AS DECIMAL(38,0))"
    score = lambda k: F.expr(f"CAST(({SCALE} * {'CAST(a AS DECIMAL(30,0))'}) div ({wide.format(f'l{k}')} + {wide.format(f'r{k}')}) AS BIGINT)")
    cuts = F.array(*[F.when(F.col(f"l{k}").isNotNull(), F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, most)])
    return found.select("lang", "phrase", "a", F.array_min(F.array_compact(cuts)).alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")


def explained(phrases: DataFrame, most: int) -> DataFrame:
    """(lang, phrase, longer): for phrases within longer frequent ones, how often the most frequent of these occurs."""
    words = F.split("phrase", " ")
    inside = F.array(*[F.when((F.col("size") > n) & (F.col("size") >= n + at), _slice(words, at, n)) for n in range(2, most) for at in range(most - n + 1)])
    rows = phrases.where("size > 2").select("lang", F.explode(F.array_compact(inside)).alias("phrase"), "a")
    return rows.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def ranked(rows: DataFrame, top: int, hold: Scratch) -> DataFrame:
    """Each language's first rows by score and a, descending, then phrase, with ``rank`` from 1; no language is sorted in one task.

    Rows are sorted into parts; ranks in a part begin after the rows of earlier parts. Only parts that begin early enough are numbered.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = hold.put("sorted", rows.repartitionByRange(F.asc("lang"), *order).withColumn("part", F.spark_partition_id()))
    sizes = parts.groupBy("lang", "part").agg(F.count("*").alias("own"))
    before = F.coalesce(F.sum("own").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = sizes.select("lang", "part", before.alias("before")).where(F.col("before") < top)
    number = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    numbered = parts.join(first, ["lang", "part"]).withColumn("rank", (F.col("before") + number).cast("long"))
    return numbered.where(F.col("rank") <= top).drop("part", "before")


def collocations(docs: DataFrame, least: int = 30, most: int = 4, within: int = 80, top: int = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """A row per language and phrase: lang, rank, phrase, a, l, r, n, score; each language's first ``top``.

    A phrase has 2 to ``most`` words that stand one after another in a piece, in A-Z lower-cased, and occurs a >= ``least`` times; l and
    r are the occurrences of its parts at the cut with the lowest score, n those of all words of the language. Phrases within a longer
    one that occurs at least ``within`` per cent as often are left out. Null language: `und`. Null or empty text: no words. Very long
    texts are blocks of their own. Repeated rows count each. Empty table: no rows. Other columns are not read.
    """
    hold = Scratch(docs.sparkSession)
    phrases, totals = frequent_phrases(docs, most, least, hold, lang_col, text_col)
    rows = scored(phrases, most).join(explained(phrases, most), ["lang", "phrase"], "left")
    rows = rows.where(F.expr(f"longer IS NULL OR 100 * CAST(longer AS DECIMAL(30,0)) < {within} * CAST(a AS DECIMAL(30,0))")).drop("longer")
    out = written(ranked(rows, top, hold).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
    hold.drop()
    return out
