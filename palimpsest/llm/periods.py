"""Periodic runs: stretches of a text's words that repeat with a period, found by counting the matches of each lag.

A run with period q has at least ``need(q)`` consecutive places whose word stands again q words later. So only lags
with as many matches can have runs. Matches are counted for all lags at once: words that occur often in their text (heavy) by
an exact autocorrelation with the fast Fourier transform, others (light) by the differences of their places. Lags with
enough matches are scanned for islands of consecutive matches. A run found at a lag explains its matches at the multiples
of that lag; what it explains is taken off their counts, so that a text of one word needs one scan, not one for each lag.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblocks import slices

#: A run has at least so many words, and at least so many periods.
WORDS, PERIODS = 6, 4
#: A word is heavy if its pairs of places outnumber so many steps for each place and level of the transform.
HEAVY = 2
#: Pairs of places that are compared at once, beside those of one place.
PAIRS = 1 << 20
#: Places that an island of the least length has at least in a scan's first look.
PROBES = 8


def need(lag: int) -> int:
    """Consecutive matches of the shortest run with this period."""
    return max(WORDS, PERIODS * lag) - lag


def lag_matches(codes: np.ndarray) -> np.ndarray:
    """m[q]: places i with codes[i] == codes[i + q], for the lags up to a run's longest period; m[0] is 0.

    Sums of the transform are rounded to whole numbers: they are at most the number of words, so doubles are exact enough for
    texts of far over 10^9 words.
    """
    n = len(codes)
    most = n // PERIODS
    order = np.argsort(codes, kind="stable")
    counts = np.bincount(codes)
    size = 1 << (n + most).bit_length()
    heavy = counts.astype(np.int64) ** 2 > HEAVY * size * size.bit_length()
    out = np.zeros(most + 1, dtype=np.int64)
    for c in np.flatnonzero(heavy).tolist():
        seen = np.fft.rfft((codes == c).astype(np.float64), size)
        out += np.rint(np.fft.irfft(seen * seen.conj(), size)[: most + 1]).astype(np.int64)
    order = order[~heavy[codes[order]]]
    # By word, then place: those of the same word up to the longest lag ahead follow one another.
    keys = codes[order] * (2 * n) + order
    ahead = np.searchsorted(keys, keys + most, side="right") - np.arange(len(keys)) - 1
    sums = np.cumsum(ahead)
    start = 0
    while start < len(keys):
        done = sums[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sums, done + PAIRS, side="right")))
        own = ahead[start:end]
        left = np.repeat(np.arange(start, end), own)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(own) - own, own)
        out += np.bincount(order[right] - order[left], minlength=most + 1)
        start = end
    out[0] = 0
    return out


def islands(match: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First places and ends of the stretches of at least so many true values."""
    edge = np.diff(np.concatenate([[0], match.astype(np.int8), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - first >= least
    return first[long], end[long]


def scan(codes: np.ndarray, lag: int) -> list[tuple[int, int]]:
    """The longest stretches (start, end) in which words this lag apart are the same, of a run's length at least.

    An island has every PROBES-th part of its least length at a probed place, so only around probes that match one after
    another all places are compared.
    """
    n, least = len(codes) - lag, need(lag)
    step = max(1, least // PROBES)
    at = np.arange(0, n, step)
    first, end = islands(codes[at] == codes[at + lag], least // step)
    out = []
    for a, b in zip(first.tolist(), end.tolist(), strict=True):
        begin, stop = max(0, (a - 1) * step + 1), min(n, b * step)
        for s, e in zip(*islands(codes[begin:stop] == codes[begin + lag : stop + lag], least), strict=True):
            out.append((begin + int(s), begin + int(e) + lag))
    return out


def runs(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs as (start, length, smallest period), by start, then period."""
    if len(codes) < WORDS:
        return []
    left = lag_matches(codes)
    lags = np.arange(len(left))
    enough = np.maximum(WORDS, PERIODS * lags) - lags
    found: dict[tuple[int, int], int] = {}
    for q in np.flatnonzero(left >= enough).tolist():
        if left[q] < enough[q]:  # by now explained
            continue
        for s, e in scan(codes, q):
            if (s, e) not in found:  # else it is a multiple of its smallest period
                found[s, e] = q
                own = lags[2 * q : e - s : q]
                left[own] -= e - s - own
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(n: int, key: int) -> np.ndarray | None:
    """Which word stands at each of n places, if a text with this checksum of its id gets a periodic tail."""
    g = key // 10
    if key % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


@dataclass
class Found:
    """A text's runs and its words without the repetitions."""

    runs: list[tuple[int, int, int]]
    kept: bytes


def collapse(text: bytes, key: int | None) -> Found:
    """Runs of one text, and the words left when of each run only the first period stays."""
    words = text.split()  # of bytes: at spaces and U+0009 to U+000D only
    place = planted(len(words), key) if key is not None else None
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    codes = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    if place is not None:
        codes, words = codes[place], [words[k] for k in place.tolist()]
    own = runs(codes)
    if own:
        gone = np.zeros(len(words) + 1, dtype=np.int64)
        for s, length, q in own:
            gone[s + q] += 1
            gone[s + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
    return Found(own, b" ".join(words))


def periodic_runs(docs: DataFrame, plant: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_runs, start, length, period, exponent_milli, runs, collapsed. No shuffle.

    Words are what spaces and U+0009 to U+000D part. ``runs`` is array<struct<start,length,period>> by start, then
    period; start to exponent_milli are those of the longest (ties: first), null without one; ``collapsed`` has the words that
    no run has after its first period, joined by one space. ``plant`` gives every tenth document, by the checksum of its id, a
    periodic tail first; ids are then whole numbers.
    Null or empty text: no words, no runs. Null id: an id like any other, nothing is planted. A very long text is held by one
    task, whose work is about n log n for n words, and n^1.5 for many heavy words. Repeated rows: a row each. Empty table: no rows.
    Other columns are not read.
    """
    src = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"))
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                ids = batch.column(0).slice(a, b - a)
                keys = [zlib.crc32(str(i).encode()) if plant and i is not None else None for i in ids.to_pylist()]
                texts = batch.column(1).slice(a, b - a).cast(pa.binary() if pa.types.is_string(batch.column(1).type) else pa.large_binary())
                found = [collapse(t or b"", k) for t, k in zip(texts.to_pylist(), keys, strict=True)]
                lists = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in f.runs] for f in found], pa.list_(item))
                yield pa.RecordBatch.from_arrays([ids, lists, pa.array([f.kept for f in found], pa.binary()).cast(pa.string())], ["_id", "runs", "collapsed"])

    kind = src.schema["_id"].dataType.simpleString()
    rows = src.mapInArrow(run, f"_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    # The longest, of these the first, of these that of the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = rows.withColumn("_best", best)
    return rows.select(
        F.col("_id").alias(id_col),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"),
        F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"),
        "runs",
        "collapsed",
    )


def rendered(name: str = "runs"):
    """Every run's start,length,period and a line feed, as one string."""
    return F.array_join(F.transform(name, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")

