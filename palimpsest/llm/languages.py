"""Language identification by nearest centroid: TF-IDF vectors of character n-grams, several centroids a language.

Texts become sequences of letters with one space between words; their n-grams are hashed into DIMS dimensions and weighted
by 1 + log(count) times the inverse document frequency, and the vector is made unit length. Frequencies are counted over all
documents to learn from. Each language's centroids are clusters of a bounded sample (spherical k-means), fitted in a task of
its own. A text is given the language of the centroid with the highest cosine. It is rejected if it is further from that
centroid than nearly all texts of about its length that the centroid was made from.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textblocks import mix, slices

#: Lengths of n-grams, and dimensions that they are hashed into (a power of two).
SIZES, DIMS = (1, 2, 3), 1 << 13
#: Labelled documents of a language that its centroids are fitted on, by expectation; all, if there are no more.
SAMPLE = 1024
#: Centroids of a language at most, and rounds of clustering at most.
CLUSTERS, ROUNDS = 4, 12
#: Share of the sample that lies beyond the distance from which on texts are rejected.
TAIL = 0.005
#: Bands of text lengths: band b holds texts of 2^b to 2^(b+1) - 1 n-grams; the last one all longer ones.
BANDS = 24
#: Largest model that is sent to the workers.
MODEL_BYTES = 1 << 28
#: Rows of a block: a dense matrix of them has to fit.
ROWS = 256
UNKNOWN = "und"
_U = np.uint64


@cache
def letter_table() -> np.ndarray:
    """By code point: 2 for letters, 1 for marks (which belong to a word), else 0."""
    first = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    return np.array([2 if x == "L" else x == "M" for x in first], dtype=np.uint8)


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the hashed n-grams (a row per text), and whether each text has a letter. All of a text is read."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t) for t in low])
    row = np.repeat(np.arange(len(low)), sizes)
    kind = letter_table()[points]
    has = np.bincount(row[kind == 2], minlength=len(low)) > 0
    word = kind > 0
    # Runs of other characters become one space; a text begins with a space and ends with one.
    keep = word.copy()
    keep[1:] |= word[:-1] & (row[1:] == row[:-1])
    some = np.flatnonzero(keep)
    starts = np.concatenate([[0], np.cumsum(np.bincount(row[some], minlength=len(low)) + 2)])
    out = np.full(starts[-1], 0x20, dtype=np.uint64)
    owner = np.repeat(np.arange(len(low)), np.diff(starts))
    place = np.arange(len(some)) + 2 * row[some] + 1
    out[place] = np.where(word[some], points[some], 0x20)
    # The space before a text's end may be doubled.
    double = np.zeros(len(out), dtype=bool)
    double[1:] = (out[1:] == 0x20) & (out[:-1] == 0x20) & (owner[1:] == owner[:-1])
    out, owner = out[~double], owner[~double]
    counts = np.zeros(len(low) * DIMS, dtype=np.float64)
    shift = _U(64 - (DIMS.bit_length() - 1))
    for n in SIZES:
        if len(out) < n:
            continue
        key = np.full(len(out) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            key = (key ^ out[k : len(out) - n + 1 + k]) * _U(0x9E3779B97F4A7C15)
            key ^= key >> _U(29)
        whole = owner[: len(key)] == owner[n - 1 :]
        if n == 1:
            whole &= out != 0x20
        cell = owner[: len(key)] * DIMS + (mix(key) >> shift).astype(np.int64)
        counts += np.bincount(cell[whole], minlength=len(counts))
    counts = counts.reshape(len(low), DIMS)
    counts[~has] = 0
    return counts, has


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors; zero where nothing is known."""
    x = np.zeros(counts.shape)
    np.log(counts, out=x, where=counts > 0)
    x = (x + (counts > 0)) * idf
    size = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, size, out=x, where=size > 0)


def bands(counts: np.ndarray) -> np.ndarray:
    return np.minimum(BANDS - 1, np.log2(np.maximum(1, counts.sum(1))).astype(np.int64))


def _blocks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    for a, b in slices(column):
        for k in range(a, b, ROWS):
            yield k, [t or "" for t in column.slice(k, min(ROWS, b - k)).to_pylist()]


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """From all rows of one column of texts: in how many each dimension occurs; last of all, how many texts have a letter.

    A task gives one row for each dimension it has seen; what comes to the driver has DIMS + 1 rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMS + 1, dtype=np.int64)
        for batch in batches:
            for _, block in _blocks(batch.column(0)):
                counts, has = gram_counts(block)
                total[:DIMS] += (counts > 0).sum(0)
                total[DIMS] += has.sum()
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["dim", "c"])

    out = np.zeros(DIMS + 1, dtype=np.int64)
    for r in texts.mapInArrow(run, "dim int, c bigint").groupBy("dim").agg(F.sum("c").alias("c")).collect():
        out[r["dim"]] = r["c"]
    return out


def clustered(x: np.ndarray, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit vectors: spherical k-means from seeds far from each other. Always gives the same."""
    centre = x.mean(0)
    seeds = [int(np.argmax(x @ centre))]
    while len(seeds) < min(clusters, len(x)):
        near = (x @ x[seeds].T).max(1)
        # Of the half that is furthest from all seeds the most central one, so that odd texts make no seeds.
        far = np.flatnonzero(near <= np.median(near))
        seeds.append(int(far[np.argmax(x[far] @ centre)]))
        if len(set(seeds)) < len(seeds):
            seeds.pop()
            break
    c = x[seeds]
    before = None
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        if before is not None and (own == before).all():
            break
        before = own
        c = np.stack([x[own == k].sum(0) for k in range(len(c)) if (own == k).any()])
        c /= np.sqrt((c * c).sum(1, keepdims=True))
        if len(c) <= own.max():
            before = None
    return c


def _limits(similar: np.ndarray, band: np.ndarray, tail: float) -> np.ndarray:
    """The cosine below which a text of each band is rejected.

    A band with little of a sample has that of the next shorter band; those below all samples have less, by the root of the length.
    """
    out, last, first = np.zeros(BANDS), 0.0, None
    for b in range(BANDS):
        own = similar[band == b]
        if len(own) >= 8:
            last = float(np.quantile(own, tail)) * 0.9
            first = b if first is None else first
        out[b] = last
    if first is not None:
        out[:first] = out[first] * 2.0 ** (-0.5 * (first - np.arange(first)))
    return out


@dataclass
class Model:
    """labels: of each centroid; centroids: unit rows; limits: a row of bands for each centroid; idf: by dimension."""

    labels: list[str]
    centroids: np.ndarray
    limits: np.ndarray
    idf: np.ndarray


def train(rows: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS, tail: float = TAIL, text_col: str = "text", lang_col: str = "lang", key: Column | None = None) -> Model:
    """A model from labelled rows; those without a text, a letter or a label teach nothing.

    Document frequencies come from all rows. Centroids come from about ``sample`` rows of each language, drawn by ``key`` (a
    long that is spread evenly; the text's hash where none is given): a row has the same chance in its language, and a language
    with no more rows gives all. A language's sample is fitted in one task; the model has ``clusters`` rows a language.
    """
    key = key if key is not None else F.xxhash64(rows[text_col])
    src = rows.select(rows[text_col].cast("string").alias("text"), rows[lang_col].cast("string").alias("lang"), key.cast("long").alias("key"))
    src = src.where("text IS NOT NULL AND lang IS NOT NULL")
    found = document_frequencies(src.select("text"))
    idf = np.log((1.0 + found[DIMS]) / (1.0 + found[:DIMS])) + 1.0
    each = src.groupBy("lang").agg(F.count("*").alias("n")).select(F.col("lang").alias("_lang"), "n")
    if each.count() * clusters * DIMS * 8 > MODEL_BYTES:
        raise ValueError(f"a model of so many labels has more than {MODEL_BYTES} bytes: use fewer clusters")
    # So the counts have few rows. A join without the hint would first deal whole texts out by language.
    part = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 32)) / F.lit(float(1 << 32))
    drawn = src.join(F.broadcast(each), src["lang"] == each["_lang"]).where(part < F.lit(float(sample)) / F.col("n")).select("lang", "text", "key")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block in _blocks(batch.column(1)):
                counts, has = gram_counts(block)
                x, band = weighted(counts, idf).astype(np.float32), bands(counts)
                keep = np.flatnonzero(has)
                dims = [np.flatnonzero(x[k]) for k in keep]
                cols = [batch.column(0).slice(at, len(block)).take(pa.array(keep)), batch.column(2).slice(at, len(block)).take(pa.array(keep))]
                cols += [pa.array(band[keep], pa.int32()), pa.array(dims, pa.list_(pa.int32())), pa.array([x[k][d] for k, d in zip(keep, dims, strict=True)], pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(cols, ["lang", "key", "band", "dims", "x"])

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by([("key", "ascending"), ("band", "ascending")])
        x = np.zeros((group.num_rows, DIMS))
        for k, (d, v) in enumerate(zip(group.column("dims").to_pylist(), group.column("x").to_pylist(), strict=True)):
            x[k, d] = v
        c = clustered(x, clusters)
        own, band = x @ c.T, group.column("band").to_numpy()
        near = np.argmax(own, 1)
        limits = [_limits(own[near == k, k], band[near == k], tail) for k in range(len(c))]
        cols = [[group.column("lang")[0].as_py()] * len(c), list(range(len(c))), [r.astype("<f8").tobytes() for r in c], [r.tolist() for r in limits]]
        return pa.table(cols, schema=pa.schema([("lang", pa.string()), ("k", pa.int32()), ("centroid", pa.binary()), ("limits", pa.list_(pa.float64()))]))

    points = drawn.mapInArrow(vectors, "lang string, key bigint, band int, dims array<int>, x array<float>")
    fitted = points.groupBy("lang").applyInArrow(fit, "lang string, k int, centroid binary, limits array<double>")
    got = sorted(fitted.collect(), key=lambda r: (r["lang"], r["k"]))
    centroids = np.stack([np.frombuffer(r["centroid"], "<f8") for r in got]) if got else np.empty((0, DIMS))
    return Model([r["lang"] for r in got], centroids, np.array([r["limits"] for r in got]).reshape(len(got), BANDS), idf)


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and lang_pred, score, rejected for each row. No shuffle; only the text decides.

    ``score`` is the cosine with the nearest centroid, rounded to six places, 0 to 1. ``rejected``: the text is too far from
    that centroid for its length. Null text, text without a letter, or an empty model: `und`, 0, rejected. Whole texts are read,
    however long: a row's vector has DIMS numbers. Repeated rows: a row each. Empty table: no rows. Other columns are not read.
    """
    keep = keep or []
    src = docs.select(*[docs[c].alias(f"_k{i}") for i, c in enumerate(keep)], docs[text_col].cast("string").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [*src.columns[:-1], "lang_pred", "score", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at, block in _blocks(batch.column(len(keep))):
                counts, has = gram_counts(block)
                if not m.labels:
                    has[:] = False
                best, score, far = np.zeros(len(block), np.int64), np.zeros(len(block)), np.ones(len(block), bool)
                if has.any():
                    similar = weighted(counts[has], m.idf) @ m.centroids.T
                    best[has] = np.argmax(np.round(similar, 9), 1)
                    score[has] = np.clip(np.round(similar.max(1), 6), 0, 1)
                    far[has] = score[has] < m.limits[best[has], bands(counts[has])]
                label = [m.labels[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), has.tolist(), strict=True)]
                own = [batch.column(i).slice(at, len(block)) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(label, pa.string()), pa.array(score), pa.array(far)], names)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
    out = src.mapInArrow(run, ", ".join([*kinds, "lang_pred string, score double, rejected boolean"]))
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *names[len(keep) :])


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: by the checksum of its id. A null id is not held out, and teaches nothing."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score, rejected; learned from the documents that are not held out."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    model = train(rows.where(~held_out() & F.col("doc_id").isNotNull()), key=F.xxhash64("doc_id"))
    out = predict(rows.withColumn("held_out", held_out()), model, ["doc_id", "held_out"])
    return out.withColumnRenamed("doc_id", id_col)
