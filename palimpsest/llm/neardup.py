"""Near-duplicate documents: a multi-index Hamming join on b-bit MinHash signatures, confirmed on full shingle sets.

A signature has POSITIONS symbols of 16 bits, cut into CHUNKS chunks. By the pigeonhole principle two signatures
that differ in at most CHUNKS * (ERRORS + 1) - 1 positions have a chunk in which at most ERRORS differ. Each
chunk is indexed once for every choice of ERRORS positions left out, so all such pairs meet under a key;
pairs that are further apart may meet as well. Pairs that meet are confirmed on their full sets.

Only one document of each distinct set takes part. Keys with few documents give their pairs. Under a key
with many, pairs are not listed: a pivot is compared with all others, and the group splits. How many shingles a
similar pair has in common follows from the two sizes; a document that is not linked to the pivot has fewer in common with
the pivot than that, unless its partner is smaller than the pivot. So the pair shares shingles that the pivot lacks,
and meets again under one of them. Partners of a size with which a document may do without are met by size. After each
round rows get in ``of`` the component that all links so far give their document; pairs within one are not needed,
and no other similar pair is lost. Of a group with many documents, all but few of them in one component, the few are
listed with all. Rounds go on until no other groups are left: each takes the pivot out of its group.

Before full sets are sent to each other, listed pairs are ruled out by parities: cells of a set's hashes with an odd count, a bit each. Every
shingle that only one of two sets has turns one bit, so sets whose bits differ in more cells than a similar pair may differ in shingles are not similar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .components import connected_components
from .textblocks import Words, mix, sequence_hash, slices

#: Signature: symbols, chunks, positions left out of each chunk. Pairs at most 11 of 24 symbols apart always
#: meet; of pairs with a similarity of 0.85, about 2 in a million do not meet in any chunk.
CHUNKS, WIDTH, ERRORS = 6, 4, 1
POSITIONS = CHUNKS * WIDTH
#: Documents under a key up to which its pairs are listed: at first, and in groups that have been split, where most
#: documents are in few components and only pairs between these count.
SMALL, SPLIT = 32, 256
#: Rows of one document or pivot that its set of shingles is joined to in one task; of more, in several.
SPREAD = 256
#: Sizes of documents in a band lie within one part in so many.
BANDS = 100
#: Cells in which frequencies of shingles are counted.
COUNTERS = 1 << 21
#: Words of 64 cells in which parities of sets are kept.
PARITIES = 32
_U = np.uint64
_rng = np.random.default_rng(20240607)
_ODD = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64) * _U(2) + _U(1)
_XOR = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64)


def shingle_sets(words: Words, n: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its n-word shingles; of a shorter one its whole sequence's."""
    grams = words.grams(n)
    for k in range(words.rows):
        a, b = int(words.edges[k]), int(words.edges[k + 1])
        if b - a >= n:
            s = np.sort(grams[a : b - n + 1])
            keep = np.ones(len(s), dtype=bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            yield s[keep]
        elif b > a:
            yield np.array([sequence_hash(words.hashes[a:b], salt=n)], dtype=np.uint64)
        else:
            yield np.empty(0, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Per chunk a 64-bit number of WIDTH symbols: 16 bits of each smallest hash."""
    least = np.full(POSITIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096, None]
        np.minimum(least, ((part ^ _XOR) * _ODD).min(0), out=least)
    symbols = (mix(least) >> _U(48)).reshape(CHUNKS, WIDTH)
    return (symbols << (np.arange(WIDTH, dtype=np.uint64) * _U(16))).sum(1, dtype=np.uint64)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("bigint").alias("_id"), docs[text_col].cast("string").alias("_text"))


def profiles(docs: DataFrame, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: _id, n_shingles, p1 and p2 (fingerprint of the set), sig (array of CHUNKS longs). No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                rows = []
                for s in shingle_sets(Words(batch.column(1).slice(a, b - a), lower=True), n):
                    p1, p2 = s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)
                    rows.append((len(s), p1.astype(np.int64), p2.astype(np.int64), signature(s).astype(np.int64)))
                cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
                sigs = pa.ListArray.from_arrays(pa.array(np.arange(0, CHUNKS * len(rows) + 1, CHUNKS), pa.int32()), pa.array(np.concatenate([r[3] for r in rows]) if rows else [], pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *cols, sigs], ["_id", "n_shingles", "p1", "p2", "sig"])

    return _source(docs, id_col, text_col).mapInArrow(run, "_id bigint, n_shingles bigint, p1 bigint, p2 bigint, sig array<bigint>")


def full_sets(docs: DataFrame, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: x, n, s (its shingles' hashes, sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                sets = [s.astype(np.int64) for s in shingle_sets(Words(batch.column(1).slice(a, b - a), lower=True), n)]
                sizes = np.array([len(s) for s in sets])
                flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat, pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sizes, pa.int64()), lists], ["x", "n", "s"])

    return _source(docs, id_col, text_col).mapInArrow(run, "x bigint, n bigint, s array<bigint>")


def parities(flat: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Of each set whether an odd number of its hashes falls into a cell: PARITIES longs of 64 bits a row."""
    odd = np.empty((rows, PARITIES), dtype=np.int64)
    cells, edges = (flat.astype(np.uint64) >> _U(40)).astype(np.int64) % (PARITIES * 64), np.searchsorted(row, np.arange(rows + 1))
    for first in range(0, rows, 256):  # counts of a few sets at once
        last = min(rows, first + 256)
        part = slice(edges[first], edges[last])
        counts = np.bincount((row[part] - first) * (PARITIES * 64) + cells[part], minlength=(last - first) * PARITIES * 64)
        odd[first:last] = np.packbits((counts & 1).astype(np.uint8)).view(np.int64).reshape(last - first, PARITIES)
    return odd


def by_rarity(sets: DataFrame) -> DataFrame:
    """The sets with their shingles from rare to frequent, ``own``: how many of them, the first ones, no other set has (or
    fewer), ``often``: the mean frequency of a shingle, times 1000, and ``odd``: parities.

    Any order that all sets share is right for prefixes; a good one puts shingles first that few documents
    have. Frequencies are counted in COUNTERS cells, whatever the number of shingles, so what is broadcast is bounded.
    """
    cell = F.pmod("h", F.lit(COUNTERS)).cast("int")
    found = sets.select(F.explode("s").alias("h")).groupBy(cell.alias("cell")).agg(F.count("*").alias("c"))
    cells = np.zeros(COUNTERS, dtype=np.uint32)
    for batch in found.toArrow().to_batches():
        cells[batch.column(0).to_numpy()] = np.minimum(batch.column(1).to_numpy(), (1 << 32) - 1)
    shared = sets.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = np.asarray(lists.flatten())
            edges = np.asarray(lists.offsets).astype(np.int64)
            row = np.repeat(np.arange(len(lists)), np.diff(edges))
            count = shared.value[flat % COUNTERS].astype(np.int64)
            order = np.lexsort((flat, count, row))
            again = pa.ListArray.from_arrays(pa.array(edges - edges[0], pa.int32()), pa.array(flat[order], pa.int64()))
            often = np.add.reduceat(count, (edges - edges[0])[:-1]) * 1000 // np.diff(edges)
            own = np.add.reduceat((count == 1).astype(np.int64), (edges - edges[0])[:-1])
            bits = parities(flat, row, len(lists))
            odd = pa.ListArray.from_arrays(pa.array(np.arange(0, bits.size + 1, PARITIES), pa.int32()), pa.array(bits.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), again, pa.array(own, pa.int64()), pa.array(often, pa.int64()), odd], ["x", "n", "s", "own", "often", "odd"])

    return sets.where("n > 0").mapInArrow(run, "x bigint, n bigint, s array<bigint>, own bigint, often bigint, odd array<bigint>")


def index_keys(sig: Column) -> Column:
    """The keys of a signature: every chunk with every choice of one position left out."""
    keys = []
    for c in range(CHUNKS):
        for p in range(WIDTH):
            left = (~(0xFFFF << 16 * p)) & 0xFFFFFFFFFFFFFFFF
            left = left - (1 << 64) if left >> 63 else left
            keys.append(F.xxhash64(F.lit(c * WIDTH + p), sig[c].bitwiseAND(F.lit(left).cast("long"))))
    return F.array(*keys)


def near(percent: int, inter: Column, a: Column, b: Column) -> Column:
    """Whether the intersection is at least so many percent of the union."""
    return 100 * inter >= percent * (a + b - inter)


def _listed_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of groups (g, x, n, of) whose sizes allow the similarity and that differ in ``of``."""
    left = groups.select("g", F.col("x").alias("a"), F.col("n").alias("na"), F.col("of").alias("oa"))
    right = groups.select("g", F.col("x").alias("b"), F.col("n").alias("nb"), F.col("of").alias("ob"))
    sizes = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    return left.join(right, "g").where((F.col("a") < F.col("b")) & (F.col("oa") != F.col("ob")) & sizes).select("a", "b").distinct()


def _listed_with_few(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs as ``_listed_pairs`` gives them, of groups that also have ``main``: a component of which all pairs have at most one document."""
    few = groups.where("of <> main").select("g", F.col("x").alias("a"), F.col("n").alias("na"), F.col("of").alias("oa"))
    every = groups.select("g", F.col("x").alias("b"), F.col("n").alias("nb"), F.col("of").alias("ob"))
    sizes = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    pairs = few.join(every, "g").where((F.col("a") != F.col("b")) & (F.col("oa") != F.col("ob")) & sizes)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _with_main(groups: DataFrame, hold: Scratch) -> DataFrame:
    """Groups with the component ``main`` that has most of their rows, and ``few``: how many rows it has not."""
    own = groups.groupBy("g", "of").agg(F.count("*").alias("_n"))
    main = own.groupBy("g").agg(F.max(F.struct("_n", "of")).alias("_m"), F.sum("_n").alias("_c"))
    main = hold.put("mains", main.select("g", F.col("_m.of").alias("main"), (F.col("_c") - F.col("_m._n")).alias("few")))
    return hold.put("large groups", groups.join(main, "g"))


def _with_set(rows: DataFrame, key: str, other: str, sets: DataFrame, names: list[str], hold: Scratch) -> DataFrame:
    """Rows with size and shingles of the document in ``key``. A key of more than SPREAD rows is dealt by ``other`` over several tasks."""
    many = rows.groupBy(key).agg(F.count("*").alias("_c")).where(F.col("_c") > SPREAD)
    many = hold.put("many", many.select(F.col(key).alias("_key"), F.ceil(F.col("_c") / SPREAD).cast("int").alias("_parts")))
    sets = sets.select(F.col("x").alias(key), *[F.col(c).alias(name) for c, name in zip(("n", "s", "own"), names, strict=False)])
    if many.isEmpty():
        return rows.join(sets, key)
    parts = F.coalesce("_parts", F.lit(1))
    rows = rows.join(many, rows[key] == many["_key"], "left").withColumn("_part", F.pmod(F.xxhash64(other), parts.cast("bigint"))).drop("_key", "_parts")
    sets = sets.join(many, sets[key] == many["_key"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), (parts - 1).cast("bigint")))).drop("_key", "_parts")
    return rows.join(sets, [key, "_part"]).drop("_part")


def _not_ruled_out(pairs: DataFrame, sets: DataFrame, percent: int, hold: Scratch) -> DataFrame:
    """Pairs whose sets may be similar by their sizes and parities."""
    odd = sets.select("x", "n", F.col("odd").alias("s"), "own")
    both = _with_set(_with_set(pairs, "a", "b", odd, ["na", "oa"], hold), "b", "a", odd, ["nb", "ob"], hold)
    apart = sum((F.bit_count(F.col("oa")[k].bitwiseXOR(F.col("ob")[k])) for k in range(PARITIES)), F.lit(0))
    # The intersection has at least percent / (100 + percent) of both sizes together.
    return both.where((100 + percent) * apart.cast("long") <= (100 - percent) * (F.col("na") + F.col("nb"))).select("a", "b").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, hold: Scratch) -> DataFrame:
    pairs = hold.put("possible", _not_ruled_out(pairs, sets, percent, hold))
    both = _with_set(_with_set(pairs, "a", "b", sets, ["na", "sa"], hold), "b", "a", sets, ["nb", "sb"], hold)
    inter = F.size(F.array_intersect("sa", "sb"))
    return both.where(near(percent, inter, F.col("na"), F.col("nb"))).select("a", "b")


def _with_counts(groups: DataFrame, hold: Scratch) -> DataFrame:
    """Groups whose rows are not all alike in ``of``, with their number of rows ``c``."""
    counts = groups.groupBy("g").agg(F.count("*").alias("c"), F.min("of").alias("_least"), F.max("of").alias("_most"))
    counts = hold.put("counts", counts.where("_least < _most").select("g", "c"))
    return hold.put("groups", groups.join(counts, "g"))


def _compared(groups: DataFrame, sets: DataFrame, percent: int, hold: Scratch) -> DataFrame:
    """Rows (b, x) of each group's pivot with every other document: their sizes, what they have in common, the rest of x, whether linked.

    Shingles that no other document has are left out of the rest: no pair shares them.
    """
    # The document of the most frequent shingles: what the others are copies of, rather than one with changes of its own.
    pivots = groups.groupBy("g").agg(F.max(F.struct("k", (-F.col("x")).alias("m"))).alias("p"))
    pivots = hold.put("pivots", pivots.select("g", (-F.col("p.m")).alias("b")))
    rel = hold.put("related", groups.join(pivots, "g").where("x <> b").select("b", "x", "k").distinct())
    own = sets.join(rel.select("x").distinct(), "x", "left_semi")
    other = sets.join(pivots.select(F.col("b").alias("x")).distinct(), "x", "left_semi")
    rel = _with_set(_with_set(rel, "x", "b", own, ["n", "s", "own"], hold), "b", "x", other, ["nb", "sb"], hold)
    rel = rel.withColumns({"inter": F.size(F.array_intersect("s", "sb")).cast("long"), "rest": F.array_except("s", "sb")})
    linked = near(percent, F.col("inter"), F.col("n"), F.col("nb"))
    return hold.put("compared", rel.select("b", "x", "n", "k", "inter", F.expr("slice(rest, CAST(own AS INT) + 1, size(rest))").alias("rest"), linked.alias("linked")))


def _band(n: Column) -> Column:
    return F.floor(F.ln(n.cast("double")) * BANDS).cast("int")


def _smallest(band: Column) -> Column:
    """The smallest size in a band, or less."""
    return F.ceil(F.exp(band.cast("double") / BANDS) * (1 - 1e-12)).cast("long")


def _children(rel: DataFrame, percent: int, hold: Scratch) -> DataFrame:
    """The groups in which similar pairs of compared rows meet again, unless both are linked to the pivot."""
    bands = rel.groupBy("b").agg(F.collect_set(_band(F.col("n"))).alias("bands"))  # at most BANDS * ln(largest size)
    rel = rel.join(bands, "b").withColumn("band", _band(F.col("n")))
    fits = lambda v: (_smallest(v + 1) * 100 >= percent * F.col("n")) & (percent * _smallest(v) <= 100 * F.col("n"))
    # Shingles that the pivot lacks and that a partner of the size must share, at least: what a similar pair has in common, less what the pivot has of x.
    least = lambda v: F.ceil(F.lit(percent) * (F.col("n") + _smallest(v)) / (100 + percent) - 1e-9).cast("long") - F.col("inter")
    needs = F.transform(F.filter("bands", fits), lambda v: F.struct(v.alias("band"), least(v).alias("need")))
    rel = rel.withColumn("needs", needs).withColumn("need", F.array_min(F.transform("needs", lambda v: v["need"])))
    # Shingles from rare to frequent: two documents that must share `need` of them share one of the first size - need + 1.
    prefix = F.slice("rest", F.lit(1), F.greatest(F.size("rest") - F.greatest(F.col("need"), F.lit(1)) + 1, F.lit(0)).cast("int"))
    by_shingle = rel.select(F.explode(prefix).alias("h"), "b", "x", "n", "k", "of").select(F.xxhash64("b", "h").alias("g"), "x", "n", "k", "of")
    free = rel.where("NOT linked AND need <= 0").select("b", "x", "n", "k", "of", F.explode(F.filter("needs", lambda v: v["need"] <= 0)["band"]).alias("band"))
    free = hold.put("free", free)
    met = rel.where("need <= 0").join(free.select("b", "band").distinct(), ["b", "band"]).select("b", "x", "n", "k", "of", "band")
    by_size = free.unionByName(met).select(F.xxhash64("b", F.col("band"), F.lit("size")).alias("g"), "x", "n", "k", "of")
    return by_shingle.unionByName(by_size).distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, n: int = 5, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL, split: int = SPLIT) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable over links), kept.

    Documents are linked if 100 * |intersection| >= percent * |union| of their sets of distinct n-word shingles,
    A-Z lower-cased; a text of fewer words has its whole sequence as one. No words or null text: empty set,
    linked with nothing. Null id: component null, kept, links nothing. Rows that share an id count as
    one document with the links of all of them. Whole texts count, however long. Empty table: no rows. Other columns are not read.
    """
    hold = Scratch(docs.sparkSession)
    prof = hold.put("profiles", profiles(docs, n, id_col, text_col))
    full = prof.where("_id IS NOT NULL AND n_shingles > 0")
    classes = full.groupBy("p1", "p2", "n_shingles").agg(F.min("_id").alias("x"), F.max("_id").alias("last"), F.first("sig").alias("sig"))
    classes = hold.put("classes", classes)
    keyed = classes.select(F.explode(index_keys(F.col("sig"))).alias("g"), "x", F.col("n_shingles").alias("n"), F.col("x").alias("of"))
    # Two sets may fall to one id (rows that share it): once in a group is enough.
    groups = _with_counts(keyed.distinct(), hold)
    wanted = hold.put("wanted", groups.select(F.col("x").alias("_id")).distinct())
    texts = _source(docs, id_col, text_col).join(wanted, "_id", "left_semi")
    sets = full_sets(texts, n, "_id", "_text").where("n > 0")
    sets = hold.put("sets", by_rarity(hold.put("hashes", sets)))
    often = sets.groupBy("x").agg(F.max("often").alias("k"))
    pairs, known = [_listed_pairs(groups.where(F.col("c") <= small), percent)], None
    many = hold.put("many groups", groups.where(F.col("c") > small).drop("c").join(often, "x"))
    while not many.isEmpty():
        rel = _compared(many, sets, percent, hold)
        found = rel.where("linked").select(F.col("b").alias("a"), F.col("x").alias("b"))
        known = hold.put("known", connected_components(found if known is None else found.unionByName(known)).selectExpr("node AS a", "component AS b"))
        of = known.select(F.col("a").alias("x"), F.col("b").alias("of"))
        rel = hold.put("rows", rel.join(of, "x", "left").withColumn("of", F.coalesce("of", "x")))
        groups = _with_counts(_children(rel, percent, hold), hold)
        pairs.append(_listed_pairs(groups.where(F.col("c") <= split), percent))
        large = _with_main(groups.where(F.col("c") > split), hold)
        few = F.col("c") * F.col("few") <= split * split
        pairs.append(_listed_with_few(large.where(few), percent))
        many = large.where(~few).drop("c", "main", "few")
    listed = pairs[0]
    for p in pairs[1:]:
        listed = listed.unionByName(p)
    links = _confirmed(hold.put("pairs", listed.distinct()), sets, percent, hold)
    comps = connected_components(hold.put("found", links if known is None else links.unionByName(known)))
    # Only classes of several documents, or with links, need a lookup.
    lookup = classes.join(comps, classes["x"] == comps["node"], "left").where("component IS NOT NULL OR last <> x")
    lookup = hold.put("lookup", lookup.select("p1", "p2", F.col("n_shingles").alias("n"), F.coalesce("component", "x").alias("_c")))
    hold.keep("profiles", "lookup")
    on = (prof["p1"] == lookup["p1"]) & (prof["p2"] == lookup["p2"]) & (prof["n_shingles"] == lookup["n"])
    out = prof.join(lookup, on, "left").select(prof["_id"], "n_shingles", F.when(prof["n_shingles"] > 0, F.col("_c")).alias("_c"))
    comp = F.when(F.col("_id").isNotNull(), F.coalesce("_c", "_id"))
    kept = F.coalesce(comp == F.col("_id"), F.lit(True))
    return out.select(F.col("_id").alias(id_col), "n_shingles", comp.alias("component_id"), kept.alias("kept"))
