"""Repeated passages across documents: prefix-partitioned suffix trees over words.

A suffix starts at a word and is read in grams of eight words, as deep as the window. Only suffixes that can repeat are
put into trees: every window of words names the lowest-ranked gram in it, so equal windows name equal grams, and a
window whose gram is in one document only has no equal. Neighbouring windows that name the same gram are a run. Copies are
kept as classes: a document whose whole sequence of words a smaller one has is removed whole, and of runs with equal
words only the smallest document's goes into trees, and only if its gram has runs of other words too; the windows of the
others repeat as they are.

The suffixes are split by prefix, as far as their groups need it to stay within a bound: by bits of the first gram, by
one gram, by three, or by all. In each group a task sorts the suffixes, takes the lengths of their neighbours' common
prefixes and from these the internal nodes of the subtree. Nodes as deep as the window are the repeats, each held by its
smallest document; neighbouring repeated windows of a document give the maximal repeats. A node that outgrows the
bound by itself needs no tree, only its smallest document: a partial aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, written
from .textblocks import Words, mix, slices

#: Words in a gram that windows are compared by first.
GRAM = 8
#: Suffixes in a group; prefixes of more are lengthened.
GROUP = 8192
#: Parts of a group that bits of the first gram make on average, before any prefix is lengthened.
PARTS = 4
_U = np.uint64


def gram_starts(window: int) -> list[int]:
    """Where the grams of a suffix begin that together cover the window; the last one ends with it."""
    return [*range(0, window - GRAM, GRAM), window - GRAM]


def subtree(paths: np.ndarray, least: int = 1) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """The suffix tree of the rows: their order, and the internal nodes of each depth from ``least`` on.

    A row is a suffix, a column a symbol. Nodes of a depth are given by the first and the last suffix, in order, of each.
    They are the intervals of common prefixes: the longest runs of neighbours that have so many symbols in common, of which
    some have no more.
    """
    n, size = paths.shape
    order = np.lexsort(paths.T[::-1])
    rows = paths[order]
    common = np.cumprod(rows[1:] == rows[:-1], axis=1, dtype=np.int8).sum(1) if n > 1 else np.empty(0, np.int64)
    nodes = []
    for depth in range(size, least - 1, -1):
        cuts = np.concatenate([[-1], np.flatnonzero(common < depth), [n - 1]])  # behind these suffixes runs end
        first, last = cuts[:-1] + 1, cuts[1:]
        many = last > first
        first, last = first[many], last[many]
        if len(first):
            exact = np.minimum.reduceat(np.append(common, size + 1), np.stack([first, last], 1).ravel())[::2] == depth
            nodes.append((depth, first[exact], last[exact]))
    return order, nodes


def lowest(grams: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    out, have = grams, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _wide(grams: np.ndarray, at: np.ndarray, width: int, salt: int) -> np.ndarray:
    """Hash of the ``width`` words from each word of ``at`` on, from the hashes of the grams that cover them."""
    out = np.full(len(at), 0x51ED270B + salt, dtype=np.uint64)
    for k in gram_starts(width):
        out = (out ^ grams[at + k]) * _U(0x9E3779B97F4A7C15)
        out ^= out >> _U(29)
    return mix(out)


class Runs:
    """Runs of windows in a block of texts: each names one gram and has no more windows than can hold a gram.

    first, size: the word a run starts at and its windows; gram; words (hash of all its words);
    edges: runs of row k are edges[k] to edges[k + 1].
    """

    def __init__(self, words: Words, grams: np.ndarray, window: int):
        many = window - GRAM + 1
        low = lowest(grams, many) if len(words.hashes) >= window else np.empty(0, np.uint64)
        begin, end = words.edges[:-1], np.maximum(words.edges[:-1], words.edges[1:] - window + 1)
        marks = np.zeros(len(words.hashes) + 1, dtype=np.int32)
        some = end > begin
        np.add.at(marks, begin[some], 1)
        np.add.at(marks, end[some], -1)
        every = np.flatnonzero(np.cumsum(marks) > 0)
        fresh = np.zeros(len(words.hashes) + 1, dtype=bool)
        fresh[begin[some]] = True
        new = fresh[every] | (low[every] != low[every - 1]) if len(every) else np.empty(0, bool)
        heads = np.flatnonzero(new)
        new |= (np.arange(len(every)) - np.repeat(heads, np.diff([*heads, len(every)]))) % many == 0 if len(every) else new
        heads = np.flatnonzero(new)
        self.first, self.size = every[heads], np.diff([*heads, len(every)]) if len(every) else np.empty(0, np.int64)
        self.gram = low[self.first]
        # The first window and the last one cover a run, as it is no longer than a window.
        ends = [_wide(grams, at, window, salt) for at, salt in ((self.first, 11), (self.first + self.size - 1, 12))]
        self.words = mix(ends[0] ^ mix(ends[1] + self.size.astype(np.uint64)))
        self.edges = np.searchsorted(self.first, words.edges)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("bigint").alias("_id"), docs[text_col].cast("string").alias("_text"))


def _profiles(src: DataFrame, window: int) -> DataFrame:
    """_id, n, f1, f2 (fingerprint of the words in order), runs of windows: gram h, hash of words r, pos, size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                w = Words(batch.column(1).slice(a, b - a), lower=False)
                runs = Runs(w, w.grams(GRAM), window)
                n, place = np.diff(w.edges), np.arange(len(w.hashes)) - np.repeat(w.edges[:-1], np.diff(w.edges))
                sums = []
                for salt in (1, 2):
                    terms = mix(w.hashes ^ mix(place.astype(np.uint64) * _U(2) + _U(salt)) * _U(2 * salt + 1))
                    total = np.concatenate([[0], np.cumsum(terms, dtype=np.uint64)]).astype(np.uint64)
                    sums.append((total[w.edges[1:]] - total[w.edges[:-1]]).astype(np.int64))
                fields = [pa.array(x.astype(np.int64), pa.int64()) for x in (runs.gram, runs.words)]
                fields += [pa.array(x, pa.int32()) for x in (place[runs.first], runs.size)]
                lists = pa.ListArray.from_arrays(pa.array(runs.edges, pa.int32()), pa.StructArray.from_arrays(fields, ["h", "r", "pos", "size"]))
                cols = [pa.array(x, pa.int64()) for x in (n, *sums)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *cols, lists], ["_id", "n", "f1", "f2", "runs"])

    return src.mapInArrow(run, "_id bigint, n bigint, f1 bigint, f2 bigint, runs array<struct<h:bigint,r:bigint,pos:int,size:int>>")


def _suffixes(texts: DataFrame, window: int) -> DataFrame:
    """From _id, _text, wanted: a row per window of the wanted runs: doc, pos, and its grams s0, s1 and so on, 32 bits of each."""
    at = gram_starts(window)
    names = ["doc", "pos", *[f"s{k}" for k in range(len(at))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                w = Words(batch.column(1).slice(a, b - a), lower=False)
                grams = w.grams(GRAM)
                runs = Runs(w, grams, window)
                ids, lists = batch.column(0).slice(a, b - a).to_numpy(), batch.column(2).slice(a, b - a)
                hits = [s + np.flatnonzero(np.isin(runs.words[s:e], np.asarray(lists[k].values).astype(np.uint64))) for k, (s, e) in enumerate(zip(runs.edges[:-1], runs.edges[1:], strict=True))]
                hit, row = np.concatenate(hits), np.repeat(np.arange(w.rows), [len(x) for x in hits])
                size = runs.size[hit]
                row = np.repeat(row, size)
                every = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(runs.first[hit], size)
                cols, kinds = [ids[row], every - w.edges[row], *[grams[every + k].astype(np.int32) for k in at]], [pa.int64(), *[pa.int32()] * (len(at) + 1)]
                for k in range(0, len(every), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(c[k : k + (1 << 16)], t) for c, t in zip(cols, kinds, strict=True)], names)

    return texts.mapInArrow(run, ", ".join(["doc bigint", *[f"{k} int" for k in names[1:]]]))


def _deep_repeats(group: pa.Table) -> pa.Table:
    """Of the suffixes under one prefix those below a node as deep as the window that a smaller document has too."""
    doc = group.column("doc").to_numpy()
    names = [c for c in group.column_names if c.startswith("s")]
    order, nodes = subtree(np.stack([group.column(c).to_numpy() for c in names], 1), least=len(names))
    hit = np.empty(0, np.int64)
    if nodes:
        _, first, last = nodes[0]
        inside = np.concatenate([np.arange(a, b + 1) for a, b in zip(first.tolist(), last.tolist(), strict=True)])
        held = np.minimum.reduceat(doc[order][inside], np.cumsum(last - first + 1) - (last - first + 1))
        hit = order[inside][doc[order][inside] > np.repeat(held, last - first + 1)]
    return pa.table({"doc": doc[hit], "pos": group.column("pos").to_numpy()[hit]}, schema=pa.schema([("doc", pa.int64()), ("pos", pa.int32())]))


def repeated_windows(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """_id, starts, whole: where windows start whose words also start in a document of smaller id.

    ``starts`` is array<struct<pos,size>>: so many neighbouring windows from a word on. Only documents with such a window
    are listed. ``whole`` marks copies of a smaller document's whole sequence of words. Words are compared as they are.
    """
    src = _source(docs, id_col, text_col).where("_id IS NOT NULL")
    hold = Scratch(docs.sparkSession)
    prof = hold.put("profiles", _profiles(src, window).where(F.col("n") >= window))
    same = ["f1", "f2", "n"]
    owners = prof.groupBy(*same).agg(F.min("_id").alias("owner"), F.max("_id").alias("last")).where("owner <> last")
    owners = hold.put("owners", owners.select(*same, "owner"))
    prof = prof.join(owners, same, "left").select("_id", "runs", (F.col("_id") > F.col("owner")).alias("copy"))
    copies = hold.put("copies", prof.where("copy").select("_id").distinct())
    runs = prof.where("copy IS NULL OR NOT copy").select("_id", F.inline("runs"))
    kinds = hold.put("kinds", runs.groupBy("h", "r").agg(F.min("_id").alias("owner"), F.max("_id").alias("last")))
    shared = kinds.groupBy("h").agg(F.min("owner").alias("a"), F.max("last").alias("b"), (F.min("r") < F.max("r")).alias("mixed"))
    shared = kinds.join(shared.where("a < b").select("h", "mixed"), "h").where("mixed OR owner < last")
    shared = hold.put("shared", shared.select("h", "r", "owner", "mixed"))
    runs = hold.put("runs", runs.join(shared, ["h", "r"]).where("mixed OR owner < _id").select("_id", "r", "pos", "size", "owner"))
    by_run = runs.where("owner < _id").select(F.col("_id").alias("doc"), "pos", "size")
    wanted = hold.put("wanted", runs.where("owner = _id").groupBy("_id").agg(F.collect_set("r").alias("wanted")))
    suffixes = hold.put("suffixes", _suffixes(src.join(wanted, "_id"), window))
    hold.drop("profiles", "owners", "kinds", "shared", "wanted")

    # Prefixes, lengthened while more suffixes than a group holds share them. At most rows / group are heavy.
    cells = 1 << min(31, max(4, (PARTS * suffixes.count() // group).bit_length()))
    rows = suffixes.withColumn("cell", F.pmod(F.col("s0").cast("long"), F.lit(cells)))
    grams = [c for c in rows.columns if c.startswith("s")]
    levels = [["cell"], *[grams[:k] for k in sorted({1, min(3, len(grams)), len(grams)})]]
    prefix, tall, repeats = F.col("cell"), rows, [by_run]
    for level, path in enumerate(levels):
        flag = f"held{level}"
        heavy = tall.groupBy(*path).agg(F.count("*").alias("_n"), F.min("doc").alias(flag)).where(F.col("_n") > group)
        heavy = hold.put(flag, heavy.select(*[F.col(c).alias(f"_{c}") for c in path], flag))
        if heavy.isEmpty():
            break
        same = [F.col(c) == F.col(f"_{c}") for c in path]
        rows = rows.join(heavy, same, "left").drop(*[f"_{c}" for c in path])
        if path == grams:  # nodes that outgrow the bound
            repeats.append(rows.where(F.col(flag) < F.col("doc")).select("doc", "pos", F.lit(1).alias("size")))
            rows = rows.where(F.col(flag).isNull())
        else:
            prefix = F.when(F.col(flag).isNotNull(), F.xxhash64(*levels[level + 1])).otherwise(prefix)
            tall = tall.join(heavy, same, "left_semi")
    trees = rows.select(prefix.alias("prefix"), "doc", "pos", *grams).groupBy("prefix").applyInArrow(_deep_repeats, "doc bigint, pos int")
    found = trees.withColumn("size", F.lit(1))
    for r in repeats:
        found = found.unionByName(r)
    found = found.select(F.col("doc").alias("_id"), F.struct("pos", "size").alias("start"), F.lit(False).alias("whole"))
    none = F.lit(None).cast(found.schema["start"].dataType)
    found = found.unionByName(copies.select("_id", none.alias("start"), F.lit(True).alias("whole")))
    out = written(found.groupBy("_id").agg(F.collect_list("start").alias("starts"), F.bool_or("whole").alias("whole")), "repeats")
    hold.drop()
    return out


def remove_repeats(
    docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, group: int = GROUP
) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept (its words left, joined by single spaces), rest, spans.

    Removed is each word that a repeated window covers: ``window`` consecutive words of one document that also
    start in a document of smaller id, judged on the input. ``rest`` is the text without the removed words and the white
    space after them, otherwise as it was; ``spans`` are the runs of removed words, array<struct<start,end>>.
    Null text: no words. Null id: nothing removed, and nothing removed for its sake. Rows that share an id
    are one document: windows found for the id are removed from rows whose words they cover. Empty table: no
    rows. A very long text is worked on whole, by one task at a time. ``keep`` names columns to carry along; others are not read.
    """
    keep = [c for c in keep or [] if c not in (id_col, text_col)]
    repeats = repeated_windows(docs, window, id_col, text_col, group)
    kept = [docs[c].alias(f"_k{i}") for i, c in enumerate(keep)]
    src = docs.select(docs[id_col].cast("bigint").alias("_id"), docs[text_col].cast("string").alias("_text"), *kept)
    rows = src.join(repeats, "_id", "left").select("_id", "_text", "starts", "whole", *[f"_k{i}" for i in range(len(keep))])
    fields = "n_words bigint, n_removed bigint, kept string, rest string, spans array<struct<start:bigint,end:bigint>>"
    names = ["_id", *[f"_k{i}" for i in range(len(keep))], *[f.split()[0] for f in fields.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, whole = batch.column(2), batch.column(3).to_pylist()
            for a, b in slices(batch.column(1)):
                w = Words(batch.column(1).slice(a, b - a), lower=False)
                n = len(w.starts)
                gone = np.zeros(n + 1, dtype=np.int32)
                for k in range(b - a):
                    s, e = w.edges[k], w.edges[k + 1]
                    if whole[a + k]:
                        gone[s] += 1
                        gone[e] -= 1
                    elif starts[a + k].is_valid:
                        at, size = (starts[a + k].values.field(c).to_numpy().astype(np.int64) for c in (0, 1))
                        end = np.minimum(at + size - 1 + window, e - s)
                        fits = at + window <= e - s
                        np.add.at(gone, at[fits] + s, 1)
                        np.add.at(gone, end[fits] + s, -1)
                gone = np.cumsum(gone[:n]) > 0
                left = np.flatnonzero(~gone)
                row = w.row_of_words()
                # Kept words with one space after each but the last of its text.
                size = len(w.data)
                inside = np.zeros(size + 1, dtype=np.int8)
                inside[w.starts[left]] += 1
                np.add.at(inside, w.ends[left], -1)
                mask = np.cumsum(inside[:size], dtype=np.int8) > 0
                more = left[:-1][row[left[:-1]] == row[left[1:]]]
                out = w.data.copy()
                out[w.ends[more]] = 0x20
                mask[w.ends[more]] = True
                kept_text = _strings(out, mask, w.text_starts)
                # The text without the removed words: from a removed word's start to the next word's, or the text's end.
                after = np.empty(n, dtype=np.int64)
                if n:
                    after[:-1] = w.starts[1:]
                    after[-1] = size
                    last = w.edges[1:][np.diff(w.edges) > 0] - 1
                    after[last] = w.text_starts[1:][np.diff(w.edges) > 0]
                cut = np.zeros(size + 1, dtype=np.int32)
                bad = np.flatnonzero(gone)
                np.add.at(cut, w.starts[bad], 1)
                np.add.at(cut, after[bad], -1)
                rest = _strings(w.data, np.cumsum(cut[:size]) == 0, w.text_starts)
                total = np.concatenate([[0], np.cumsum(gone)])
                removed = total[w.edges[1:]] - total[w.edges[:-1]]
                # Runs of removed words.
                first = bad[np.concatenate([[True], (bad[1:] != bad[:-1] + 1) | (row[bad[1:]] != row[bad[:-1]])])] if len(bad) else bad
                final = bad[np.concatenate([(bad[1:] != bad[:-1] + 1) | (row[bad[1:]] != row[bad[:-1]]), [True]])] if len(bad) else bad
                base = w.edges[row[first]] if len(bad) else bad
                items = pa.StructArray.from_arrays([pa.array(first - base, pa.int64()), pa.array(final + 1 - base, pa.int64())], ["start", "end"])
                spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(first, w.edges), pa.int32()), items)
                own = [batch.column(c).slice(a, b - a) for c in (0, *range(4, 4 + len(keep)))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(w.edges), pa.int64()), pa.array(removed, pa.int64()), kept_text, rest, spans], names)

    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names[: 1 + len(keep)])
    out = rows.mapInArrow(run, f"{kinds}, {fields}")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_id").alias(id_col), *names[1 + len(keep) :])


def _strings(data: np.ndarray, mask: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The masked bytes of each text as a string array."""
    total = np.concatenate([[0], np.cumsum(mask)])
    offsets = pa.py_buffer(total[edges].astype(np.int32).tobytes())
    return pa.StringArray.from_buffers(len(edges) - 1, offsets, pa.py_buffer(data[mask].tobytes()))
