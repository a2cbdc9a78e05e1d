"""Exact top-k search by Fagin's threshold algorithm.

Vectors are dealt into blocks of bounded size, queries too. In a block every dimension has a list of the vectors
sorted by it. The lists are read from both ends in lockstep; each vector that comes up is scored in full, and a
query is done when the best score that an unread vector could have is below its kth score. The block
results, k rows a query, are merged by rank.

Scores are exact at any size. Where doubles could round a sum, they only rule out vectors, by a bound on their
error; those that are left are scored with whole numbers of any length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Most vectors in a block of candidates and of queries, on average; bounds a task.
CANDIDATES, QUERIES = 8192, 32768
#: Sums of whole numbers are exact in floats and doubles up to these.
FLOAT, DOUBLE = 1 << 24, 1 << 53
LONG = 1 << 63


def finite(vector: Column) -> Column:
    """The vector as doubles; null if it is null or a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), vector.cast("array<double>"))


def scaled(values: np.ndarray, scale: int = 256) -> np.ndarray:
    """floor(scale * x) of finite doubles: doubles where they hold it exactly, else Python's whole numbers."""
    if np.abs(values).max(initial=0) * scale < DOUBLE:
        return np.floor(values * float(scale))
    exact = lambda x: scale * int(x) if abs(x) >= DOUBLE else math.floor(scale * x) if abs(x) * scale < DOUBLE else scale * int(x) + math.floor(scale * (x - int(x)))
    return np.array([exact(x) for x in values.ravel().tolist()], dtype=object).reshape(values.shape)


class Scorer:
    """Inner products of whole numbers: exact ones of pairs, and bounds of them for all pairs of two blocks."""

    def __init__(self, rows: np.ndarray, queries: np.ndarray):
        most = [int(abs(m).max(initial=0)) if m.size else 0 for m in (rows, queries)]
        reach = max(1, most[0]) * max(1, most[1]) * max(1, rows.shape[1])
        self.exact_rows, self.exact_queries = rows, queries
        self.wide = reach >= DOUBLE
        kind = np.float32 if reach < FLOAT else np.float64
        # Powers of two take very large numbers into the range of doubles, in which products stay finite.
        self.shift = [max(0, m.bit_length() - 480) for m in most]
        self.rows, self.queries = (m.astype(kind) if not k else np.array([float(x >> k) for x in m.ravel()]).reshape(m.shape) for m, k in zip((rows, queries), self.shift, strict=True))
        # Of each component a unit may be lost where bits were shifted out, besides the rounding of sums and products.
        self.loss = [1.0 if k else 0.0 for k in self.shift]
        self.kind = kind

    def bounds(self, part: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the most that each score can be, in units of 2 to the shifts' sum."""
        q, r = self.queries[part], self.rows[new]
        score = q @ r.T
        if not self.wide:
            return score, score
        slack = (np.abs(q) + self.loss[1]) @ (np.abs(r) + self.loss[0]).T * ((q.shape[1] + 4) * 2.0**-52)
        slack += self.loss[1] * np.abs(r).sum(1)[None, :] + self.loss[0] * np.abs(q).sum(1)[:, None] + self.loss[0] * self.loss[1] * q.shape[1]
        slack *= 1 + 1e-9
        return score - slack, score + slack

    def exact(self, part: np.ndarray, new: np.ndarray) -> list[int]:
        """The scores of pairs of a query and a row."""
        return [sum(int(a) * int(b) for a, b in zip(self.exact_queries[i].tolist(), self.exact_rows[j].tolist(), strict=True)) for i, j in zip(part.tolist(), new.tolist(), strict=True)]


def threshold_search(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, step: int = 64) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Query id, id and score of each query's k best rows, ties to the smaller id, the query's own id left out.

    Rows and queries hold whole numbers. Stops exactly: a query goes on while an unread row could still reach its kth
    score, as it could win a tie.
    """
    n, dims = rows.shape
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    scorer = Scorer(rows, queries)
    lists = np.argsort(scorer.rows, axis=0, kind="stable")  # of each dimension, lowest first
    seen = np.zeros(n, dtype=bool)
    found: list[list[tuple[int, int]]] = [[] for _ in query_ids]  # minus the score, and the id
    kth = np.full(len(queries), -np.inf)  # what an unread row has to reach
    units = 1 << sum(scorer.shift)
    open_ = np.arange(len(queries))
    depth = 0
    while depth < n and len(open_):
        deeper = min(n, depth + step)
        step *= 2
        read = np.zeros(n, dtype=bool)
        read[lists[depth:deeper].ravel()] = True
        read[lists[n - deeper : n - depth].ravel()] = True
        new = np.flatnonzero(read & ~seen)
        seen[new] = True
        depth = deeper
        for at in range(0, len(open_), 512):
            part = open_[at : at + 512]
            low, high = scorer.bounds(part, new)
            first, last = (np.searchsorted(ids[new], query_ids[part], side=s) for s in ("left", "right"))
            for m in np.flatnonzero(last > first):  # ids may repeat
                low[m, first[m] : last[m]] = high[m, first[m] : last[m]] = -np.inf
            least = kth[part]
            if len(new) > k:
                least = np.maximum(least, np.partition(low, len(new) - k, axis=1)[:, len(new) - k])
            q, j = np.nonzero((high >= least[:, None]) & (high > -np.inf))
            scores = scorer.exact(part[q], new[j]) if scorer.wide else low[q, j].astype(np.int64).tolist()
            for i, row_id, score in zip(part[q].tolist(), ids[new[j]].tolist(), scores, strict=True):
                found[i].append((-score, row_id))
            for i in part[np.unique(q)].tolist():
                found[i] = sorted(set(found[i]))[:k]  # a row that is there twice counts once
                if len(found[i]) == k:
                    value = -found[i][-1][0] // units
                    kth[i] = value - abs(value) * 2.0**-50 - 1 if scorer.wide else value
        if depth < n:
            each = np.arange(dims)
            low, high = scorer.rows[lists[depth, each], each].astype(np.float64), scorer.rows[lists[n - 1 - depth, each], each].astype(np.float64)
            # What lies unread in a list is between the two ends reached; the product is largest at one of them.
            q = scorer.queries[open_].astype(np.float64)
            bound = np.where(q > 0, q * high, q * low).sum(1) if dims else np.zeros(len(q))
            if scorer.wide and dims:
                far = np.maximum(np.abs(low), np.abs(high))
                bound += (np.abs(q) * far).sum(1) * (dims + 4) * 2.0**-51 + scorer.loss[1] * (far.sum() + dims) + scorer.loss[0] * (np.abs(q).sum(1) + dims)
            open_ = open_[bound >= kth[open_]]
        if seen.all():
            break
    flat = [(i, row_id, -score) for i, own in enumerate(found) for score, row_id in own]
    return query_ids[[i for i, _, _ in flat]] if flat else query_ids[:0], np.array([x for _, x, _ in flat], np.int64), [x for _, _, x in flat]


def sortable(number: int) -> bytes:
    """Bytes that sort as whole numbers of any length do."""
    size = (abs(number).bit_length() + 7) // 8
    if number >= 0:
        return (0x8000 + size).to_bytes(2, "big") + number.to_bytes(size, "big")
    return (0x8000 - size).to_bytes(2, "big") + ((1 << 8 * size) - 1 + number).to_bytes(size, "big")


def topk(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, candidates: int = CANDIDATES, queries: int = QUERIES
) -> DataFrame:
    """Each query's k highest integer inner products: query_id, rank (from 1), the id, score. Ties to the smaller id.

    Components x are taken as floor(scale * x), exactly, and so are the sums that rank the rows. ``score`` is a long; a
    sum that no long can hold is given as the nearest long, its rank is still by the sum itself. Vectors that are null,
    or hold a null or a component that is not finite, take no part; nor do rows without an id. Only vectors of equal length
    are compared. Equal repeated rows count once. Fewer than k candidates: all of them. Empty table: no rows. Other columns
    are not read.
    """
    base = vectors.select(vectors[id_col].cast("bigint").alias("_id"), finite(vectors[vector_col]).alias("_v"), F.coalesce(is_query, F.lit(False)).alias("_q"))
    base = base.where("_id IS NOT NULL AND _v IS NOT NULL")
    n, nq = vectors.select(F.count("*"), F.count_if(is_query)).first()
    blocks, query_blocks = -(-n // candidates) or 1, -(-nq // queries) or 1
    deal = lambda count, seed: F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    mine = base.withColumns({"_c": deal(blocks, 1)}).withColumn("_b", every(query_blocks)).withColumn("_q", F.lit(False))
    asked = base.where("_q").withColumns({"_b": deal(query_blocks, 2)}).withColumn("_c", every(blocks))
    cells = mine.select("_c", "_b", "_id", "_v", "_q").unionByName(asked.select("_c", "_b", "_id", "_v", "_q"))
    cells = cells.withColumn("_d", F.size("_v"))

    def search(batches: pa.Table) -> pa.Table:
        dims = batches.column("_d")[0].as_py()
        ids = batches.column("_id").to_numpy()
        matrix = scaled(batches.column("_v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dims), scale)
        asks = batches.column("_q").to_numpy(zero_copy_only=False).astype(bool)
        found = threshold_search(ids[~asks], matrix[~asks], ids[asks], matrix[asks], k) if asks.any() and not asks.all() else (ids[:0], ids[:0], [])
        near = [max(-LONG, min(LONG - 1, s)) for s in found[2]]
        return pa.table({"query_id": found[0], "_id": found[1], "score": pa.array(near, pa.int64()), "_sum": pa.array([sortable(s) for s in found[2]], pa.binary())})

    parts = cells.groupBy("_c", "_b", "_d").applyInArrow(search, "query_id bigint, _id bigint, score bigint, _sum binary")
    best = Window.partitionBy("query_id").orderBy(F.desc("_sum"), "_id")
    return (
        parts.distinct()
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("_id").alias(id_col if id_col != "query_id" else "id"), "score")
    )
