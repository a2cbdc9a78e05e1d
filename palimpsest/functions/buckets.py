"""Buckets, dates and scores: column expressions over numbers and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Edges and labels (fixed values). A value under an edge takes its label.
STALE = [(30, "under a month"), (90, "1-3 months"), (365, "3-12 months"), (730, "1-2 years"), (1825, "2-5 years"), (None, "over 5 years")]
SIZES = [(100_000, "< 100 KB"), (1_000_000, "100 KB - 1 MB"), (10_000_000, "1 - 10 MB"), (100_000_000, "10 - 100 MB"), (None, ">= 100 MB")]
#: Upper edges that belong to their bucket (fixed values).
FILE_COUNTS = [0, 10, 50, 100, 500, 1000, 5000, 10000]
COMMIT_COUNTS = [0, 10, 100, 500, 1000, 5000, 10000, 50000]
LIFETIMES = [(1, "within 1 day"), (7, "<1 week"), (30, "<1 month"), (180, "<6 months"), (365, "<1 year"), (730, "1-2 years"), (1825, "2-5 years"), (10**6, "5+ years")]
VERSIONS = [(1, "1"), (2, "2"), (5, "3-5"), (10, "6-10"), (50, "11-50"), (10**9, "50+")]


def below(value: Column, edges: list) -> Column:
    """The label of the first edge that the value is under; the last label otherwise. Null stays null."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in edges[:-1]:
        out = out.when(value < edge, label)
    return out.otherwise(edges[-1][1])


def up_to(value: Column, edges: list, over: float) -> Column:
    """The label of the first edge that the value does not exceed; null if it is at most ``over`` or beyond the last edge."""
    out = F.when(value.isNull() | (value <= over), F.lit(None).cast("string"))
    for edge, label in edges:
        out = out.when(value <= edge, label)
    return out


def count_labels(edges: list[int]) -> list[tuple[int | None, str]]:
    """'0', '1-10', ..., '51+' from upper edges."""
    labels = [(e, str(e) if i == 0 else f"{edges[i - 1] + 1}-{e}") for i, e in enumerate(edges)]
    return [*labels, (None, f"{edges[-1] + 1}+")]


def count_bucket(value: Column, edges: list[int]) -> Column:
    labels = count_labels(edges)
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in labels[:-1]:
        out = out.when(value <= edge, label)
    return out.otherwise(labels[-1][1])


def utc_seconds(iso: Column) -> Column:
    """Epoch seconds of an ISO date with offset; 0 if it cannot be read."""
    return F.coalesce(F.unix_timestamp(F.try_to_timestamp(iso)), F.lit(0).cast("long"))


def days_between(first: Column, last: Column) -> Column:
    """Whole days between two ISO dates, by their first ten characters; null if one cannot be read."""
    day = lambda x: F.try_to_timestamp(F.substring(x, 1, 10), F.lit("yyyy-MM-dd")).cast("date")
    return F.datediff(day(last), day(first))


def crlf_shaped(a: Column, b: Column) -> Column:
    """Whether b is larger than a by no more than a line end on each line could add."""
    return (a >= 0) & (b > a) & (b - a <= F.greatest(F.lit(1), F.floor(a / 2)))


def symmetry(added: Column, deleted: Column) -> Column:
    """How far apart lines added and deleted are: 0 equal, 1 one-sided; null without lines."""
    most = F.greatest(added, deleted)
    return F.when(most > 0, F.round(F.abs(added - deleted) / most, 4))


#: Weights of the signs that a file deserves a look (fixed values).
WEIGHTS = {"risky_name": 50, "symmetric_delete": 25, "gone": 15, "config_or_doc": 10, "exclusive": 15, "authors_10": 10, "commits_15": 10, "short_lived": 10}


def interest(signs: dict[str, Column]) -> Column:
    """Sum of the weights of the signs that hold; null counts as not."""
    total = F.lit(0)
    for name, weight in WEIGHTS.items():
        if name in signs:
            total = total + F.when(signs[name], weight).otherwise(0)
    return total


def verdict(only_a: Column, only_b: Column, shared: Column, words: tuple[str, str, str, str, str]) -> Column:
    """One of five sentences about two sets: equal, a in b, b in a, nothing shared, both differ."""
    return (
        F.when((only_a == 0) & (only_b == 0), words[0])
        .when(only_a == 0, words[1])
        .when(only_b == 0, words[2])
        .when(shared == 0, words[3])
        .otherwise(words[4])
    )


#: Verdicts on two stores (fixed values); those of ``tree_verdict`` and ``why_sent`` are fixed too.
HISTORY_VERDICTS = ("IDENTICAL OBJECT STORES", "A'S HISTORY IS CONTAINED IN B", "B'S HISTORY IS CONTAINED IN A", "NO SHARED CONTENT AT ALL", "BOTH HOLD CONTENT THE OTHER LACKS")
COMMIT_VERDICTS = ("IDENTICAL COMMIT SETS", "A'S COMMITS ARE ALL CONTAINED IN B", "B'S COMMITS ARE ALL CONTAINED IN A", "NO SHARED COMMITS AT ALL", "BOTH HOLD COMMITS THE OTHER LACKS")
TREE_VERDICTS = (
    "IDENTICAL TREES (every snapshot in A exists in B, and vice versa)", "A'S TREES ARE ALL CONTAINED IN B",
    "B'S TREES ARE ALL CONTAINED IN A", "NO SHARED TREES AT ALL", "BOTH HOLD SNAPSHOTS THE OTHER NEVER HAD",
)


def tree_verdict(differs: Column, only_a: Column, only_b: Column, moved: Column) -> Column:
    same = differs == 0
    return (
        F.when(same & (only_a == 0) & (only_b == 0), F.when(moved == 0, "IDENTICAL").otherwise("IDENTICAL CONTENT, PATHS MOVED"))
        .when(same & (only_a == 0), "A IS A SUBSET OF B")
        .when(same & (only_b == 0), "B IS A SUBSET OF A")
        .otherwise("DIVERGED")
    )


def why_sent(at_head: Column, result: Column) -> Column:
    """Why a version that the active copy lacks is sent. ``at_head``: null means the repository has no active copy."""
    matched = result.isin("same_as_latest", "same_as_older", "same_as_other_path")
    return (
        F.when(at_head.isNull(), "no_active_repo")
        .when(~at_head, "history_only")
        .when(matched, "older_version")
        .when(result.isin("no_match", "lfs_active_real"), "active_differs")
        .otherwise("active_unreadable")
    )


def send_action(lfs: Column, size: Column, vendored: Column, most: int | None = None, skip_vendored: bool = False) -> Column:
    """What becomes of a version; the order of the rules matters."""
    out = F.when(F.coalesce(lfs, F.lit("")) != "", "lfs_stub").when(size.isNull(), "missing_object").when(size == 0, "empty")
    if skip_vendored:
        out = out.when(vendored != "", "skipped_vendored")
    if most:
        out = out.when(size > most, "too_large")
    return out.otherwise("send")
