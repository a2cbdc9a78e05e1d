"""License scans (native): ordered signature rules behind a keyword prefilter.

Each rule is a regex over a text's words, tied to a keyword. A text without any keyword is passed over. Every rule whose
keyword is in a text is searched over the whole text by itself, so that detections may overlap in any way; only then rank
and containment decide. Detections that lie within a detection of higher rank, or within a longer one of their own, are
suppressed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, running_starts
from .license_rules import TEXT

#: Phrases and their labels (fixed values).
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: What separates words, before A-Z are lower-cased (fixed value).
OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Confidence of a detection by its rule's rank.
CONFIDENCE = [1.0, 0.95, 0.9, 0.85, 0.7]
RANKS = len(CONFIDENCE)


@dataclass(frozen=True)
class Rule:
    """rank: 0 is highest; a detection hides others of lower rank that lie within it."""

    keyword: str
    rank: int
    label: str
    pattern: str


#: What a declaration such as `license: MIT` becomes before its words are taken; a word that no text has.
DECLARED = "declaredlicense"
#: The sign of a declaration, with the name of the field before it, if a name follows that a rule knows.
DECLARATION = r"""(?i)(licen[cs]e)s?(?:["']?\s{0,4}[:=]|\s{0,4}=>)\s{0,4}[\["'(]{0,2}(?=(?:a?gpl|l?gpl|apache|bsd|mit|mpl|epl|isc|zlib|bsl|unlicense|wtfpl|cc0?|ofl|eupl|cddl|python|psf|artistic|postgresql|ncsa|0bsd)\b)"""
_TAG = "spdx license identifier "


def rules() -> list[Rule]:
    """The rules in their order. A rule of an identifier tag stands for three: the tag's first name, a later name of an
    expression (after `or` or `and`), and the name in a declaration."""
    out, keyword = [], ""
    for line in TEXT.strip().splitlines():
        if line.startswith("["):
            keyword = line[1:-1]
            continue
        rank, label, pattern = line.split(" ", 2)
        out.append(Rule(keyword, int(rank), label, pattern))
        if pattern.startswith(_TAG):
            name = pattern[len(_TAG) :]
            out.append(Rule(keyword, int(rank), label, rf"(?<={_TAG}[0-9a-z ]{{1,200}} (?:or|and) ){name}"))
            out.append(Rule(DECLARED, 3, label, rf"{DECLARED} {name}"))
            out.append(Rule(DECLARED, 3, label, rf"(?<={DECLARED} [0-9a-z ]{{1,200}} (?:or|and) ){name}"))
    return out


def keywords() -> list[str]:
    return sorted({r.keyword for r in rules()})


def normal(text: Column) -> Column:
    """Words joined by single spaces, letters as they were."""
    return F.trim(F.regexp_replace(text, OTHER, " "))


def n_words(norm: Column) -> Column:
    return F.when(norm == "", 0).otherwise(F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) + 1).cast("long")


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _detections(padded: Column) -> Column:
    """All hits in words with a space around each: array<struct<start,less,rank,conf,label>>, less: minus the end, so that a sort puts the longest first."""
    by_key: dict[str, list[dict]] = {}
    for r in rules():
        by_key.setdefault(f" {r.keyword} ", []).append({"pattern": rf"(?<= )(?:{r.pattern})(?= )", "rank": r.rank, "conf": CONFIDENCE[r.rank], "label": r.label})
    table = [{"key": k, "own": own} for k, own in by_key.items()]
    known = F.from_json(F.lit(json.dumps(table)), "array<struct<key:string,own:array<struct<pattern:string,rank:int,conf:double,label:string>>>>")
    tried = F.flatten(F.transform(F.filter(known, lambda k: F.contains(padded, k["key"])), lambda k: k["own"]))
    found = F.filter(
        F.transform(tried, lambda r: F.struct(r.alias("r"), F.regexp_extract_all(padded, r["pattern"], F.lit(0)).alias("hits"))), lambda g: F.size(g["hits"]) > 0
    )

    def hits(g: Column) -> Column:
        r, gaps = g["r"], F.split(padded, g["r"]["pattern"], -1)

        def hit(h: Column, start: Column) -> Column:
            less = (-(start + _spaces(h) + 1)).cast("long").alias("less")
            return F.struct(start.alias("start"), less, r["rank"].alias("rank"), r["conf"].alias("conf"), r["label"].alias("label"))

        def placed(gap: Column) -> Column:
            sizes = F.transform(g["hits"], lambda h, i: (_spaces(F.get(gap, i)) + _spaces(h)).cast("long"))
            return let(running_starts(sizes), lambda at: F.transform(g["hits"], lambda h, i: hit(h, (F.get(at, i) + _spaces(F.get(gap, i)) - 1).cast("long"))))

        return let(gaps, placed)

    return F.flatten(F.transform(found, hits))


def _surviving(hits: Column) -> Column:
    """Labels and confidence after suppression: one sweep by start, longest first, with the furthest end of each rank."""

    def step(a: Column, h: Column) -> Column:
        end = -h["less"]
        hidden = F.lit(False)
        for k in range(RANKS):
            # Within a hit of higher rank; or, of its own rank, within a longer one.
            same = (h["rank"] == k) & ((a[f"from{k}"] < h["start"]) & (a[f"end{k}"] >= end) | (a[f"end{k}"] > end))
            hidden = hidden | (h["rank"] > k) & (a[f"end{k}"] >= end) | same
        ends = []
        for k in range(RANKS):
            further = (h["rank"] == k) & (end > a[f"end{k}"])
            ends += [
                F.when(further, h["start"]).otherwise(a[f"from{k}"]).alias(f"from{k}"),
                F.when(further, end).otherwise(a[f"end{k}"]).alias(f"end{k}"),
            ]
        return F.struct(
            *ends,
            F.when(hidden, a["labels"]).otherwise(F.array_union(a["labels"], F.array(h["label"]))).alias("labels"),
            F.when(hidden, a["conf"]).otherwise(F.greatest(a["conf"], h["conf"])).alias("conf"),
        )

    none = F.lit(-1).cast("long")
    begin = F.struct(
        *[x for k in range(RANKS) for x in (none.alias(f"from{k}"), none.alias(f"end{k}"))],
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("conf"),
    )
    return F.aggregate(F.sort_array(hits), begin, step, lambda a: F.struct(a["labels"].alias("labels"), a["conf"].alias("conf")))


def prefilter() -> str:
    """A text that this does not match has no keyword and no base phrase."""
    words = sorted({*keywords(), *[p.split()[0] for p, _ in BASE], "licen[cs]es?"} - {DECLARED})
    return rf"(?i)(?<![0-9A-Za-z\x80-\x{{10FFFF}}])(?:{'|'.join(words)})(?![0-9A-Za-z\x80-\x{{10FFFF}}])"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels (arrays), score. No shuffle.

    Words are lower-cased runs of letters, digits and characters over 0x7F. ``score`` is the highest
    confidence of a surviving detection, at least 0.5 with a base phrase, 0 without a label. Null or
    empty text: no words. Null ids are ids like any other. Whole texts are searched, however long. Each rule's hits
    do not overlap one another; those of different rules may.
    Repeated rows: a row each. Empty table: no rows. Other columns are not read.
    """
    src = docs.select(docs[id_col].alias("_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"))
    text = F.col("_text")
    phrases = "|".join(p for p, _ in BASE)
    any_base = rf"(?:^| )({phrases})(?= |\z)"
    count = lambda s: F.when(s == "", 0).otherwise(_spaces(s) + 1)

    def base(low: Column) -> Column:
        hit = low.rlike(any_base)
        found = F.filter(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(x).alias("x")) for p, x in BASE]), lambda b: F.contains(F.concat(F.lit(" "), low, F.lit(" ")), F.concat(F.lit(" "), b["p"], F.lit(" "))))
        return F.struct(
            F.regexp_count(low, F.lit(any_base)).cast("long").alias("n"),
            F.when(hit, count(F.get(F.split(low, any_base, 2), F.lit(0)))).cast("long").alias("first"),
            F.when(hit, count(F.regexp_extract(low, rf"(?s)^(.*)(?:^| )(?:{phrases})(?= |\z)", 1))).cast("long").alias("last"),
            F.transform(found, lambda b: b["x"]).alias("labels"),
        )

    # Words as the rules read them: declarations are marked.
    marked = F.translate(normal(F.regexp_replace(text, DECLARATION, f"$1 {DECLARED} ")), UPPER, LOWER)

    def all_of(low: Column) -> Column:
        more = let(F.concat(F.lit(" "), marked, F.lit(" ")), lambda w: let(_detections(w), _surviving))
        return F.struct(base(low).alias("base"), more.alias("more"))

    def row(norm: Column) -> Column:
        return F.struct(
            n_words(norm).alias("n"), F.when(text.rlike(prefilter()), let(F.translate(norm, UPPER, LOWER), all_of)).alias("hit")
        )

    src = src.select("_id", F.explode(F.array(let(normal(text), row))).alias("_r"))
    none = F.array().cast("array<string>")
    base_labels = F.coalesce(F.col("_r.hit.base.labels"), none)
    labels = F.array_sort(F.array_union(base_labels, F.coalesce(F.col("_r.hit.more.labels"), none)))
    score = F.greatest(F.when(F.size(base_labels) > 0, 0.5).otherwise(0.0), F.coalesce(F.col("_r.hit.more.conf"), F.lit(0.0)))
    return src.select(
        F.col("_id").alias(id_col),
        F.col("_r.n").alias("n_words"),
        F.coalesce(F.col("_r.hit.base.n"), F.lit(0).cast("long")).alias("n_base"),
        F.col("_r.hit.base.first").alias("first_word"),
        F.col("_r.hit.base.last").alias("last_word"),
        F.array_sort(base_labels).alias("base_labels"),
        labels.alias("labels"),
        score.alias("score"),
    )
