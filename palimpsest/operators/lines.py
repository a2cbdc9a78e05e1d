"""Lines of file versions: first-seen lines and the delta against a current version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: White space at a line's ends (fixed values): Unicode's and the separators U+001C to U+001F.
_BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def stripped(text: Column) -> Column:
    """Without white space at both ends, Unicode's and the separators U+001C to U+001F included."""
    return F.regexp_replace(text, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def stripped_lines(text: Column) -> Column:
    """The lines of a text, each stripped. Characters at a line's ends are looked up in a set, so what lies between is not read."""
    return F.transform(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(_BLANKS)))


def lines(texts: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """A row per line with something on it: keys, line_no (from 0), line (stripped). Lines end at line feeds only."""
    return texts.select(*keys, F.posexplode(stripped_lines(F.col(text))).alias("line_no", "line")).where("line <> ''")


def first_seen(rows: DataFrame, group: list[str], order: list[str], line: str = "line") -> DataFrame:
    """Each distinct line of a group once, with where it was first seen."""
    return rows.groupBy(*group, line).agg(F.min(F.struct(*order)).alias("_first")).select(*group, line, *[F.col(f"_first.{c}") for c in order])


def delta(history: DataFrame, current: DataFrame, group: list[str], line: str = "line") -> DataFrame:
    """Lines of history that the current version of the group lacks."""
    return history.join(current.select(*group, line).distinct(), [*group, line], "left_anti")


def lines_by_side(texts: DataFrame, text: str, group: list[str], is_current: Column, in_history: Column | None = None, hashed: bool = False) -> DataFrame:
    """Each distinct line of a group once: ``_c`` if a current version has it, ``_h`` if history has.

    Versions are marked before they are split, and each gives a line once, so that lines are shuffled once, by group and line with partial
    aggregates, and never joined. Without ``in_history`` all texts are history. ``hashed``: lines go by two 64-bit hashes, and are not given.
    """
    history = F.lit(True) if in_history is None else in_history
    marked = texts.select(*group, F.coalesce(is_current, F.lit(False)).alias("_c"), F.coalesce(history, F.lit(False)).alias("_h"), F.explode(F.array_distinct(stripped_lines(F.col(text)))).alias("line"))
    marked, line = marked.where("line <> ''"), ["line"]
    if hashed:
        line = ["_l1", "_l2"]
        marked = marked.select(*group, "_c", "_h", F.xxhash64("line").alias("_l1"), F.xxhash64(F.lit(1), "line").alias("_l2"))
    return marked.groupBy(*group, *line).agg(F.bool_or("_c").alias("_c"), F.bool_or("_h").alias("_h"))


def text_delta(texts: DataFrame, text: str, group: list[str], is_current: Column, in_history: Column | None = None) -> DataFrame:
    """Lines of a group's history that its current version lacks, from the texts."""
    return lines_by_side(texts, text, group, is_current, in_history).where("_h AND NOT _c").select(*group, "line")


def delta_counts(texts: DataFrame, text: str, group: list[str], is_current: Column, in_history: Column | None = None) -> DataFrame:
    """Per group: lines of history, of the current version, removed, kept, and what became of the group. Lines go by 128-bit hashes."""
    sides = lines_by_side(texts, text, group, is_current, in_history, hashed=True).groupBy(*group)
    counts = sides.agg(F.count_if("_h").alias("lines_history"), F.count_if("_c").alias("lines_current"), F.count_if(F.col("_h") & ~F.col("_c")).alias("lines_kept"))
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    rows = texts.select(*group).distinct().join(counts, group, "left").select(*group, zero("lines_history"), zero("lines_current"), zero("lines_kept"))
    action = (
        F.when(F.col("lines_history") == 0, "no_history")
        .when(F.col("lines_current") == 0, "no_current")
        .when(F.col("lines_kept") == 0, "nothing_left")
        .when(F.col("lines_kept") == F.col("lines_history"), "unchanged")
        .otherwise("reduced")
    )
    return rows.withColumns({"lines_removed": F.col("lines_history") - F.col("lines_kept"), "action": action})
