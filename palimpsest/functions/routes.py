"""Which way a file goes: routes, groups and stages by extension, small predicates on rows, kinds of delivery. Sets of extensions are parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import leaf, slashes

#: Kinds whose name has a dot or a sign that other endings have too (fixed values), for ``type_and_inner``.
COMPOUND = ["db_backup", "pbl-old", "simflows", "deploy", "dump", "tmp", "out"]
#: Names of programs that are not sent (fixed value).
PROGRAM = r"(?i)\.(dll|exe)(\.v[0-9]+)?\.deploy$"
#: What a file begins with, and what it then is (fixed values).
SIGNATURES = [
    ("4D5A", "program (MZ)"), ("504B0304", "zip"), ("1F8B", "gzip"), ("25504446", "pdf"), ("89504E47", "png"), ("FFD8FF", "jpeg"), ("47494638", "gif"), ("00000100", "ico"), ("424D", "bmp"),
    ("53514C69746520666F726D61742033", "sqlite"), ("D0CF11E0", "ms office (old)"), ("5047444D50", "postgres dump"), ("425A68", "bzip2"), ("FD377A585A", "xz"), ("377ABCAF", "7z"), ("7F454C46", "elf program"),
    ("EFBBBF", "utf-8 bom text"), ("FFFE", "utf-16 text"), ("FEFF", "utf-16 text"),
]
#: Actions that leave a content in a store (fixed values).
STORED = ["written", "deduped", "in_stored"]


def route_of(ext: Column, routes: dict[str, list[str]], none: str = "no_extension", other: str = "other") -> Column:
    """The first route that has the extension; ``none`` without one, ``other`` if no route has it. Null is no extension."""
    ext = F.coalesce(ext, F.lit(""))
    out = None
    for name, members in routes.items():
        hit = ext.isin(sorted(members)) if members else F.lit(False)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    rest = F.when(ext == "", none).otherwise(other)
    return rest if out is None else out.otherwise(rest)


def group_of(ext: Column, text: list[str], binary: list[str]) -> Column:
    """text, binary or other."""
    return route_of(ext, {"text": text, "binary": binary}, "other", "other")


def signature(head: Column) -> Column:
    """What the first bytes say: a known format, empty, text-like (no zero byte) or other binary. 4096 bytes are looked at."""
    head = F.substring(head, 1, 4096)
    begins = F.hex(F.substring(head, 1, 16))
    out = F.when(F.octet_length(head) == 0, "empty")
    for mark, name in SIGNATURES:
        out = out.when(begins.startswith(mark), name)
    return out.when(F.instr(F.decode(head, "ISO-8859-1"), F.lit("\x00")) == 0, "text-like").otherwise("other binary")


def type_and_inner(path: Column) -> Column:
    """struct<type, inner>: a file's type, and the extension that its name has before that; '-' without one, or if it is longer than 12."""
    low = F.lower(slashes(path))
    kinds = [F.when(low.endswith(f".{e}"), e) for e in COMPOUND]
    kind = F.coalesce(*kinds, F.substring_index(low, ".", -1))
    name = leaf(low)
    stem = F.regexp_replace(F.left(name, F.greatest(F.length(name) - F.length(kind) - 1, F.lit(0))), r"\.v[0-9]+\z", "")
    inner = F.regexp_extract(stem, r"(?s)\A\.*[^.].*?\.([^.]*)\z", 1)
    found = F.ltrim(stem, F.lit(".")).contains(".")
    return F.struct(kind.alias("type"), F.when(found & (F.length(inner) <= 12), inner).otherwise("-").alias("inner"))


def usable(digest: Column, error: Column) -> Column:
    """Whether a row of hashes has a hash and no error."""
    return (F.coalesce(digest, F.lit("")) != "") & (F.trim(F.coalesce(error, F.lit(""))) == "")


def still_closed(action: Column, inner_path: Column, ext: Column, depth: Column, nested: list[str], archives: list[str], deepest: int) -> Column:
    """Whether a file inside an archive is kept whole though it could be opened: archives only where the depth ended the opening."""
    kept = action.isin(STORED) & (F.coalesce(inner_path, F.lit("")) != "") & ext.isin(nested)
    return F.coalesce(kept & (~ext.isin(archives) | (F.coalesce(depth, F.lit(0)) >= deepest)), F.lit(False))


def included(status: Column, listed: str) -> Column:
    """Whether a status is in a comma-separated list; blanks around names do not count."""
    return F.coalesce(status.isin([s.strip() for s in listed.split(",") if s.strip()]), F.lit(False))


def simple_path(org: Column, repo: Column, path: Column) -> Column:
    """A list's path without the folders up to organisation and repository; else without empty parts and '.'."""
    parts = F.split(slashes(F.trim(path)), "/")
    both = F.array(F.lower(org), F.lower(repo))
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.transform(F.slice(parts, i, F.lit(2)), F.lower) == both)
    cut = F.array_join(F.slice(parts, F.get(at, F.lit(0)) + 2, F.size(parts)), "/")
    return F.when(F.size(at) > 0, cut).otherwise(F.array_join(F.filter(parts, lambda p: ~p.isin("", ".")), "/"))


def delivery(path: Column) -> Column:
    """The delivery that a scanner's row is of, from the name of the folder it was mounted at; '' if it has none."""
    return F.regexp_extract(path, r"diff_analysis_p1_(.+?)_[0-9a-f]{16}(?:\\|$)", 1)


def scanner_kind(name: Column, path: Column) -> Column:
    """struct<kind, content>: a whole file by the content in its name, a file within one by that in its path, a text delivery, or other."""
    blob = r"(?<![0-9a-f])([0-9a-f]{64}|[0-9a-f]{40})\.[A-Za-z0-9_~+-]+"
    own, around = (F.regexp_extract(F.lower(x), blob, 0) for x in (name, path))
    text = name.startswith("G45_") | F.contains(path, F.lit("group5_group4_5"))
    kind = F.when(own != "", "whole file").when(around != "", "inside a whole file").when(text, "group 4.5 text (G45_ name)").otherwise("other (not a whole-file delivery)")
    return F.struct(kind.alias("kind"), F.coalesce(F.nullif(own, F.lit("")), around).alias("content"))
