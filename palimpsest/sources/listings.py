"""Text that version-control tools print: trees, objects, packs, references, patches. Column expressions only.

Each reader takes rows with a column ``value``: an entry, or a record of ``patches``. Lines of another form are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that a backslash and a letter stand for in quoted paths (fixed values).
ESCAPES = {"n": "0A", "t": "09", '"': "22", "\\": "5C", "a": "07", "b": "08", "f": "0C", "r": "0D", "v": "0B"}


def entries(spark: SparkSession, path: str, separator: str = "\n") -> DataFrame:
    """file, value: the entries of text files, which end with a line feed or, of lists made for scripts, with NUL."""
    return spark.read.option("lineSep", separator).text(path).select(F.col("_metadata.file_path").alias("file"), "value")


def _fields(rows: DataFrame, pattern: str, fields: dict[str, tuple[int, str]]) -> DataFrame:
    """The rows that match, without ``value``, with a column for each group."""
    got = [F.nullif(F.regexp_extract("value", pattern, n), F.lit("")).cast(kind).alias(name) for name, (n, kind) in fields.items()]
    return rows.where(F.col("value").rlike(pattern)).select(*[c for c in rows.columns if c != "value"], *got)


def tree_entries(rows: DataFrame) -> DataFrame:
    """Files of a tree (``ls-tree -r -l``): mode, blob, bytes (-1 if unknown), path. Submodules, which have no content, are left out."""
    out = _fields(rows, r"(?s)\A(\d+) +blob +([0-9a-f]+) +(\d+|-)\t(.*)\z", {"mode": (1, "string"), "blob": (2, "string"), "bytes": (3, "string"), "path": (4, "string")})
    return out.withColumn("bytes", F.when(F.col("bytes") == "-", F.lit(-1)).otherwise(F.try_to_number("bytes", F.lit("9" * 18))).cast("long"))


def object_entries(rows: DataFrame) -> DataFrame:
    """Objects and their sizes (``cat-file --batch-check``): object, type, bytes; type 'missing' without a size."""
    return _fields(rows, r"\A([0-9a-f]{40,64}) (?:(blob|tree|commit|tag) (\d+)|(missing))\s*\z", {"object": (1, "string"), "type": (2, "string"), "bytes": (3, "long"), "_m": (4, "string")}).withColumn(
        "type", F.coalesce("type", "_m")
    ).drop("_m")


def pack_entries(rows: DataFrame) -> DataFrame:
    """Objects of a pack (``verify-pack -v``): object, type, bytes, packed bytes, offset, and depth and base of deltas."""
    pattern = r"\A([0-9a-f]{40,64}) (blob|tree|commit|tag) +(\d+) (\d+) (\d+)(?: (\d+) ([0-9a-f]{40,64}))?\s*\z"
    names = {"object": "string", "type": "string", "bytes": "long", "packed": "long", "offset": "long", "depth": "int", "base": "string"}
    return _fields(rows, pattern, {n: (k, t) for k, (n, t) in enumerate(names.items(), 1)})


def reference_entries(rows: DataFrame) -> DataFrame:
    """References (``show-ref``): object, ref, kind (heads, remotes, tags, other) and short name; symbolic HEADs of remotes are left out."""
    out = _fields(rows, r"\A([0-9a-f]{40,64}) (\S+)\s*\z", {"object": (1, "string"), "ref": (2, "string")}).where("ref NOT LIKE 'refs/remotes/%/HEAD'")
    kind = F.regexp_extract("ref", r"\Arefs/(heads|remotes|tags)/", 1)
    return out.withColumns({"kind": F.when(kind == "", "other").otherwise(kind), "name": F.regexp_replace("ref", r"\Arefs/(?:heads|remotes|tags)/", "")})


def unquoted(path: Column) -> Column:
    """A path in C quotes as what it stands for: escapes and octal bytes, in UTF-8; other paths as they are."""
    parts = F.regexp_extract_all(F.substring(path, F.lit(2), F.length(path) - 2), F.lit(r"(?s)\\[0-7]{3}|\\.|[^\\]+"), F.lit(0))

    def code(p: Column) -> Column:
        out = F.when(p.rlike(r"\A\\[0-7]{3}\z"), F.lpad(F.conv(F.substring(p, 2, 3), 8, 16), 2, "0"))
        for letter, byte in ESCAPES.items():
            out = out.when(p == "\\" + letter, byte)
        return out.otherwise(F.hex(F.encode(p, "UTF-8")))

    quoted = path.rlike(r'(?s)\A".*"\z')
    return F.when(quoted, F.unhex(F.array_join(F.transform(parts, code), "")).cast("string")).otherwise(path)


def patches(spark: SparkSession, path: str) -> DataFrame:
    """file, value: a record per commit of ``log -p -U0 --format=%x1e%H``."""
    return entries(spark, path, "\x1e").where("value <> ''")


def patch_lines(records: DataFrame) -> DataFrame:
    """Lines that commits add and remove: commit, path, section and line_no (order in the commit), sign (+ or -), line.

    Renames must be off, so that both names of a file are the same. Files without lines, such as binary ones, give none.
    """
    keep = [c for c in records.columns if c != "value"]
    commit = F.regexp_extract("value", r"\A\s*([0-9a-f]{40,64})", 1)
    parts = records.select(*keep, commit.alias("commit"), F.posexplode(F.split("value", r"(?:\A|(?<=\n))diff --git ")).alias("section", "part")).where("section > 0")
    head = F.substring_index("part", "\n", 1)
    # "a/<path> b/<path>", or both in quotes.
    name = F.when(head.startswith('"'), unquoted(F.regexp_extract(head, r'\A("(?:[^"\\]|\\.)*")', 1))).otherwise(F.substring(head, F.lit(1), F.floor((F.length(head) - 1) / 2).cast("int")))
    body = F.regexp_extract("part", r"(?s)\n(@@ .*)\z", 1)
    rows = parts.select(*keep, "commit", "section", F.substring(name, F.lit(3), F.length(name)).alias("path"), F.posexplode(F.split(body, "\n")).alias("line_no", "line"))
    return rows.where(F.substring("line", 1, 1).isin("+", "-")).select(
        *keep, "commit", "path", "section", "line_no", F.substring("line", 1, 1).alias("sign"), F.substring(F.col("line"), F.lit(2), F.length("line")).alias("line")
    )
