"""Functions over contents: hashes, magic bytes, text or binary, stubs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats by their first bytes, in the order in which they are tried (fixed values).
MAGIC = [
    ("git_bundle", b"# v2 git bundle"), ("git_bundle", b"# v3 git bundle"), ("unity_assetbundle", b"UnityFS"), ("unity_assetbundle", b"UnityWeb"),
    ("unity_assetbundle", b"UnityRaw"), ("unity_assetbundle", b"UnityArchive"), ("zip", b"PK\x03\x04"), ("zip", b"PK\x05\x06"), ("zip", b"PK\x07\x08"),
    ("gz", b"\x1f\x8b"), ("bz2", b"BZh"), ("xz", b"\xfd7zXZ\x00"), ("zst", b"\x28\xb5\x2f\xfd"), ("lz4", b"\x04\x22\x4d\x18"),
    ("7z", b"7z\xbc\xaf\x27\x1c"), ("rar", b"Rar!"), ("cab", b"MSCF"), ("Z", b"\x1f\x9d"), ("Z", b"\x1f\xa0"), ("vhdx", b"vhdxfile"), ("vhd", b"conectix"),
    ("parquet", b"PAR1"), ("orc", b"ORC"), ("avro", b"Obj\x01"), ("arrow", b"ARROW1"), ("npy", b"\x93NUMPY"), ("sqlite", b"SQLite format 3\x00"),
    ("pdf", b"%PDF-"), ("html", b"<!DOCTYPE html"),
]


def file_hashes(data: Column) -> list[Column]:
    """md5, sha256, git blob id and size of a binary column."""
    size = F.octet_length(data)
    head = F.concat(F.lit("blob ").cast("binary"), size.cast("string").cast("binary"), F.unhex(F.lit("00")))
    return [F.md5(data).alias("md5"), F.sha2(data, 256).alias("sha256"), F.sha1(F.concat(head, data)).alias("git_blob"), size.cast("long").alias("bytes")]


def detect(data: Column) -> Column:
    """Format by magic bytes; a tar by its mark at byte 257; '' if unknown."""
    out = None
    for name, head in MAGIC:
        hit = data.startswith(F.unhex(F.lit(head.hex())))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.when(F.hex(F.substring(data, 258, 5)) == b"ustar".hex(), "tar").otherwise("")


def is_binary(data: Column, window: int = 8192) -> Column:
    """Whether there is a NUL byte among the first bytes."""
    return F.hex(F.substring(data, 1, window)).rlike("^(?:..)*?00")


#: Characters of bytes 80 to 9F in the Windows code page 1252; five bytes have none (fixed values).
CP1252 = "\u20ac\ufffd\u201a\u0192\u201e\u2026\u2020\u2021\u02c6\u2030\u0160\u2039\u0152\ufffd\u017d\ufffd\ufffd\u2018\u2019\u201c\u201d\u2022\u2013\u2014\u02dc\u2122\u0161\u203a\u0153\ufffd\u017e\u0178"


def decoded(data: Column) -> Column:
    """Bytes as text: UTF-16 behind its byte-order mark, else UTF-8 if they are, else code page 1252. Null for null."""
    mark = F.hex(F.substring(data, 1, 2))
    narrow = F.translate(F.decode(data, "ISO-8859-1"), "".join(map(chr, range(0x80, 0xA0))), CP1252)
    plain = F.when(F.is_valid_utf8(data.cast("string")), data.cast("string")).otherwise(narrow)
    wide = mark.isin("FFFE", "FEFF") & (F.octet_length(data) % 2 == 0)
    return F.when(wide, F.decode(F.when(wide, data), "UTF-16")).otherwise(plain)


def decoded_lines(data: Column) -> Column:
    """The lines of a content, each decoded for itself: array<string>. A content in UTF-16 is decoded as a whole."""
    wide = F.hex(F.substring(data, 1, 2)).isin("FFFE", "FEFF")
    rows = F.split(F.regexp_replace(F.hex(data), "(..)", "$1 "), "0A ")
    return F.when(wide, F.split(decoded(data), "\n")).otherwise(F.transform(rows, lambda h: decoded(F.unhex(F.replace(h, F.lit(" "), F.lit(""))))))


#: Hex digits of a character's first bytes, at least one of which is missing.
CUT_CHARACTER = "^(C[2-9A-F]|D.|E.|F[0-4]|E0[AB].|E[1-9A-CEF][89AB].|ED[89].|F0[9AB].(?:[89AB].)?|F[1-3][89AB].(?:[89AB].)?|F48.(?:[89AB].)?)$"


def looks_text(data: Column, window: int = 65536) -> Column:
    """Whether the first bytes are text: a byte-order mark, or UTF-8 without NUL that may be cut within a character.

    In contents that fill the window the last three bytes do not count. A shorter one is all there is: it may only end in an unfinished character.
    """
    head = F.substring(data, 1, window)
    mark = F.hex(F.substring(data, 1, 2)).isin("FFFE", "FEFF") | (F.hex(F.substring(data, 1, 3)) == "EFBBBF")
    whole = [F.is_valid_utf8(F.substring(head, F.lit(1), F.octet_length(head) - k).cast("string")) for k in range(4)]
    fills = F.octet_length(data) >= window
    cut = [whole[k] & (fills | F.hex(F.substring(head, -k, k)).rlike(CUT_CHARACTER)) for k in (1, 2, 3)]
    return mark | (~is_binary(data, window) & (whole[0] | cut[0] | cut[1] | cut[2]))


def lfs_pointer(data: Column) -> Column:
    """struct<oid, size> of a large-file stub of at most 1024 bytes; null otherwise."""
    text = F.when(F.octet_length(data) <= 1024, F.decode(data, "UTF-8"))
    mark = text.startswith("version https://git-lfs.github.com/spec/")
    oid = F.regexp_extract(text, r"(?m)^oid sha256:([0-9a-f]{64})\s*$", 1)
    size = F.regexp_extract(text, r"(?m)^size (\d+)\s*$", 1)
    return F.when(mark & (oid != "") & (size != ""), F.struct(oid.alias("oid"), F.try_to_number(size, F.lit("9" * 18)).cast("long").alias("size")))


def kind_of(data: Column, share: float = 0.95) -> Column:
    """empty, text (more than ``share`` of its bytes printable) or binary."""
    text = F.hex(F.substring(data, 1, 8192))
    plain = F.length(F.regexp_replace(text, "(?:09|0A|0D|[2-7][0-9A-E]|[2-6]F)|(..)", "$1"))
    return F.when(F.octet_length(data) == 0, "empty").when(F.length(text) - plain > share * F.length(text), "text").otherwise("binary")


def hex64(value: Column) -> Column:
    return value.rlike("^[0-9a-fA-F]{64}$")


def row_text(*cells: Column) -> Column:
    """Cells joined by ' | '; nested values as JSON, null as empty."""
    return F.concat_ws(" | ", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells])
