"""Readable strings in binary data, as column expressions: each byte is a character of ISO-8859-1, so patterns see bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Runs of four characters and more (fixed values): ASCII or UTF-8; ASCII in UTF-32 and UTF-16, low byte first.
#: Possessive, as a run never gives characters back: so that a run of any length takes no stack.
NARROW = r"(?:[\x20-\x7e]|[\xc2-\xf4][\x80-\xbf]{1,3}){4,}+"
UTF32 = r"(?:[\x20-\x7e]\x00{3}){4,}+"
UTF16 = r"(?:[\x20-\x7e]\x00){4,}+"
#: What a run has to have to be kept (fixed values): a word in natural case; or a number with separators.
WORD = r"[A-ZÀ-Þ]?[a-zß-ÿ]{3,}|[A-ZÀ-Þ]{4,}"
NUMBER = r"[\d \-/().+]{6,}"
#: Scripts beyond Latin of which three letters in a row are a word.
SCRIPTS = "Greek Cyrillic Armenian Hebrew Arabic Syriac Devanagari Bengali Gurmukhi Gujarati Tamil Telugu Kannada Malayalam Thai Lao Tibetan Myanmar Georgian Hangul Ethiopic Khmer Mongolian Hiragana Katakana Han".split()


def mined(content: Column) -> Column:
    """The strings of a binary: narrow runs in order, then those of UTF-32, then of UTF-16. Null: null; bytes that are no UTF-8 become U+FFFD."""
    chars = F.decode(content, "ISO-8859-1")
    found = lambda pattern: F.regexp_extract_all(chars, F.lit(pattern), F.lit(0))
    narrow = F.transform(found(NARROW), lambda h: F.make_valid_utf8(F.encode(h, "ISO-8859-1").cast("string")))
    wide = F.transform(F.concat(found(UTF32), found(UTF16)), lambda h: F.replace(h, F.lit("\x00"), F.lit("")))
    return F.concat(narrow, wide)


def worth_keeping(s: Column) -> Column:
    """Whether a run looks like text: a number with five digits and separators; or 60 % letters, digits and spaces with a word in it."""
    digits = F.length(F.regexp_replace(s, r"\D", ""))
    plain = F.length(F.regexp_replace(s, r"[^\p{L}\p{N} ]", ""))
    scripts = "|".join(rf"[\p{{L}}&&\p{{Is{x}}}&&[^\x00-\x{{24F}}]]{{3}}" for x in SCRIPTS)
    number = (F.length(s) >= 6) & s.rlike(rf"\A(?:{NUMBER})\z") & (digits >= 5)
    word = (F.length(s) >= 6) & s.rlike(WORD) | s.rlike(scripts)
    return number | ((plain * 10 >= F.length(s) * 6) & word)


def mined_text(content: Column) -> Column:
    """The strings of a binary that look like text."""
    return F.filter(mined(content), worth_keeping)
