"""Quality rules as a bitmask ledger (native).

Every rule is evaluated once per document. The ledger stores the measurements and one bit per failed rule;
policies are versioned masks over those bits, so a new policy or an ablation reads the ledger, not the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, let

#: White space and symbols as the contract has them (fixed values).
SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
#: Words in a window that is looked up for repeats.
WINDOW = 8

#: Bit, name, condition on the measurements. Bits never change their meaning; new rules take new bits.
RULES = [
    (0, "few_words", "n_words < 20"),
    (1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    (2, "symbols", "100 * n_symbols > 40 * n_words"),
    (3, "duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 40 * n_lines"),
    (4, "short_words", "n_words > 0 AND word_chars < 2 * n_words"),
    (5, "long_words", "word_chars > 25 * n_words"),
]
#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "symbols"],
    "v2": ["few_words", "repeated_windows", "symbols", "duplicate_lines", "short_words", "long_words"],
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def mask(policy: str) -> int:
    """The bits of a policy."""
    return sum(1 << bit for bit, name, _ in RULES if name in POLICIES[policy])


def words_of(text: Column) -> Column:
    """The runs of other characters than white space."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE, -1))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words stand in windows of so many words found twice or more, the first included.

    Windows are compared by 64-bit hashes of their words' hashes, within one text only.
    """

    def covered(starts: Column) -> Column:
        reach = lambda s, k: F.least(F.lit(window), F.coalesce(F.get(starts, k + 1) - s, F.lit(window)))
        return F.aggregate(F.transform(starts, reach), F.lit(0).cast("long"), lambda a, x: a + x)

    def twice(at: Column) -> Column:
        same = lambda k: F.get(at, k)["h"]
        hit = F.transform(at, lambda s, k: F.when((s["h"] == same(k - 1)) | (s["h"] == same(k + 1)), s["i"]))
        return let(F.sort_array(F.filter(hit, lambda i: i.isNotNull())), covered)

    def compare(found: Column) -> Column:
        at = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) < F.size(found), let(at, twice)).otherwise(F.lit(0).cast("long"))

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - window),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]),
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > window, let(let(hashes, windows), compare)).otherwise(F.lit(0).cast("long"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per document: id, measurements, ``failed`` (a bit per failed rule). No shuffle.

    ``keep`` names columns of ``docs`` to carry along. Null or empty text: all measurements 0, and
    ``few_words`` fails. Null id: kept as it is. Very long texts are measured whole. Repeated rows: a row each. Empty table: no rows.
    """
    keep = keep or []
    src = docs.select(
        docs[id_col].alias("_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"),
        F.struct(*[docs[c] for c in keep]).alias("_kept") if keep else F.lit(None).alias("_kept"),
    )
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d")))
    word = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            F.length(F.array_join(w, "")).cast("long").alias("chars"),
            repeated_words(w).alias("again"),
        ),
    )
    found = F.struct(word.alias("w"), line.alias("l"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("s"))
    # A generator, so that no later filter makes Spark compute the measurements a second time.
    src = src.select("_id", "_text", "_kept", F.explode(F.array(found)).alias("_m"))
    measured = src.select(
        "_id",
        "_kept",
        F.col("_m.w.n").alias("n_words"),
        F.col("_m.w.chars").alias("word_chars"),
        F.col("_m.s").alias("n_symbols"),
        (F.col("_m.l.n") - F.col("_m.l.d")).alias("n_dup_lines"),
        F.col("_m.w.again").alias("n_repeat_words"),
        F.col("_m.l.n").alias("n_lines"),
    )
    bits = F.lit(0).cast("long")
    for bit, _, condition in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    out = measured.withColumn("failed", bits)
    return out.select(*[F.col("_kept")[c].alias(c) for c in keep if c != id_col], F.col("_id").alias(id_col), *MEASURES, "failed")


def apply_policy(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0)


def ablations(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """Per rule of a policy: how many documents fail it, how many fail nothing else, how many would stay without it.

    One pass with bitwise aggregates over the ledger; the result has a row per rule.
    """
    on = mask(policy)
    hit = F.col("failed").bitwiseAND(F.lit(on).cast("long"))
    names = [(bit, name) for bit, name, _ in RULES if on >> bit & 1]
    sums = rows.agg(
        F.count_if(hit == 0).alias("kept"),
        F.coalesce(F.bit_or(hit), F.lit(0)).alias("seen"),
        *[F.count_if(hit.bitwiseAND(F.lit(1 << b).cast("long")) != 0).alias(f"failed_{b}") for b, _ in names],
        *[F.count_if(hit == F.lit(1 << b).cast("long")).alias(f"only_{b}") for b, _ in names],
    )
    each = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col(f"failed_{b}").alias("n_failed"),
                F.col(f"only_{b}").alias("n_only"),
                (F.col("kept") + F.col(f"only_{b}")).alias("n_kept_without"),
                (F.col("seen").bitwiseAND(F.lit(1 << b).cast("long")) != 0).alias("ever_failed"),
            )
            for b, name in names
        ]
    )
    return sums.select(F.inline(each))
