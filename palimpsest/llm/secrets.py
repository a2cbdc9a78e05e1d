"""Secret scans (native): fixed patterns, and Markov models of random strings against ordinary identifiers.

A first-order character model is trained for each of two labelled classes. A candidate token is a secret
if random strings explain its characters better than identifiers do: the mean log-likelihood ratio of its
steps is over a threshold. Both training and scoring are DataFrame expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, match_spans

#: Kind, pattern, condition on a match (fixed values). Matches that fail the condition are dropped, not searched again.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KINDS = ["assign", "access", "hex", "random"]

#: Candidates for the models: tokens of so many characters with at least a letter and a digit.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
#: Characters that the models tell apart; any other counts as the last class.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CLASSES = len(ALPHABET) + 1
#: Mean log-likelihood ratio per step, in nats, from which on a token counts as random.
THRESHOLD = 0.6
#: Labelled samples of each class that the default models are trained on.
SAMPLES = 4096

#: Parts of ordinary identifiers (fixed values), joined by rule into the labelled samples of that class.
PARTS = (
    "account action active address admin after agent alert amount api app archive array async audit author auth base batch "
    "before begin bit block body book branch buffer build button byte cache call card case center chain change channel char "
    "check child class clean client clock close cloud code color column command commit common compare config connect content "
    "context control convert copy core count create current customer data date debug default delete depth detail device "
    "directory display document domain download draft driver edit element email enable encode end engine entry error event "
    "example export factory field file filter final find first flag folder format frame from function global graph group "
    "handler hash header height helper history host image import index info init input install instance integer internal "
    "invoice item job join key label language last layer length level library limit line link list load local lock login "
    "manager map mark master match member memory merge message method model module monitor month name native network next "
    "node note number object offset option order output owner package page panel parent parse password path pattern payment "
    "phone picture pipeline plan player point policy position prefix present price print process product profile project "
    "property provider public query queue random range read record region release remote remove render report request "
    "reset resource response result return role root route rule sample save scale schedule schema scope screen script search "
    "second section select send sequence server service session setting shape share signal size sort source space stack "
    "start state status step storage store stream string style summary support switch system table target task template "
    "test text theme thread time title token tool topic trace track train transfer tree trigger type union unit update "
    "upload user util value variable vector version view visible volume watch width window with worker wrapper write zone"
).split()


def labelled_samples(spark: SparkSession, each: int = SAMPLES) -> DataFrame:
    """(token, is_random): ``each`` random strings and ``each`` ordinary identifiers, made by rule; no corpus rows.

    Random strings are digests in base64, its url-safe form, letters and digits of either or one case, base32 and hexadecimal of
    either case. Identifiers join two to four parts in snake, kebab, camel, path and constant case, most of them with
    numbers, versions, dates or times as people write them.
    """
    n = F.col("id")
    hexes = F.sha2(F.concat(F.lit("sample "), n), 256)
    digest = F.base64(F.unhex(hexes))
    plain = F.translate(digest, "+/=", "")
    forms = [digest, F.translate(digest, "+/", "-_"), plain, F.lower(plain), F.upper(F.translate(plain, "0189", "")), F.substring(hexes, 1, 40), F.upper(F.substring(hexes, 1, 40)), F.substring(plain, 1, 20)]
    rand = F.get(F.array(*forms), (n % len(forms)).cast("int"))
    parts = F.array(*[F.lit(p) for p in PARTS])
    draw = lambda key, count: F.pmod(F.xxhash64(n, F.lit(key)), F.lit(count)).cast("int")
    some = F.slice(F.array(*[F.get(parts, draw(k, len(PARTS))) for k in range(4)]), F.lit(1), draw("words", 3) + 2)
    two = lambda key, least, count: F.lpad((draw(key, count) + least).cast("string"), 2, "0")
    year, month, day = (draw("year", 60) + 1970).cast("string"), two("month", 1, 12), two("day", 1, 28)
    time = F.concat(two("hour", 0, 24), two("minute", 0, 60), two("second", 0, 60))
    number = draw("number", 3000).cast("string")
    tails = [
        F.lit(""), F.substring(number, 1, 1), number, F.concat(F.lit("_"), number), F.concat(F.lit("-"), number), F.concat(F.lit("_v"), F.substring(number, 1, 1)),
        F.concat(F.lit("-v"), F.substring(number, 1, 2), F.lit("beta1")), F.concat_ws("_", F.lit(""), year, month, day), F.concat_ws("-", F.lit(""), year, month, day),
        F.concat_ws("/", F.lit(""), year, month, day), F.concat(F.lit("_"), year, month, day, F.lit("_"), time), F.concat(F.lit("-"), year, month, day, F.lit("T"), time, F.lit("Z")),
        F.lit("_x86_64"), F.lit("-64bit"), F.lit("_utf8"), F.lit("-sha256"), F.concat(F.lit("-"), number, F.lit("x"), draw("more", 3000).cast("string")),
    ]
    camel = F.array_join(F.transform(some, lambda w: F.initcap(w)), "")
    styles = [F.array_join(some, "_"), F.array_join(some, "-"), camel, F.array_join(some, "/"), F.upper(F.array_join(some, "_"))]
    style = F.get(F.array(*styles), draw("style", len(styles)))
    rows = spark.range(each)
    return rows.select(rand.alias("token"), F.lit(True).alias("is_random")).unionByName(
        rows.select(F.concat(style, F.get(F.array(*tails), draw("tail", len(tails)))).alias("token"), F.lit(False).alias("is_random"))
    )


def _class(char: Column) -> Column:
    at = F.instr(F.lit(ALPHABET), char)
    return F.when(at > 0, at - 1).otherwise(len(ALPHABET))


def _steps(token: Column) -> Column:
    """Index of each pair of neighbouring characters in the model."""
    pair = lambda i: (_class(F.substring(token, i, F.lit(1))) * CLASSES + _class(F.substring(token, i + 1, F.lit(1)))).cast("int")
    return F.when(
        F.length(token) > 1, F.transform(F.sequence(F.lit(1), F.length(token) - 1), pair)
    ).otherwise(F.array().cast("array<int>"))


def train(samples: DataFrame) -> list[float]:
    """The log-likelihood ratio of each step, from labelled rows (token, is_random); add-one smoothing.

    What comes to the driver has at most 2 * 68 * 68 rows, whatever the number of samples. Null tokens and
    labels are left out; with no samples all ratios are 0.
    """
    steps = samples.where("token IS NOT NULL AND is_random IS NOT NULL").select(
        "is_random", F.explode(_steps(F.col("token"))).alias("step")
    )
    counts = {True: [1.0] * CLASSES**2, False: [1.0] * CLASSES**2}
    for row in steps.groupBy("is_random", "step").count().collect():
        counts[row["is_random"]][row["step"]] += row["count"]
    logs = {}
    for label, c in counts.items():
        sums = [sum(c[a * CLASSES : (a + 1) * CLASSES]) for a in range(CLASSES)]
        logs[label] = [math.log(v / sums[i // CLASSES]) for i, v in enumerate(c)]
    return [round(a - b, 4) for a, b in zip(logs[True], logs[False], strict=True)]


def randomness(token: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio of a token's steps; 0 for fewer than two characters."""
    ratios = F.array(*[F.lit(x) for x in model])
    steps = _steps(token)
    score = lambda s: F.aggregate(s, F.lit(0.0), lambda a, i: a + F.get(ratios, i))
    return let(steps, lambda s: F.when(F.size(s) > 0, score(s) / F.size(s)).otherwise(F.lit(0.0)))


def _spans(text: Column, kind: str, pattern: str, where) -> Column:
    """Matches of one pattern that pass, as array<struct<start,kind_no,end>>: sorts by start, then kind as listed."""
    found = F.filter(match_spans(text, pattern), where)
    return F.transform(
        found, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"))
    )


def base_spans(text: Column) -> Column:
    """The spans of the three fixed patterns, sorted by start, then kind as listed."""
    assign = _spans(text, "assign", ASSIGN, lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 1)) >= ASSIGN_LEAST)
    access = _spans(text, "access", ACCESS, lambda s: F.length(s["hit"]) >= ACCESS_LEAST)
    # Runs of [0-9a-f] are maximal, so asking for the length in the pattern finds the same ones.
    hexes = _spans(text, "hex", HEX[:-1] + f"{{{HEX_LEAST},}}", lambda s: F.lit(True))
    return F.sort_array(F.concat(assign, access, hexes))


def random_spans(text: Column, model: list[float], threshold: float = THRESHOLD) -> Column:
    """Tokens with a letter and a digit that the models call random, as spans of kind 'random'."""
    mixed = lambda s: s["hit"].rlike("[0-9]") & s["hit"].rlike("[A-Za-z]")
    return _spans(text, "random", TOKEN, lambda s: F.when(mixed(s), randomness(s["hit"], model) > threshold).otherwise(False))


def scan(
    docs: DataFrame, model: list[float], id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """One row per document: id, base and spans: array<struct<start,kind,end>> in code points, end exclusive; n_random. No shuffle.

    ``base`` has the fixed patterns' spans; ``spans`` adds tokens that the models call random and that base spans
    do not cover wholly; ``n_random`` counts all tokens that the models call random, covered ones too. Null or empty text: no
    spans. Null ids are ids like any other. Whole texts are searched, however long. Repeated rows: a row each. Empty table: no
    rows. ``keep`` names columns to carry along; others are not read.
    """
    keep = keep or []
    src = docs.select(
        docs[id_col].alias("_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"),
        F.struct(*[docs[c] for c in keep]).alias("_kept") if keep else F.lit(None).alias("_kept"),
    )
    text = F.col("_text")

    def joined(base: Column) -> Column:
        # Base spans are sorted by start: how far they cover a token without a break, from its start on.
        reach = lambda r: F.aggregate(base, r["start"], lambda a, b: F.when((b["start"] <= a) & (b["end"] > a), b["end"]).otherwise(a))
        both = lambda found: F.struct(
            base.alias("base"),
            F.sort_array(F.concat(base, F.filter(found, lambda r: reach(r) < r["end"]))).alias("spans"),
            F.size(found).cast("long").alias("n_random"),
        )
        return let(random_spans(text, model), both)

    src = src.select("_id", "_kept", F.explode(F.array(let(base_spans(text), joined))).alias("_s"))
    return src.select(
        *[F.col("_kept")[c].alias(c) for c in keep if c != id_col], F.col("_id").alias(id_col), F.col("_s.base").alias("base"), F.col("_s.spans").alias("spans"), F.col("_s.n_random").alias("n_random")
    )


def rendered(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced; overlapping spans are replaced as one."""

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        return F.struct(
            F.when(s["start"] >= a["at"], F.concat(a["out"], gap, F.lit(mark))).otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], s["end"]).alias("at"),
        )

    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    end = lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, end)).otherwise(text)
