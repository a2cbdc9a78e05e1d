"""Language identification, periodic runs and phrases, against plain versions and held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import languages, periods, phrases
from palimpsest.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """All runs by trying every period at every place."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(all(words[x] == words[x + d] for x in range(i, i + length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(out)


def plain_row(text, doc_id):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(kept))


def random_words(rnd):
    out = []
    for _ in range(rnd.randint(1, 8)):
        part = [rnd.choice("abcde"[: rnd.randint(1, 5)]) for _ in range(rnd.randint(1, 9))]
        out += part * rnd.choice([1, 1, 2, 4, 5, 9]) + part[: rnd.randint(0, len(part))]
    return out


@pytest.mark.parametrize("heavy, pairs", [(2, 1 << 20), (-1, 1 << 20), (0, 7), (2, 5)])
def test_runs(monkeypatch, heavy, pairs):
    monkeypatch.setattr(periods, "HEAVY", heavy)
    monkeypatch.setattr(periods, "PAIRS", pairs)
    rnd = random.Random(heavy * 31 + pairs)
    for _ in range(400):
        words = random_words(rnd)
        codes = np.unique(words, return_inverse=True)[1]
        assert periods.runs(codes) == plain_runs(words), words
        if len(words) >= 6:
            m = periods.lag_matches(codes)
            assert m.tolist() == [0, *[sum(a == b for a, b in zip(words, words[q:])) for q in range(1, len(words) // 4 + 1)]]


def test_long_runs_need_few_scans(monkeypatch):
    seen = []
    scan = periods.scan
    monkeypatch.setattr(periods, "scan", lambda codes, q: seen.append(q) or scan(codes, q))
    assert periods.runs(np.zeros(200_000, dtype=np.int64)) == [(0, 200_000, 1)] and seen == [1]
    rnd = np.random.default_rng(1)
    block = rnd.integers(0, 50, 3000)
    codes = np.concatenate([rnd.integers(0, 50, 7000), np.tile(block, 6), rnd.integers(50, 90, 5000)])
    s, length, q = max(periods.runs(codes), key=lambda r: r[1])
    assert q == 3000 and length >= 18_000 and s <= 7000 and 6000 not in seen


def test_periodic_runs(spark, docs, texts, no_docs):
    rows = periods.periodic_runs(docs, plant=True)
    rows = rows.withColumn("a", F.sha2(periods.rendered(), 256)).withColumn("b", F.sha2("collapsed", 256)).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        t = texts[r["doc_id"] // 3] if r["doc_id"] is not None else "a text without an id, twice over"
        if len(t or "") < 30_000:
            assert tuple(r[c] for c in ("n_runs", "start", "length", "period", "exponent_milli", "a", "b")) == plain_row(t, r["doc_id"])
    assert periods.periodic_runs(no_docs).count() == 0
    plain = {r["doc_id"]: r for r in periods.periodic_runs(docs).where("doc_id IS NOT NULL").collect()}
    lorem = plain[3 * texts.index("lorem ipsum " * 3000)]
    assert (lorem["n_runs"], lorem["length"], lorem["period"], lorem["collapsed"]) == (1, 6000, 2, "lorem ipsum")


def test_op12(spark):
    text = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = QUERIES["op12_periodic_runs"](spark, SF).collect()
    assert len(rows) == len(text) and any(r["n_runs"] for r in rows)
    for r in rows:
        if len(text[r["doc_id"]] or "") < 20_000:
            assert tuple(r)[1:] == plain_row(text[r["doc_id"]], r["doc_id"]), r["doc_id"]


def plain_grams(text):
    s = re.sub(r"[^\w]|[\d_]", " ", text.lower())
    s = " " + " ".join(s.split()) + " "
    return Counter(s[k : k + n] for n in languages.SIZES for k in range(len(s) - n + 1) if s[k : k + n] != " ")


def test_gram_counts():
    texts = ["", " ", "12 34", "a", "Ab, cd!", "x  y\n\nz", "Über naïve 日本語", "a1b", "...the end...", "𝒳 𝒴", "İI"]
    counts, has = languages.gram_counts(texts)
    assert has.tolist() == [False] * 3 + [True] * 8
    for t, c in zip(texts, counts, strict=True):
        want = plain_grams(t) if re.search(r"[^\W\d_]", t) else Counter()
        assert c.sum() == want.total() or "İ" in t, t
    alone = [languages.gram_counts([t])[0][0] for t in texts]
    assert all((a == b).all() for a, b in zip(alone, counts, strict=True))


def test_identify(spark, no_docs):
    rows = [(i, t, lang, lang) for i, (t, lang) in enumerate(
        [("the cat and the dog are in the house with the man", "en"), ("der Hund und die Katze sind in dem Haus mit dem Mann", "de"),
         ("le chien et le chat sont dans la maison avec un homme", "fr")] * 40)]
    rows += [(900, None, "en", ""), (901, "", "en", ""), (902, "12 !? 7", "de", ""), (903, "the dog", None, ""), (None, "die Katze", "xx", ""), (0, rows[0][1], "en", ""), (904, "καλημέρα κόσμε, τι κάνεις", None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = languages.identify(df).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    assert all(by[i][0]["lang_pred"] == rows[i][2] for i in range(120)) and len(by[0]) == 2
    assert all(by[i][0][2:] == ("und", 0.0, True) for i in (900, 901, 902))
    assert by[903][0]["lang_pred"] == "en" and by[None][0]["lang_pred"] == "de"  # xx is not learned: its id is null
    assert by[904][0]["rejected"] and by[904][0]["lang_pred"] in ("en", "de", "fr")
    assert languages.identify(no_docs).count() == 0
    nothing = languages.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}


def test_op11_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op11_nearest_centroid"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 300 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert sum(r["rejected"] for r in held) <= 0.03 * len(held)


def plain_collocations(rows, least, most, within, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        some = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in some.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        rows = []
        for p, a in some.items():
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            if not 100 * longer[p] >= within * a:
                rows.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("bits, remembered, chunk", [(16, 400_000, 1 << 16), (4, 50, 8)])
def test_collocations(spark, docs, texts, no_docs, monkeypatch, bits, remembered, chunk):
    """Also with so few buckets that hardly any are clear, and counts passed on early."""
    rnd = random.Random(8)
    line = lambda: rnd.choice(["the cat sat, on the mat", "New York city; new york", "a b c d e f", "Über Über!x", "one\ttwo  three\x0bfour", "q.r.s", "the the the the the", "日本 語 日本 語"])
    more = [("  ".join(line() for _ in range(rnd.randint(0, 25))), rnd.choice(["en", "de", None, "und", "é"])) for _ in range(120)]
    rows = [(r["text"], r["lang"]) for r in docs.collect()] + more
    df = spark.createDataFrame([(i, t, x, i, "clash") for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string, n long, phrase string").repartition(5)
    monkeypatch.setattr(phrases, "BITS_LEAST", bits)
    monkeypatch.setattr(phrases, "BITS_MOST", bits)
    for least, most, within, top in [(30, 4, 80, 2000), (5, 3, 50, 7)]:
        got = phrases.collocations(df, least, most, within, top).collect()
        assert sorted(map(tuple, got)) == plain_collocations(rows, least, most, within, top) and got
    assert phrases.collocations(no_docs).count() == 0


def test_counters_merge():
    c = phrases.Counters(17)
    c.add(np.array([5, 5, 70_000, 131_071]))
    c.add(np.arange(40_000), 200)
    c.add(np.arange(40_000), 200)
    (batch,) = c.batches()
    chunks, rows = batch.column(3).to_pylist(), batch.column(4).to_pylist()
    assert chunks == [0, 1] and len(rows[0]) == phrases.CHUNK and len(rows[1]) == 6 and max(rows[0]) == 255
