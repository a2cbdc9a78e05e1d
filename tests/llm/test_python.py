"""Operators that run Python in tasks, against plain versions."""

import base64
import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import bpe, packing, topk, warc
from palimpsest.llm.common import vocabulary

RANKS = vocabulary("byte_bpe_50k.tiktoken")


def text_of(r, texts):
    return (texts[r["doc_id"] // 3] or "") if r["doc_id"] is not None else "a text without an id, twice over"


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def test_bpe_round_trip(docs, texts, no_docs, tiktoken_encoding):
    rows = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        t = text_of(r, texts)
        assert np.frombuffer(r["ids"], "<u4").tolist() == tiktoken_encoding.encode_ordinary(t), t[:50]
        assert bytes(r["decoded"]) == t.encode() and r["n_tokens"] == len(r["ids"]) // 4
    assert bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_on_every_kind_of_character(tiktoken_encoding):
    ranks = bpe.load_ranks(RANKS)
    coder = bpe.Encoder(ranks, bpe.PerfectHash(list(ranks), list(ranks.values())), bpe.rust_spaces(public_tokenizers.PATTERN))
    rnd = random.Random(3)
    pool = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000] + list("𝒳😀‍漢한\U0001d7d8")
    texts = [f"a{c}b1{c} {c}  {c}\n{c}" for c in pool] + ["".join(rnd.choices(pool, k=300)) for _ in range(50)]
    wrong = [t for t, ids in zip(texts, coder.encode(texts)) if ids.tolist() != tiktoken_encoding.encode_ordinary(t)]
    assert not wrong, [ascii(t) for t in wrong[:10]]


def test_perfect_hash_is_minimal_and_misses():
    keys = [str(i).encode() * (i % 5 + 1) for i in range(3000)] + [b"x" * 9000]
    keys = sorted(set(keys))
    table = bpe.PerfectHash(keys, list(range(len(keys))))
    assert table.lookup(keys).tolist() == list(range(len(keys))) and len(table.values) == len(keys)
    assert (table.lookup([b"no", b"99999999999", b"x" * 8999]) == -1).all()


def test_memory_is_bounded(monkeypatch, tiktoken_encoding):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    ranks = bpe.load_ranks(RANKS)
    coder = bpe.Encoder(ranks, bpe.PerfectHash(list(ranks), list(ranks.values())), public_tokenizers.PATTERN)
    for t in ("one two three four five six seven", "eight nine one", "two ten"):
        assert coder.encode([t])[0].tolist() == tiktoken_encoding.encode_ordinary(t)


def test_pieces(docs, texts, no_docs):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    coder = Tokenizer.from_file(path)
    rows = packing.pieces(docs, path).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(by) == len(texts) + 1
    for i, own in by.items():
        t = text_of(own[0], texts)
        want = [*coder.encode(t, add_special_tokens=False).ids, 0]
        copies = 2 if i == 60 else 1
        own = sorted(own, key=lambda r: r["piece"])[::copies]
        assert [r["start"] for r in own] == [2048 * k for k in range(len(own))]
        assert [x for r in own for x in np.frombuffer(r["ids"], "<u4").tolist()] == want
        assert all(r["length"] == len(r["ids"]) // 4 for r in own)
    assert packing.pieces(no_docs, path).count() == 0


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for off, n in sorted(own):
            assert off == at
            at += n
        assert at <= capacity.tokens and len(own) <= capacity.documents and sum(n * n for _, n in own) <= capacity.attention
    return len(bins)


def test_packing(spark):
    rnd = random.Random(1)
    lengths = [rnd.choice([2048, 2048, rnd.randint(1, 2048), rnd.randint(1, 300), 7]) for _ in range(3000)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long").repartition(5)
    for capacity, rule in (
        (packing.Capacity(), "norm"),
        (packing.Capacity(), "dot"),
        (packing.Capacity(2048, 3, 2048**2), "norm"),
        (packing.Capacity(2048, 50, 2048**2 + 10), "dot"),
    ):
        rows = packing.pack(df, capacity, ["id"], rule=rule).collect()
        assert Counter((r["id"], r["length"]) for r in rows) == Counter(enumerate(lengths))
        n = check_packing(rows, capacity)
        if capacity.documents >= 2048:
            assert n <= -(-sum(lengths) // 2048) * 1.01 + 1
    assert packing.pack(df.limit(0), packing.Capacity(), ["id"]).count() == 0


def test_plan_equals_one_item_at_a_time():
    rnd = random.Random(2)
    for trial in range(20):
        cap = packing.Capacity(100, rnd.choice([3, 5, 100]), rnd.choice([10000, 6000 + 4000]))
        lengths = sorted((rnd.randint(1, 100) for _ in range(200)), reverse=True)
        bins = []
        for n in lengths:
            item = (n, 1, n * n)
            fits = [b for b in bins if all(b[k] >= item[k] for k in range(3))]
            if fits:
                best = min(fits, key=lambda b: sum(w * ((b[k] - item[k]) / c) ** 2 for k, (w, c) in enumerate(zip((1.0, 0.05, 0.05), cap.vector()))))
            else:
                best = list(cap.vector())
                bins.append(best)
            for k in range(3):
                best[k] -= item[k]
        table = packing.plan(Counter(lengths), cap)
        got = {b for _, _, items, first, each, _ in table.tolist() for b in range(first, first + -(-items // each))}
        assert len(got) == len(bins)


@pytest.fixture(scope="module")
def pages(spark):
    same = "<p>same</p>"
    rows = [(i, f"http://x/{i}", same if i % 3 == 0 else f"<p>{i} é</p>" * (i + 1), "extra", 1) for i in range(40)]
    rows += [(40, None, None, "", 1), (41, "a b\nc", "", "", 1), (None, "u", same, "", 1), (42, "big", "y" * 700000, "", 1), (3, "http://x/3", same, "", 1)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, path string, kind int").repartition(3)


def test_warc_round_trip(spark, pages):
    want = []
    first = {}
    all_rows = pages.collect()
    for r in sorted(all_rows, key=lambda r: (r["page_id"] is None, r["page_id"] or 0)):
        if r["page_id"] is not None:
            first.setdefault(r["html"] or "", r["page_id"])
    for r in all_rows:
        data = (r["html"] or "").encode()
        refers = first.get(r["html"] or "") if r["page_id"] is not None and first[r["html"] or ""] != r["page_id"] else None
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((r["page_id"], len(data), digest, "revisit" if refers is not None else "response", refers))
    rows = warc.round_trip(pages)
    got = [tuple(r) for r in rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert Counter(got) == Counter(want)
    assert rows.where("kind = 'gap'").count() == 0
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("compress", [True, False])
def test_salvage_after_damage(spark, tmp_path, compress):
    rnd = random.Random(9)
    parts = []
    for i in range(60):
        body = bytes(rnd.randrange(256) for _ in range(rnd.randint(0, 3000))) + (b"\r\n\r\nWARC/1.0\r\nfake" if i % 7 == 0 else b"")
        data = warc.record(i, "u", body)
        parts.append(warc.gzipped(data) if compress else data)
    starts = np.cumsum([0, *map(len, parts)])
    data = bytearray(b"".join(parts))
    for i in (4, 20, 21, 40):
        data[starts[i] + len(parts[i]) // 2] ^= 0xFF
    data = bytes(data[: starts[59] + 100])  # and the last record is cut short
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "empty.warc").write_bytes(b"")
    (tmp_path / "junk.warc").write_bytes(b"junk \x1f\x8b\x08 WARC/1.0 junk")
    df = spark.createDataFrame([(str(tmp_path / n),) for n in ("a.warc", "empty.warc", "junk.warc")] + [(None,)], "path string")
    rows = warc.read_archives(df, payload=True).collect()
    main = [r for r in rows if r["path"].endswith("a.warc")]
    assert sorted(r["page_id"] for r in main if r["kind"] == "record") == [i for i in range(59) if i not in (4, 20, 21, 40)]
    gaps = sorted((r["start"], r["end"]) for r in main if r["kind"] == "gap")
    assert gaps == [(starts[4], starts[5]), (starts[20], starts[22]), (starts[40], starts[41]), (starts[59], len(data))]
    assert [(r["kind"], r["start"], r["end"]) for r in rows if r["path"].endswith("junk.warc")] == [("gap", 0, 22)]
    assert all(r["reason"] for r in rows if r["kind"] == "gap")


@pytest.mark.parametrize("cut", [False, True])
def test_salvage_within_a_member(cut):
    """One member with many records: those before and after a damaged one are recovered, also if the member is cut short."""
    rnd = random.Random(3)
    records = [warc.record(i, "u" * 10, bytes(rnd.randrange(256) for _ in range(2000))) for i in range(30)]
    raw = bytearray(b"".join(records))
    raw[sum(map(len, records[:10])) + 1000] ^= 0xFF
    data = warc.gzipped(bytes(raw))
    data = data[: len(data) * 2 // 3] if cut else data
    after = warc.gzipped(warc.record(99, None, b"next"))
    source = warc.Source(lambda start, n: (data + after)[start : start + n], len(data + after))
    rows = list(warc.salvage(source))
    ids = [int(r[3]["warc-record-id"].split(":")[-1][:-1]) for r in rows if r[0] == "record"]
    assert ids[:15] == [*range(10), *range(11, 16)] and ids[-1] == 99 and (len(ids) == 30 or cut)
    assert [r[1:3] for r in rows if r[0] == "gap"] == [(0, len(data))]


def test_salvage_of_long_headers_and_of_much_junk():
    long = warc.record(1, "x" * (5 << 20), b"body")
    junk = b"".join(warc.GZIP + b"\0" * 20 for _ in range(20000))  # a mark of one kind again and again, none of the other
    data = junk + long
    reads = []
    source = warc.Source(lambda start, n: (reads.append(n), data[start : start + n])[1], len(data))
    rows = list(warc.salvage(source))
    assert [r[:3] for r in rows] == [("gap", 0, len(junk)), ("record", len(junk), len(data))]
    assert sum(reads) < 40 * len(data)


def test_headers_have_no_bound():
    """A header of 70 MB, in a member and in a plain file; and one without an end before the next record."""
    long, short = warc.record(1, "x" * (70 << 20), b"body"), warc.record(2, "u", b"more")
    for data in (long + short, warc.gzipped(long) + warc.gzipped(short)):
        source = warc.Source(lambda start, n: data[start : start + n], len(data))
        rows = list(warc.salvage(source))
        assert [r[0] for r in rows] == ["record", "record"] and len(rows[0][3]["warc-target-uri"]) == 70 << 20
    data = b"WARC/1.1\r\nWARC-Type: response\r\nno end" + short
    rows = list(warc.salvage(warc.Source(lambda start, n: data[start : start + n], len(data))))
    assert [r[0] for r in rows] == ["gap", "record"]


def brute_topk(rows, k):
    """With Python's fractions and whole numbers only."""
    out = []
    good = {(i, tuple(math.floor(256 * Fraction(x)) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    for i, q in good:
        if i % 50 == 0:
            scored = sorted({(-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q)})[:k]
            out += [(i, r + 1, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("size", [1e5, 1e8, 1e12, 1e30, 1e300, 1.7e308])
def test_topk_with_large_components(spark, size):
    rnd = random.Random(11)
    rows = [(i, [rnd.uniform(-0.5, 0.5) for _ in range(64)]) for i in range(300)]
    for i in (0, 7, 50, 133, 200):
        rows[i][1][i % 64] = rnd.choice([size, -size])
        rows[i + 1][1][3] = size / 3
    rows += [(400, [size] * 64), (401, [size] * 64), (402, [-size] * 64), (403, [0.1] * 63 + [size])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    for sizes in ({}, {"candidates": 60, "queries": 4}):
        assert sorted(tuple(r) for r in topk.topk(df, F.col("vec_id") % 50 == 0, 5, **sizes).collect()) == brute_topk(rows, 5)


def test_sortable():
    numbers = [0, 1, -1, 255, 256, -255, -256, -257, 2**64, -(2**64), 10**600, -(10**600), 65535, -65536]
    assert sorted(numbers, key=topk.sortable) == sorted(numbers)


def test_topk(spark):
    rnd = random.Random(4)
    vec = lambda n=6: [rnd.uniform(-0.5, 0.5) for _ in range(n)]
    hot = vec()
    rows = [(i, hot if i % 3 == 0 else vec()) for i in range(700)]
    rows += [(700, None), (701, [None] * 6), (702, [float("nan")] * 6), (703, [float("inf")] + [0.0] * 5), (704, []), (750, [0.0] * 6), (800, vec(4)), (801, vec(4)), (None, vec()), (5, rows[5][1]), (850, [1e9] * 6), (851, [1e9] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"rank": F.lit(1), "score": F.lit("x")}).repartition(3)
    for sizes in ({}, {"candidates": 90, "queries": 4}):
        got = topk.topk(df, F.col("vec_id") % 50 == 0, 5, **sizes)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(tuple(r) for r in got.collect()) == brute_topk(rows, 5)
    assert topk.topk(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_threshold_stops_early():
    rng = np.random.default_rng(0)
    rows = rng.integers(-3, 4, size=(20000, 4))
    rows[17] = 100
    ids = np.arange(len(rows))
    found = topk.threshold_search(ids, rows, np.array([-1]), np.array([[1, 2, 3, 4]]), 1)
    assert found[1].tolist() == [17] and found[2] == [1000]
