"""The registered queries on the smallest tables, against SQL or plain Python."""

import base64
import glob
import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import pyarrow.parquet as pq

from palimpsest.llm import bpe, licenses, sharding  # noqa: F401
from palimpsest.llm.common import vocabulary
from palimpsest.llm.queries import ORACLE_SQL, QUERIES

from .test_native import jump, secret_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


def run(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    return {r["doc_id"]: r for r in rows} if "doc_id" in rows[0] and name != "op2_best_fit_packing" else rows


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    found = c.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = sorted(tuple(str(r[names.index(k)]) for k in cols) for r in found.fetchall())
    assert sorted(tuple(str(r[k]) for k in cols) for r in df.collect()) == want


def test_op1(spark, documents):
    got = run(spark, "op1_license_scan")
    assert got.keys() == documents.keys()
    lower = str.maketrans(licenses.UPPER, licenses.LOWER)
    for i, t in documents.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(lower))
        hits = sorted((k, x) for p, x in licenses.BASE for k in range(len(words)) if words[k : k + len(p.split())] == p.split())
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(hits))
        assert (r["first_word"], r["last_word"]) == ((hits[0][0], hits[-1][0]) if hits else (None, None))
        base = sorted({x for _, x in hits})
        assert r["base_labels"] == ",".join(base) and set(base) <= set(filter(None, r["labels"].split(",")))
        assert r["labels"] == ",".join(sorted(set(filter(None, r["labels"].split(","))))) and 0 <= r["score"] <= 1


def test_op2(spark, documents):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    bins, total, seen = {}, 0, 0
    for r in run(spark, "op2_best_fit_packing"):
        ids = np.array([*coder.encode(documents[r["doc_id"]], add_special_tokens=False).ids, 0], "<u4")
        part = ids[r["start"] : r["start"] + 2048]
        assert r["start"] == 2048 * r["piece"] and r["length"] == len(part) and r["ids_crc32"] == zlib.crc32(part.tobytes())
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        total, seen = total + len(part), seen + (r["start"] + len(part) == len(ids))
    assert seen == len(documents)
    for own in bins.values():
        at = 0
        for off, n in sorted(own):
            assert off == at
            at += n
        assert at <= 2048
    assert len(bins) <= -(-total // 2048) + 1


def test_op4(spark, documents):
    got, slots = run(spark, "op4_jump_shards"), {}
    assert got.keys() == documents.keys()
    for i, t in documents.items():
        r = got[i]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(t.encode()) + 16, zlib.crc32(t.encode()), "key")
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    keys = {r["doc_id"]: r["k"] for r in spark.createDataFrame([(i,) for i in documents], "doc_id long").selectExpr("doc_id", "xxhash64(doc_id) AS k").collect()}
    assert all(got[i]["shard"] == jump(keys[i] % 2**64, 40) and got[i]["grown_shard"] == jump(keys[i] % 2**64, 41) for i in documents)


def test_op5(spark, documents):
    got = run(spark, "op5_secret_scan")
    assert got.keys() == documents.keys()
    for i, t in documents.items():
        spans = secret_spans(t)
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        r = got[i]
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert ",".join(x for x in r["spans"].split(",") if not x.startswith("random")) == text


def test_op6(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    got = {r["page_id"]: r for r in run(spark, "op6_warc_salvage")}
    assert got.keys() == pages.keys()
    for i, data in pages.items():
        refers = first[data] if first[data] != i else None
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert tuple(got[i]) == (i, len(data), digest, "response" if refers is None else "revisit", refers)


def test_op9(spark, documents):
    import tiktoken

    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(vocabulary("byte_bpe_50k.tiktoken")), special_tokens={})
    got = run(spark, "op9_byte_bpe")
    assert got.keys() == documents.keys()
    for i, t in documents.items():
        ids = coder.encode_ordinary(t)
        want = (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        assert tuple(got[i]) == want


def test_pipeline(spark, documents):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    left = {r["doc_id"] for r in rows}
    assert left <= documents.keys() and 0.3 * len(documents) < len(left) < len(documents)
    assert all(r["offset"] + r["length"] <= corpus_pipeline.SEQUENCE for r in rows)
