"""Near duplicates, repeated passages and the pipeline, against plain versions."""

import os
import random
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from palimpsest.llm import neardup, substrings  # noqa: E402
from palimpsest.llm.common import Scratch  # noqa: E402
from palimpsest.llm.components import connected_components  # noqa: E402

from .conftest import SCHEMA  # noqa: E402


@pytest.fixture(scope="module")
def copies():
    """(id, text): a star of near copies, copies of copies, parts of one text, a shared passage, exact copies, short texts."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 6)))
    base = [word() for _ in range(150)]

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[rnd.randrange(len(words))] = word()
        return words

    texts = [" ".join(edited(base, rnd.randint(1, 6))) for _ in range(120)]
    far = edited(base, 12)
    texts += [" ".join(edited(far, rnd.randint(0, 2))) for _ in range(30)]
    texts += [" ".join(base[: 150 - 3 * k]) for k in range(20)]
    texts += [" ".join(base)] * 25
    passage = [word() for _ in range(60)]
    texts += [" ".join([word() for _ in range(rnd.randint(10, 90))] + passage + [word() for _ in range(30)]) for _ in range(60)]
    texts += ["one two", "ONE two", "one\ntwo", "three", "", None, " ", "a b c d e", "A b c D e", "a b c d e f"]
    texts += [" ".join(passage * 3), " ".join(base) + "\n" + " ".join(passage), " ".join(word() for _ in range(20000))]
    rnd.shuffle(texts)
    return list(enumerate(texts, 100))


def frame(spark, rows):
    rows = [(i, t, "en", "s", 0, "clash", "clash", 7) for i, t in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("small", [32, 8])
def test_near_duplicates(spark, copies, small):
    df = frame(spark, [*copies, (None, copies[0][1]), copies[3]])
    got = neardup.near_duplicates(df, 85, 5, small=small).collect()
    want = brute.components(copies)
    assert len(got) == len(copies) + 2
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["component_id"] == r["doc_id"])


@pytest.fixture
def one_key(monkeypatch):
    """All documents meet under one key, so that only pivots can lose a pair."""
    monkeypatch.setattr(neardup, "index_keys", lambda sig: F.array(F.lit(0).cast("long")))


def alike(rows):
    """Components by brute force on sets of single words."""
    return brute.components(rows, 85, 1)


@pytest.mark.parametrize("small", [32, 8])
def test_near_duplicates_through_one_linked_to_the_pivot(spark, one_key, small):
    """A large document is linked to a smaller one, which lies in the pivot, and not to the pivot; nothing outside the pivot is shared."""
    rnd = random.Random(6)
    texts = []
    for f in range(3):
        word = [f"f{f}w{k}" for k in range(100)]
        texts += [word, word[:89], word[:87] + [f"f{f}far{k}" for k in range(13)]]
        for c in range(60):
            gone = set(rnd.sample(range(87), 6))
            texts.append([f"f{f}c{c}n{k}" if k in gone else w for k, w in enumerate(word)])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = alike(rows)
    assert len({c for _, c in want.values()}) == 3
    got = neardup.near_duplicates(frame(spark, rows), 85, 1, small=small).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


@pytest.mark.parametrize("percent, seed", [(85, 1), (80, 2)])
def test_similar_pairs_meet_again_after_a_round(spark, monkeypatch, percent, seed):
    """Sets of many sizes, with losses and gains of their own and shared ones, most of them near the threshold to the pivot and to each other."""
    monkeypatch.setattr(neardup, "SPREAD", 5)
    rnd = random.Random(seed)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for i in range(150):
        keep = rnd.sample(base, rnd.choice([60, 57, 54, 52, 50, 45]))
        gains = [f"g{rnd.randrange(25)}" for _ in range(rnd.choice([0, 0, 2, 4, 6, 9]))] + [f"own{i}x{k}" for k in range(rnd.choice([0, 0, 0, 3, 6]))]
        rows.append((i, " ".join(keep + gains)))
    bags = {i: set(t.split()) for i, t in rows}
    similar = lambda x, y: 100 * len(bags[x] & bags[y]) >= percent * len(bags[x] | bags[y])
    hold = Scratch(spark)
    sets = hold.put("sets", neardup.by_rarity(neardup.full_sets(frame(spark, rows), 1)))
    groups = sets.select(F.lit(0).cast("long").alias("g"), "x", "n", F.col("x").alias("of"), F.col("often").alias("k"))
    rel = neardup._compared(groups, sets, percent, hold)
    compared = rel.collect()
    (b,) = {r["b"] for r in compared}
    linked = {r["x"] for r in compared if r["linked"]}
    assert {r["x"] for r in compared} == bags.keys() - {b} and linked == {x for x in bags if x != b and similar(x, b)}
    meet = {}
    for r in neardup._children(rel.withColumn("of", F.col("x")), percent, hold).collect():
        meet.setdefault(r["x"], set()).add(r["g"])
    pairs = [(x, y) for x in bags for y in bags if x < y and b not in (x, y) and similar(x, y) and not {x, y} <= linked]
    assert len(pairs) > 100 and all(meet[x] & meet[y] for x, y in pairs)
    hold.drop()


def test_near_duplicates_between_two_pivots(spark, one_key):
    """One document is linked to the first pivot, another to the second, and the only link between the pivots is theirs."""
    texts = [[f"w{k}" for k in range(8 * i, 8 * i + 100)] for i in range(4)]
    # The first 8 words and the last 16 become frequent, which makes the first and the last text pivots.
    for c in range(60):
        texts.append([f"w{k}" for k in range(8)] + [f"a{c}x{k}" for k in range(92)])
    for c in range(10):
        texts.append([f"w{k}" for k in range(108, 124)] + [f"b{c}x{k}" for k in range(84)])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = alike(rows)
    assert [want[i][1] for i in range(4)] == [0] * 4 and len({c for _, c in want.values()}) == 71
    got = neardup.near_duplicates(frame(spark, rows), 85, 1, small=1, split=1).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_near_duplicates_of_awkward_texts(docs, texts, no_docs):
    want = brute.components([(i * 3, t) for i, t in enumerate(texts)], 85)
    got = neardup.near_duplicates(docs, 85).where("doc_id IS NOT NULL").collect()
    assert all((r["n_shingles"], r["component_id"]) == want[r["doc_id"]] for r in got) and len(got) == len(texts) + 1
    assert neardup.near_duplicates(no_docs).count() == 0


def test_signatures_meet_within_the_distance():
    """Any signature up to 11 symbols away shares a key: each chunk is indexed with each position left out."""
    rnd = random.Random(0)
    keys = lambda s: {(c, p, tuple(x for q, x in enumerate(s[c]) if q != p)) for c in range(neardup.CHUNKS) for p in range(neardup.WIDTH)}
    for _ in range(300):
        a = [[rnd.randrange(65536) for _ in range(neardup.WIDTH)] for _ in range(neardup.CHUNKS)]
        b = [list(c) for c in a]
        for place in rnd.sample(range(neardup.POSITIONS), neardup.CHUNKS * (neardup.ERRORS + 1) - 1):
            b[place // neardup.WIDTH][place % neardup.WIDTH] ^= 1
        assert keys(a) & keys(b)


def test_parities_rule_out_no_similar_pair():
    rnd = np.random.default_rng(5)
    pairs = []
    for size in (1, 2, 30, 300, 5000):
        for gone in (0, 1, size // 20, size // 10, size // 3):
            a = rnd.integers(-(1 << 63), (1 << 63) - 1, size)
            pairs.append((a, np.concatenate([a[gone:], rnd.integers(-(1 << 63), (1 << 63) - 1, gone)])))
    flat = [s for pair in pairs for s in pair]
    bits = neardup.parities(np.concatenate(flat), np.repeat(np.arange(len(flat)), [len(s) for s in flat]), len(flat))
    ruled_out = 0
    for k, (a, b) in enumerate(pairs):
        apart = int(np.bitwise_count((bits[2 * k] ^ bits[2 * k + 1]).view(np.uint64)).sum())
        assert apart <= len(set(a.tolist()) ^ set(b.tolist()))
        ruled_out += 185 * apart > 15 * (len(a) + len(b))
    assert ruled_out >= 5


def test_one_component_with_few_others_takes_no_further_round(spark, monkeypatch):
    """A group that is too large to be listed as a whole: near copies of a text, and longer and shorter ones that are not linked to it."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 6)))
    base = [word() for _ in range(200)]
    texts = [" ".join(base[:at] + [word()] + base[at + 1 :]) for at in range(5, 65)]
    texts += [" ".join(base[: 200 - 6 * k]) for k in range(1, 12)]
    rows = list(enumerate(texts))
    rounds, compared = [], neardup._compared
    monkeypatch.setattr(neardup, "_compared", lambda *args: rounds.append(1) or compared(*args))
    got = neardup.near_duplicates(frame(spark, rows), 85, 5, small=4, split=24).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.components(rows)
    assert len(rounds) == 1


def test_components(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(1, 50)] + [(rnd.randrange(200, 400), rnd.randrange(200, 400)) for _ in range(120)] + [(7, 7), (None, 3), (5, 6)]
    parent = {x: x for e in links for x in e if x is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    alone = {7} - {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in parent if x not in alone}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_subtree_equals_a_plain_one():
    """Internal nodes: prefixes of two rows or more behind which these go on in different ways, or end."""
    rnd = random.Random(8)
    for n, size, letters in [(0, 3, 2), (1, 3, 2), (2, 4, 1), (40, 5, 2), (300, 7, 3), (500, 7, 2), (60, 1, 4)]:
        rows = [[rnd.randrange(letters) - 1 for _ in range(size)] for _ in range(n)]
        want = set()
        for depth in range(1, size + 1):
            for prefix in {tuple(r[:depth]) for r in rows}:
                under = [i for i, r in enumerate(rows) if tuple(r[:depth]) == prefix]
                if len(under) > 1 and (depth == size or len({tuple(rows[i][: depth + 1]) for i in under}) > 1):
                    want.add((depth, frozenset(under)))
        order, nodes = substrings.subtree(np.array(rows, dtype=np.int32).reshape(n, size))
        assert [rows[i] for i in order] == sorted(rows)
        got = {(d, frozenset(order[a : b + 1].tolist())) for d, first, last in nodes for a, b in zip(first, last)}
        assert got == want and all(d >= 4 for d, *_ in substrings.subtree(np.array(rows, dtype=np.int32).reshape(n, size), 4)[1])


@pytest.mark.parametrize("group", [4096, 20, 1])
def test_repeats(spark, copies, group):
    df = frame(spark, [*copies, (None, copies[0][1]), copies[3]])
    got = substrings.remove_repeats(df, 50, keep=["lang", "shard"], group=group).collect()
    want = brute.repeats(copies)
    texts = dict(copies)
    assert len(got) == len(copies) + 2
    for r in got:
        t = texts[r["doc_id"] if r["doc_id"] is not None else copies[0][0]] or ""
        w, gone = want[r["doc_id"]] if r["doc_id"] is not None else (re.findall(brute.WS, t), [False] * 10**5)
        left = [x for x, g in zip(w, gone) if not g]
        assert (r["n_words"], r["n_removed"]) == (len(w), len(w) - len(left))
        assert r["kept"] == " ".join(left) and re.findall(brute.WS, r["rest"]) == left
        assert r["rest"] == t or len(left) < len(w)
        assert [k for s in r["spans"] for k in range(s["start"], s["end"])] == [k for k, g in enumerate(gone[: len(w)]) if g]
        assert r["lang"] == "en" and r["shard"] == 7


def test_repeats_of_awkward_texts(docs, texts, no_docs):
    want = brute.repeats([(i * 3, t) for i, t in enumerate(texts)])
    got = substrings.remove_repeats(docs).where("doc_id IS NOT NULL").collect()
    assert len(got) == len(texts) + 1
    for r in got:
        w, gone = want[r["doc_id"]]
        assert r["kept"] == " ".join(x for x, g in zip(w, gone) if not g)
    assert substrings.remove_repeats(no_docs).count() == 0


def test_pipeline_stages(spark, docs, copies, no_docs):
    import corpus_pipeline as p

    from palimpsest.llm import quality, secrets

    rows = frame(spark, copies).unionByName(docs.where("doc_id IS NULL OR doc_id >= 60").withColumn("doc_id", F.col("doc_id") + 10000))
    stages = dict(p.STAGES)
    assert [n for n, _ in p.STAGES] == ["quality rules", "near-duplicate removal", "substring dedup", "secret scan", "best-fit packing"]
    first = stages["quality rules"](spark, rows, "").cache()
    assert first.columns == rows.columns
    good = {r["doc_id"] for r in quality.apply_policy(quality.ledger(rows)).where("kept").collect()}
    assert {r["doc_id"] for r in first.collect()} == good
    second = stages["near-duplicate removal"](spark, first, "").cache()
    comps = brute.components([(r["doc_id"], r["text"]) for r in first.collect() if r["doc_id"] is not None], 80)
    assert {r["doc_id"] for r in second.collect()} - {None} == {i for i, (_, c) in comps.items() if i == c}
    third = stages["substring dedup"](spark, second, "").cache()
    assert third.columns == rows.columns
    left = brute.repeats([(r["doc_id"], r["text"]) for r in second.collect() if r["doc_id"] is not None])
    want = {i: [x for x, g in zip(w, gone) if not g] for i, (w, gone) in left.items()}
    got = {r["doc_id"]: re.findall(brute.WS, r["text"]) for r in third.collect() if r["doc_id"] is not None}
    assert got == {i: w for i, w in want.items() if w}
    fourth = stages["secret scan"](spark, third, "").cache()
    assert fourth.columns == rows.columns and fourth.count() == third.count()
    model = secrets.train(secrets.labelled_samples(spark))
    assert secrets.scan(fourth, model).where("size(base) > 0").count() == 0
    last = stages["best-fit packing"](spark, fourth, "").collect()
    assert {r["doc_id"] for r in last} == {r["doc_id"] for r in fourth.collect()}
    for stage in (f for _, f in p.STAGES):
        assert stage(spark, no_docs, "").count() == 0
