"""Samples, profiles of extensions, archives, object stores and steps."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import sampling, statistics


def md5(*keys):
    return hashlib.md5("|".join(["7", *["" if k is None else str(k) for k in keys]]).encode()).hexdigest()


@pytest.fixture(scope="module")
def drawn():
    rng = random.Random(5)
    rows = [("big", i % 3, i) for i in range(20000)] + [("few", u, i) for u in range(4) for i in range(3)] + [(None, 1, i) for i in range(9)]
    rows += [("wide", u, u * 10 + i) for u in range(500) for i in range(rng.randint(1, 4))]
    return rows


def test_bottom_k_is_that_of_a_sort(spark, drawn):
    rows = spark.createDataFrame(drawn, "g string, u int, k int").withColumn("by", sampling.draw(7, "k"))
    got = {}
    for r in sampling.bottom_k(rows, ["g"], "by", ["k", "u"], 10).collect():
        got.setdefault(r["g"], {})[r["place"]] = r["k"]
    for g in {r[0] for r in drawn}:
        want = [k for _, k in sorted((md5(k), k) for x, _, k in drawn if x == g)][:10]
        assert [got[g][p] for p in sorted(got[g])] == want


def test_few_rows_reach_the_ranking(spark, drawn):
    rows = spark.createDataFrame(drawn, "g string, u int, k int").withColumn("by", sampling.draw(7, "k"))
    counts = {r["g"]: r["count"] for r in sampling.near(rows, ["g"], "by", 10).groupBy("g").count().collect()}
    assert counts["few"] == 12 and counts[None] == 9 and 10 <= counts["big"] < 80 and 10 <= counts["wide"] < 80


def test_sample_takes_units_in_turn(spark, drawn):
    rows = spark.createDataFrame(drawn, "g string, u int, k int")
    got = {}
    for r in sampling.spread_sample(rows, ["g"], ["u"], ["k"], 10, 7).collect():
        got.setdefault(r["g"], {})[r["place"]] = (r["u"], r["k"])
    for g in {r[0] for r in drawn}:
        units = {}
        for x, u, k in drawn:
            if x == g:
                units.setdefault(u, []).append(k)
        order = sorted(units, key=lambda u: (md5(u), u))
        queues = {u: sorted(v, key=lambda k: (md5(k), k)) for u, v in units.items()}
        want = []
        while len(want) < 10 and any(queues.values()):
            want += [(u, queues[u].pop(0)) for u in order if queues[u]]
        assert [got[g][p] for p in sorted(got[g])] == want[:10]
    assert sampling.spread_sample(rows.limit(0), ["g"], ["u"], ["k"], 10, 7).count() == 0


def test_most_common_ranks_before_the_shuffle(spark):
    words = ["a"] * 5 + ["b"] * 5 + ["c"] * 2 + [None] * 9 + ["e"]
    rows = spark.createDataFrame([("x", w, i) for i, w in enumerate(words)] + [("y", None, 1)], "g string, w string, n int")
    out = sampling.most_common(rows, ["g"], {"words": F.col("w"), "odd": F.col("n") % 2}, 3)
    got = {r["g"]: (r["words"], r["odd"]) for r in out.collect()}
    assert got == {"x": ("a (5), b (5), c (2)", "0 (11), 1 (11)"), "y": ("", "1 (1)")}
    assert out._jdf.queryExecution().sparkPlan().toString().count("WindowGroupLimit") == 2  # within tasks, then over all


def test_profile(spark):
    files = [
        ("o", "r", "a/b/c/x.py", "py", True, True, ""), ("o", "r", "a/b/y.py", "py", True, False, "lib"), ("o", "s", "x.py", "py", True, None, ""), ("o", "s", "n.py", "py", False, True, ""),
        ("o", "s", "t", "", True, True, None),
    ]
    files = spark.createDataFrame(files, "org string, repo string, path string, ext string, in_history boolean, at_head boolean, vendored string")
    versions = spark.createDataFrame([("py", 10), ("py", 3), ("py", None), ("py", 4), ("py", 20)], "ext string, bytes long")
    got = {r["ext"]: r.asDict() for r in statistics.extension_research(files, versions, 2).collect()}
    assert got["py"] == {
        "ext": "py", "files_in_history": 3, "still_active": 1, "history_only": 1, "active_only": 1, "vendored": 1, "repos": 2, "versions": 5, "bytes": 37, "median_bytes": 7, "largest_bytes": 20,
        "top_repos": "o/r (2), o/s (2)", "top_folders": "(repo root) (2), a/b/ (2)", "top_names": "x.py (2), n.py (1)",
    }
    assert got[""]["versions"] == 0 and got[""]["bytes"] == 0 and got[""]["median_bytes"] is None
    assert statistics.extension_research(files.limit(0), versions.limit(0)).count() == 0


def test_sampled_contents(spark):
    versions = spark.createDataFrame([("x", "o", "r", f"p{i}", f"b{i}") for i in range(5)], "ext string, org string, repo string, path string, blob string")
    contents = [("b0", b"PK\x03\x04\x00\x01"), ("b1", b"plain words"), ("b1", b"plain words"), ("b2", b""), ("b3", None), ("other", b"x")]
    rows = statistics.sampled_versions(versions, spark.createDataFrame(contents, "blob string, content binary"), 9, 7).collect()
    got = {r["blob"]: (r["kind"], r["signature"], r["preview"]) for r in rows}
    assert got == {"b0": ("binary", "zip", ""), "b1": ("text", "text-like", "plain words"), "b2": ("empty", "empty", ""), "b3": ("not read", "", ""), "b4": ("not read", "", "")}
    assert sorted(r["place"] for r in rows) == [1, 2, 3, 4, 5]


MEMBERS = "org string, repo string, inner_path string, ext string, route string, action string, bytes long"
ARCHIVES = "org string, repo string, archive_path string, source string, status string, members long"


def test_archives(spark):
    members = [
        ("o", "r", "a.Py", "Py", "code", "written", 5), ("o", "r", "b.py", "py", "code", "deduped", 5), ("o", "s", "b.py", "py", "code", "failed", None), ("o", "s", "z.zip", "zip", "archive", "opened_nested", 9),
        ("o", "s", "", "py", "code", "written", 9), (None, "s", "x", None, None, "written", None), ("o", "s", None, "py", "code", "written", 9),
    ]
    archives = [
        ("o", "r", "a.ZIP", "version", "ok", 4), ("o", "r", "b.zip", "version", "failed: header", None), ("o", "r", "c.001", "version", "split_part", None), ("o", "r", "c.001", "split_set", "ok", 7),
        ("o", "q", "d.001", "split_set", "split_part", 1), ("o", "q", "e", None, None, None), ("o", "q", "f.tar", "version", "novel", 2),
    ]
    members, archives = spark.createDataFrame(members, MEMBERS), spark.createDataFrame(archives, ARCHIVES)
    by = {r["type"]: tuple(r)[1:] for r in statistics.members_by_type(members).collect()}
    assert by == {"py": ("code", 3, 1, 0.0, 1, 0, 2), "zip": ("archive", 0, 0, 0.0, 0, 1, 0), "_noext": (None, 1, 1, 0.0, 0, 0, 1), "total": (None, 4, 2, 0.0, 1, None, None)}
    kinds = {r["archive_type"]: tuple(r)[1:] for r in statistics.archives_by_type(archives, ["ok", "failed", "split_part"]).collect()}
    assert kinds == {"zip": (2, 4, 1, 1, 0, 0), "001": (1, 8, 0, 0, 1, 0), "": (1, 0, 0, 0, 0, 1), "tar": (1, 2, 0, 0, 0, 1)}
    assert sorted(r["archive_path"] for r in statistics.archive_problems(archives).collect()) == ["b.zip", "d.001", "e", "f.tar"]
    repos = {(r["org"], r["repo"]): tuple(r)[2:] for r in statistics.archives_by_repo(archives, members).collect()}
    assert repos == {("o", "r"): (3, 1, 11, 1, 1, 0, 0.0), ("o", "q"): (2, 0, 3, 0, 0, 0, 0.0), ("o", "s"): (0, 0, 0, 0, 0, 1, 0.0), (None, "s"): (0, 0, 0, 1, 0, 0, 0.0)}
    assert statistics.members_by_type(members.limit(0)).count() == 0 and statistics.archives_by_type(archives.limit(0), ["ok"]).count() == 0


def test_conservation(spark):
    inside = [("u", "a", "s1", "before"), ("u", "a", "s1", "after"), ("u", "a", "s2", "after"), ("w", "a", "s1", "after"), ("u", "b", "s3", "after")]
    files = [("a", "text", "before")] + [("a", "text", "after")] * 3 + [("c", "pkl", "after")]
    manifest = [("u", "a", "text", "x"), ("u", "a", "text", "x"), ("u", "a", "text", "y"), ("w", "a", "text", "x"), ("u", "c", "pkl", None)]
    changes = [("a", "text", "new"), ("a", "text", "new"), ("c", "pkl", "new"), ("d", "text", "gone")]
    args = [
        spark.createDataFrame(inside, "unit string, type string, sha string, side string"), spark.createDataFrame(files, "type string, step string, side string"),
        spark.createDataFrame(manifest, "unit string, type string, step string, output string"), spark.createDataFrame(changes, "type string, step string, status string"),
    ]
    handled = spark.createDataFrame([("e", "text")], "type string, step string")
    got = {(r["type"], r["step"]): tuple(r)[2:] for r in statistics.conservation(*args, handled).collect()}
    assert got == {
        ("a", "text"): (1, 3, 2, 2, 1, 3, 3, 2, 0, "ok"), ("b", ""): (0, 1, 1, 1, 0, 0, 0, 0, 0, "not processed"), ("c", "pkl"): (0, 0, 0, 0, 0, 1, None, 1, 0, "ok"),
        ("d", "text"): (0, 0, 0, 0, 0, 0, 0, 0, 1, "CHECK"), ("e", "text"): (0, 0, 0, 0, 0, 0, 0, 0, 0, "ok"),
    }
    assert statistics.conservation(*[a.limit(0) for a in args]).count() == 0


def test_scope_adds_up(spark):
    merged = spark.createDataFrame([("py", 3, 10), ("py", 1, 2), ("md", 1, 1)], "ext string, versions long, lines long")
    left = spark.createDataFrame([("py", "vendored", 2), ("c", "macos", 1), ("c", "novel", 4), ("c", None, 1)], "ext string, reason string, versions long")
    got = {r["ext"]: r.asDict() for r in statistics.scope(merged, left, ["lines"]).collect()}
    assert (got["py"]["scope_paths"], got["py"]["scope_files"], got["py"]["lines"]) == (3, 6, 12)
    assert (got["c"]["scope_paths"], got["c"]["left_other"], got["c"]["merged_paths"]) == (3, 2, 0)
    assert (got["total"]["scope_paths"], got["total"]["scope_files"], got["total"]["left_versions"]) == (7, 13, 8)
    empty = statistics.scope(merged.limit(0), left.limit(0), ["lines"]).collect()
    assert [(r["ext"], r["scope_paths"]) for r in empty] == [("total", 0)]


def test_object_stores(spark):
    rows = [("r", "1", "blob", 5, False), ("r", "1", "blob", 5, True), ("r", "2", "tree", 7, False), ("r", "3", None, None, True), ("r", "4", "commit", 2, True), (None, "5", "tag", 1, None)]
    got = {r["repo"]: r.asDict() for r in statistics.object_stores(spark.createDataFrame(rows, "repo string, object string, type string, bytes long, loose boolean")).collect()}
    r = got["r"]
    assert (r["packed_objects"], r["packed_bytes"], r["loose_objects"], r["loose_bytes"], r["loose_unparsed"], r["loose_blobs"], r["total_trees"]) == (1, 7, 3, 7, 1, 1, 1)
    assert got[None]["packed_tags"] == 1


def test_repacked(spark):
    schema = "repo string, rel string, bytes long"
    before = [("r", "pack/a.pack", 3000000), ("r", "pack/a.idx", 1), ("r", "ab/cd", 2000000), ("r", "info/x", 5), ("q", "ab/cd", 1)]
    after = [("r", "pack/b.pack", 4000000), ("n", "pack/b.pack", 1), ("n", "ab/cd", 1)]
    got = {r["repo"]: tuple(r)[1:] for r in statistics.repacked(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)).collect()}
    assert got == {"r": (5.0, 4.0, 1.0, 1, 1, 1, 0, "ok"), "q": (0.0, None, None, 0, None, 1, None, "not_run"), "n": (None, 0.0, None, None, 1, None, 1, "new")}


def test_mortality_and_locks(spark):
    rows = [("a/x.py", True, 1, 10, 1), ("a/y.py", False, 2, None, 1), ("z", False, 1, 1, None)]
    out = statistics.mortality(spark.createDataFrame(rows, "path string, alive boolean, commits long, chars long, lines long"))
    got = {(r["section"], r["keys"]): (r["files"], r["gone"], r["commits"], r["chars"], r["mortality"]) for r in out.collect()}
    assert got[("class", "code")] == (2, 1, 3, 10, 50) and got[("folder", "a")] == (2, 1, 3, 10, 50) and got[("folder", ".")] == (1, 1, 1, 1, 100) and got[("extension", "(none)")] == (1, 1, 1, 1, 100)
    files = spark.createDataFrame([("a/Yarn.lock", "lock", 2, 5, "lib"), ("yarn.lock", "lock", 1, 5, ""), ("k.pfx", "pfx", 1, 1, None)], "path string, ext string, versions long, bytes long, vendored string")
    assert [tuple(r) for r in statistics.lock_files(files).collect()] == [("yarn.lock", 2, 3, 10, 1)]
    assert [r["path"] for r in statistics.certificates(files).collect()] == ["k.pfx"]


def test_explained_counts(spark):
    files = [("o", "r", "node_modules/a", "x", False), ("o", "r", "a", "x", True), ("o", "r", "b", "x", None), ("o", "r", "c", "", True), ("o", "s", "c", "x", True)]
    kinds, gaps = statistics.explained_counts(spark.createDataFrame(files, "org string, repo string, path string, output string, at_head boolean"), spark.createDataFrame([("o", "r", 1), ("o", "t", 9)], "org string, repo string, listed long"))
    assert Counter({r["kind"]: r["files"] for r in kinds.collect()}) == Counter({"vendored, not at HEAD": 1, "own code, at HEAD": 2, "own code, HEAD unknown": 1})
    assert [tuple(r) for r in gaps.collect()] == [("o", "r", 3, 1, 1, 1, 1, 2)]
