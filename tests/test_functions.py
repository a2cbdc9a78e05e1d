"""Scalar functions on awkward values, each with its expected result."""

from pyspark.sql import functions as F

from palimpsest.functions import buckets, content, paths
from palimpsest.operators.lines import stripped


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(r,) for r in rows], f"x {kind}")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_extensions(spark):
    names = ["a/b/App.Config", ".gitignore", "Makefile", "a.tar.gz", "x.", "..", "a\\b.TXT", "dir.d/", "", None, ".a.b"]
    assert values(spark, paths.ext_key, names) == ["config", "gitignore", "", "gz", "", "", "txt", "d", "", "", "b"]
    assert values(spark, paths.ext_label, ["a.JAVA", ".env", "x", "", "x."]) == [".java", "(dotfile)", "(no extension)", "(blank)", "."]
    assert values(spark, paths.ext_or_none, ["a.JAVA", ".env", "x", "x."]) == ["java", "env", "(none)", ""]


def test_vendor_is_in_list_order(spark):
    rows = ["packages/x/bin/y", "bin/node_modules/y", "wwwroot/lib/x.js", "a/wwwroot/libs/x", "vendor", "src/a.c", "A/Dist/x"]
    assert values(spark, paths.vendor_of, rows) == ["packages", "node_modules", "wwwroot/lib", "", "", "", "dist"]


def test_full_path(spark):
    rows = [("./a/b", "c.txt"), ("x\\org1\\RepoA\\src\\c.txt", "c.txt"), ("org1/repoA", "f"), ("", "f"), ("a/b/", ""), ("/a", "a")]
    df = spark.createDataFrame(rows, "rel string, name string")
    got = [r[0] for r in df.select(paths.full_path(F.col("rel"), F.col("name"), F.lit("org1"), F.lit("repoA"))).collect()]
    assert got == ["a/b/c.txt", "src/c.txt", "f", "f", "a/b", "a"]


def test_steps_of_a_path_are_computed_once(spark):
    df = spark.createDataFrame([("a", "b", "o", "r")], "rel string, name string, org string, repo string")
    cols = [F.col(c) for c in df.columns]
    for column, most in ((paths.full_path(*cols), 10), (paths.candidates(*cols), 20)):
        plan = df.select(column)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace") <= most


def test_arguments_of_candidates_are_computed_once(spark):
    df = spark.createDataFrame([("a", "b", "o", "r")], "rel string, name string, org string, repo string")
    column = paths.candidates(*[F.soundex(c) for c in df.columns]).alias("c")
    assert df.select(column)._jdf.queryExecution().optimizedPlan().toString().count("soundex") == 4


def test_both_paths_of_candidates_share_their_steps(spark):
    df = spark.createDataFrame([("a", "b", "o", "r")], "rel string, name string, org string, repo string")
    column = paths.candidates(*[F.col(c) for c in df.columns]).alias("c")
    assert df.select(column)._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 3
    odd = [("\x0b ./ .//a\t", " b\x1c", [" ./a/b\x1c"]), ("\t\n", "\f", []), ("././/\\x/O\\R//c", None, ["c", "x/O/R/c"]), ("\u00a0a", "/", ["\u00a0a"]), ("r/", "r/c", ["r/r/c", "r/c"])]
    rows = spark.createDataFrame([(i, a, b, "o", "r") for i, (a, b, _) in enumerate(odd)], "i int, rel string, name string, org string, repo string")
    got = {r["i"]: r["c"] for r in rows.select("i", paths.candidates(*[F.col(c) for c in df.columns]).alias("c")).collect()}
    assert [got[i] for i in range(len(odd))] == [c for _, _, c in odd]


def test_paths(spark):
    assert values(spark, paths.ancestors, ["a/b/c", "c"]) == [[".", "a", "a/b"], ["."]]
    assert values(spark, paths.clean_path, ["a/../b", "./x//y", "..\\z"]) == ["a/_../b", "x/y", "_../z"]
    assert values(spark, paths.unbrace_rename, ["a/{b => c}/d", "a/{ => x}/d", "a/{x => }/d"]) == ["a/c/d", "a/x/d", "a/d"]
    assert values(spark, paths.file_class, ["a.py", "a.JSON", ".env", "README.md", "x.dll", "Makefile", "q.zzz"]) == ["code", "config/data", "no-ext", "doc", "binary", "no-ext", "other"]
    assert values(spark, paths.risky_name, ["a/.env", "a/.env.local", "Secrets", "x.PEM", "a/b.txt"]) == [True, True, True, True, False]
    assert values(spark, paths.left_out_reason, ["obj/.cache/build/x", "__MACOSX/a", "a/._b", "a/.DS_Store", "node_modules/x", "a"]) == ["docfx_cache", "macos", "macos", "macos", "vendored", ""]
    assert values(spark, lambda x: paths.fold_git(x, F.lit("")), ["a/b/.git", "a/.git (2)", ".git", "a"]) == [("a/b", True), ("a", True), (".git", False), ("a", False)]
    assert values(spark, paths.delivery_kind, ["binary/files/a/b", "binary/files/a.tmp.1", "binary/_state/x", "binary/manifest.csv", "text/_state/o/done.json", "text/a.txt", "reports/x", "z"]) == [
        "data", "leftover", "binary_state", "binary_manifest", "text_done_json", "data", "reports", "other"]
    assert values(spark, lambda x: paths.case_name(x, F.lit(2)), ["a/b.txt", "a/b"]) == ["a/b__case2.txt", "a/b__case2"]
    assert values(spark, paths.fuzzy, ["Repo_1-A"]) == ["repo1a"]


def test_buckets(spark):
    assert values(spark, lambda x: buckets.count_bucket(x, [0, 10, 50]), [0, 1, 10, 11, 51, None], "int") == ["0", "1-10", "1-10", "11-50", "51+", None]
    assert values(spark, lambda x: buckets.below(x, buckets.STALE), [0, 30, 5000], "int") == ["under a month", "1-3 months", "over 5 years"]
    assert values(spark, lambda x: buckets.up_to(x, buckets.VERSIONS, 0), [0, 1, 3, 60], "int") == [None, "1", "3-5", "50+"]
    assert values(spark, buckets.utc_seconds, ["1970-01-01T01:00:00+01:00", "x", None]) == [0, 0, 0]
    assert values(spark, lambda x: buckets.days_between(x, F.lit("2024-03-01T00:00:00Z")), ["2024-02-28T23:00:00Z", "x"]) == [2, None]
    assert values(spark, lambda x: buckets.crlf_shaped(F.lit(100), x), [100, 101, 150, 151], "int") == [False, True, True, False]


def test_strip_takes_all_white_space(spark):
    odd = ["  x ", "\x1c\x1dx\x1f", "\tx y\n", "　", "x​"]
    assert values(spark, stripped, odd) == [s.strip() for s in odd]


def test_contents(spark):
    import hashlib

    data = [b"", b"PK\x03\x04", b"\x1f\x8b\x08", b"a" * 257 + b"ustar", b"text\x00more", b"plain text\n"]
    df = spark.createDataFrame([(bytearray(d),) for d in data], "x binary")
    rows = df.select("x", content.detect(F.col("x")).alias("kind"), content.is_binary(F.col("x")).alias("bin"), *content.file_hashes(F.col("x"))).collect()
    assert [r["kind"] for r in rows] == ["", "zip", "gz", "tar", "", ""]
    assert [r["bin"] for r in rows] == [False, False, False, False, True, False]
    for r, d in zip(rows, data):
        assert r["git_blob"] == hashlib.sha1(b"blob %d\x00" % len(d) + d).hexdigest() and r["md5"] == hashlib.md5(d).hexdigest()
    stub = f"version https://git-lfs.github.com/spec/v1\noid sha256:{'a' * 64}\nsize 12345\n".encode()
    got = spark.createDataFrame([(bytearray(stub),), (bytearray(b"no"),)], "x binary").select(content.lfs_pointer(F.col("x"))).collect()
    assert tuple(got[0][0]) == ("a" * 64, 12345) and got[1][0] is None


def test_lineage(spark):
    from palimpsest.operators import lineage

    df = spark.createDataFrame([("a", "b", 1), ("b", "c", 5), ("x", "b", 7), ("b", "d", 9), ("q", "r", 3)], "old string, new string, ord long")
    got = {(r["old"], r["ord"]): r["name"] for r in lineage.current_names(df).collect()}
    assert got == {("a", 1): "c", ("b", 5): "c", ("x", 7): "d", ("b", 9): "d", ("q", 3): "r"}
    edges = spark.createDataFrame([(i, i - 1) for i in range(1, 40)] + [(100, 101)], "n long, p long")
    tips = spark.createDataFrame([(25,)], "n long")
    assert sorted(r[0] for r in lineage.reachable(tips, edges, "n", "p").collect()) == list(range(26))
