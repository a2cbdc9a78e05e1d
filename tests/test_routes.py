"""Routes, predicates and listings against written results."""

from pyspark.sql import functions as F

from palimpsest.functions import routes
from palimpsest.operators import listing, reconcile, rollups


def of(spark, rows, schema, *columns):
    got = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema).select("i", *columns).orderBy("i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in got]


def test_routes(spark):
    sets = {"a": ["py", "c"], "b": ["c", "txt"], "none": []}
    assert of(spark, [("py",), ("c",), ("txt",), ("",), (None,), ("zz",)], "e string", routes.route_of(F.col("e"), sets)) == ["a", "a", "b", "no_extension", "no_extension", "other"]
    assert of(spark, [("py",), ("csv",), ("",)], "e string", routes.group_of(F.col("e"), ["py"], ["csv"])) == ["text", "binary", "other"]


def test_signatures(spark):
    cases = [(b"", "empty"), (b"MZ\0", "program (MZ)"), (b"PK\x03\x04", "zip"), (b"PK", "text-like"), (b"\x7fELF\0", "elf program"), (b"SQLite format 3\0", "sqlite"), (b"\xef\xbb\xbfx", "utf-8 bom text"),
             (b"plain", "text-like"), (b"a\0", "other binary"), (b"x" * 4096 + b"\0", "text-like"), (b"\xff\xfea\0", "utf-16 text"), (b"\x89PNG", "png")]
    assert of(spark, [(bytearray(x),) for x, _ in cases], "b binary", routes.signature(F.col("b"))) == [y for _, y in cases]


def test_type_and_inner(spark):
    cases = {"a/b.txt": ("txt", "-"), "a/b.tar.TMP": ("tmp", "tar"), "x.db_backup": ("db_backup", "-"), "q.Dll.v3.deploy": ("deploy", "dll"), ".hidden.out": ("out", "-"), "a.b.thirteenchars.out": ("out", "-"), "d.x/plain": ("x/plain", "-"), "a.sql.v12.dump": ("dump", "sql")}
    assert of(spark, [(k,) for k in cases], "p string", routes.type_and_inner(F.col("p"))) == list(cases.values())


def test_predicates(spark):
    rows = [("h", ""), ("h", " "), ("", ""), ("h", "bad"), (None, None)]
    assert of(spark, rows, "h string, e string", routes.usable(F.col("h"), F.col("e"))) == [True, True, False, False, False]
    rows = [("written", "x", "zip", 5), ("written", "x", "zip", 4), ("written", "x", "pkl", 0), ("written", "", "pkl", 0), ("failed", "x", "pkl", 0), ("in_stored", "x", "txt", 9), (None, None, None, None)]
    closed = routes.still_closed(*[F.col(c) for c in "aped"], ["zip", "pkl"], ["zip"], 5)
    assert of(spark, rows, "a string, p string, e string, d int", closed) == [True, False, True, False, False, False, False]
    assert of(spark, [("ok",), ("bad",), (None,)], "s string", routes.included(F.col("s"), "ok, only_git_listed,")) == [True, False, False]


def test_simple_path(spark):
    cases = {"AllRepos\\org\\Repo\\a\\b.py": "a/b.py", "a//./b": "a/b", "org/repo": "", "x/org/repo/y/org/repo/z": "y/org/repo/z", " /top/ ": "top", "": "", "orgs/repo/a": "orgs/repo/a"}
    assert of(spark, [(k,) for k in cases], "p string", routes.simple_path(F.lit("Org"), F.lit("repo"), F.col("p"))) == list(cases.values())


def test_scanner_rows(spark):
    blob = "a" * 40
    cases = [("F" * 40 + ".zip", "x", ("whole file", "f" * 40 + ".zip")), ("inner.txt", f"d\\{blob}.zip\\inner.txt", ("inside a whole file", f"{blob}.zip")), ("G45_x", "p", ("group 4.5 text (G45_ name)", "")), ("n", "a/group5_group4_5/n", ("group 4.5 text (G45_ name)", "")), ("b" * 41 + ".x", "p", ("other (not a whole-file delivery)", ""))]
    assert of(spark, [c[:2] for c in cases], "n string, p string", routes.scanner_kind(F.col("n"), F.col("p"))) == [c[2] for c in cases]
    got = of(spark, [("z_diff_analysis_p1_group2_079d0fcaa8da1e63\\x",), ("diff_analysis_p1_a_b_079d0fcaa8da1e63",), ("none",)], "p string", routes.delivery(F.col("p")))
    assert got == ["group2", "a_b", ""]


def test_listings(spark):
    names = ["file:/r/o/a/x.py", "file:/r/o/a/.git/HEAD", "file:///r/o/a/sub/.git/x.py", "/r/o/a/git/y.PY", "/r/o/b/HEAD", "/r/o/b/objects/pack/p.pack", "/r/o/c/z.md", "/r/o/top", "/other/o/a/x.py", "/r/o/d/.git"]
    files = listing.below(spark.createDataFrame([(n,) for n in names], "path string"), "/r/")
    assert sorted(tuple(r) for r in listing.repositories(files).collect()) == [("o", "a", "worktree"), ("o", "b", "bare"), ("o", "d", "worktree")]
    got = listing.active_files(files, ["py"]).select("repo", "path").collect()
    assert sorted(tuple(r) for r in got) == [("a", "git/y.PY"), ("a", "x.py")]
    rows = spark.createDataFrame([("u", "a/b/c.txt"), ("u", "top")], "unit string, path string")
    assert sorted(tuple(r) for r in listing.inventory(rows, ["unit"]).collect()) == [("u", "", "top"), ("u", "a/b", "c.txt")]


def test_many_places(spark):
    """Names in 1500 places: no bound."""
    places = spark.range(1500).select(F.concat(F.lit("p"), "id").alias("place"), F.when(F.col("id") % 2 == 0, "Repo-1").otherwise("repo_x").alias("name"))
    got = reconcile.lookup_places(spark.createDataFrame([("Repo-1",), ("repo1",), ("no",)], "repo string"), "repo", places.unionByName(places.limit(1).withColumn("place", F.lit(None).cast("string"))))
    found = {(r["repo"], r["found"]): r["count"] for r in got.groupBy("repo", "found").count().collect()}
    assert found == {("Repo-1", "exact"): 750, ("Repo-1", "missing"): 750, ("repo1", "fuzzy"): 750, ("repo1", "missing"): 750, ("no", "missing"): 1500}


def test_running_counts_and_totals(spark):
    values = [-7, -7, -1, 0, 0, 0, 3, 1000, 1001, 10**12, None]
    df = spark.createDataFrame([(g, v) for g in ("a", None) for v in values], "g string, v long")
    rows = rollups.running_counts(df, ["g"], "v").collect()
    for g in ("a", None):
        own = sorted((r for r in rows if r["g"] == g), key=lambda r: r["_upto"])
        assert [(r["v"], r["_n"], r["_upto"], r["_all"]) for r in own] == [(None, 1, 1, 11), (-7, 2, 3, 11), (-1, 1, 4, 11), (0, 3, 7, 11), (3, 1, 8, 11), (1000, 1, 9, 11), (1001, 1, 10, 11), (10**12, 1, 11, 11)]
    got = rollups.with_totals(df, "g", {"s": F.col("v")}, {"d": F.col("v"), "e": F.col("v") % 2}).collect()
    assert sorted((str(r["g"]), r["d"], r["e"]) for r in got) == [("None", 7, 3), ("a", 7, 3), ("total", 7, 3)] and {r["s"] for r in got} == {sum(v or 0 for v in values), 2 * sum(v or 0 for v in values)}
