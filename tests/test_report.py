"""Report sections from one scan."""

from pyspark.sql import functions as F

from palimpsest.operators import report, summary


def test_sections_from_one_scan(spark, tmp_path):
    rows = [("a", "x", "s1", 5), ("a", "x", "s1", 5), ("a", "y", "s1", 7), (None, "y", "s2", 1), ("b", None, None, 2)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "g string, h string, sha string, n long").write.parquet(path)
    df = spark.read.parquet(path)
    named = {"total": [], "g": ["g"], "g and h": ["g", "h"]}
    out = report.sections(df, named, {"files": F.lit(1), "n": F.col("n")}, "sha", "n")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
    got = {(r["section"], r["keys"]): tuple(r)[2:] for r in out.collect()}
    assert got == {
        ("total", ""): (5, 20, 2, 8), ("g", "a"): (3, 17, 1, 7), ("g", ""): (1, 1, 1, 1), ("g", "b"): (1, 2, 0, None),
        ("g and h", "a | x"): (2, 10, 1, 5), ("g and h", "a | y"): (1, 7, 1, 7), ("g and h", " | y"): (1, 1, 1, 1), ("g and h", "b | "): (1, 2, 0, None),
    }
    plain = {(r["section"], r["keys"]): r["files"] for r in report.sections(df, named, {"files": F.lit(1)}).collect()}
    assert plain == {k: v[0] for k, v in got.items()}
    assert report.sections(df.limit(0), {"g": ["g"]}, {"files": F.lit(1)}).count() == 0


def test_health_is_observed(spark):
    rows, health = report.observed(spark.range(100).select(F.when(F.col("id") % 10 == 0, "failed").otherwise("ok").alias("status")), "run", units=F.count("*"), failed=F.count_if(F.col("status") == "failed"))
    assert rows.where("status = 'ok'").count() == 90 and health() == {"units": 100, "failed": 10}


def test_cross_check(spark):
    a = spark.createDataFrame([("x", 1, 2.5), (None, 3, 1.0), ("only", 1, 1.0)], "k string, n long, v double")
    b = spark.createDataFrame([("x", 1, 2.25), (None, 3, 1.0), ("other", 1, 1.0)], "k string, n long, v double")
    got = {(r["k"], r["figure"]): r["same"] for r in report.cross_check(a, b, ["k"], ["n", "v"]).collect()}
    assert got == {("x", "n"): True, ("x", "v"): False, (None, "n"): True, (None, "v"): True, ("only", "n"): False, ("only", "v"): False, ("other", "n"): False, ("other", "v"): False}


def test_candidates_of_a_file_list_are_computed_once(spark):
    listed = [(1, "o", "r", "b a"), (2, "o", "r", "x now"), (3, "o", "r", "x y"), (4, "o", "r", None), (5, "o", "none", "a"), (6, "o", "old", "x a"), (7, "o", "new", "a")]
    df = spark.createDataFrame(listed, "id long, org string, repo string, names string")
    df = df.select("id", "org", "repo", F.coalesce(F.split(F.reverse(F.reverse("names")), " "), F.array().cast("array<string>")).alias("candidates"))
    records = spark.createDataFrame([("o", "r", "a", 3), ("o", "old", "a", 5)], "org string, repo string, path string, touched long")
    head = spark.createDataFrame([("o", "r", p) for p in ("a", "now", "now")] + [("o", "new", "z"), ("o", "none", "z")], "org string, repo string, path string")
    repos = spark.createDataFrame([("o", "r"), ("o", "r"), ("o", "old"), ("o", "new"), (None, None)], "org string, repo string")
    out = summary.listed_history(df, records, head, repos)
    assert "reverse(" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == [
        (1, "found", "a", True, 3), (2, "in_head_no_history", "now", True, None), (3, "not_found", "x", False, None), (4, "bad_row", None, None, None),
        (5, "repo_missing", None, None, None), (6, "found", "a", None, 5), (7, "not_found", "a", False, None),
    ]
