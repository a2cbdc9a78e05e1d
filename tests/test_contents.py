"""The content store across units."""

import random

from palimpsest.streaming import contents


def test_first_unit_owns(spark, tmp_path):
    """Units come out of order; the owner is the first unit, as if all had come at once."""
    rnd = random.Random(5)
    store, every = str(tmp_path / "store"), []
    for number in range(5):
        own = [(f"s{rnd.randrange(60)}", rnd.randrange(100), f"p{rnd.randrange(9)}") for _ in range(80)] + [(None, 1, "p")]
        every += own
        df = spark.createDataFrame(own, "sha string, unit long, path string")
        contents.add_batch(df, number, store, ["sha"], ["unit", "path"])
        if number == 3:  # a batch that is run again leaves the same
            contents.add_batch(df, number, store, ["sha"], ["unit", "path"])
    want = {}
    for sha, unit, path in every:
        if sha:
            want[sha] = min(want.get(sha, (unit, path)), (unit, path))
    got = contents.owners(spark, store, ["sha"], ["unit", "path"]).collect()
    assert {r["sha"]: (r["unit"], r["path"]) for r in got} == want and len(got) == len(want)


def test_only_parts_that_may_be_hit_are_read(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = lambda a, b: spark.range(a, b).selectExpr("concat('s', id) AS sha", "id AS unit")
    assert contents.add_batch(rows(0, 2000), 0, store, ["sha"], ["unit"]) == []
    new = contents.add_batch(rows(2000, 2400), 1, store, ["sha"], ["unit"])
    assert len(new) <= 10  # bits that are set by chance
    again = contents.add_batch(rows(0, 3), 2, store, ["sha"], ["unit"])
    assert 1 <= len(again) <= 3
    assert contents.owners(spark, store, ["sha"], ["unit"]).count() == 2400
    assert spark.read.parquet(f"{store}/rows").where("batch = 2").count() == 0


def test_a_stream_of_units(spark, tmp_path):
    src, store, point = (str(tmp_path / n) for n in ("src", "store", "point"))
    args = (spark, src, "sha string, unit long", store, point, ["sha"], ["unit"])
    spark.createDataFrame([("a", 5), ("b", 6)], "sha string, unit long").write.parquet(src)
    contents.keep_contents(*args)
    spark.createDataFrame([("a", 2), ("c", 9)], "sha string, unit long").write.mode("append").parquet(src)
    contents.keep_contents(*args)
    contents.keep_contents(*args)
    assert sorted(tuple(r) for r in contents.owners(spark, store, ["sha"], ["unit"]).collect()) == [("a", 2), ("b", 6), ("c", 9)]
