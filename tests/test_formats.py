"""Readers by extension, pages of documents, names of files and branches."""

import io
import pickle
import sqlite3
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.functions import paths
from palimpsest.operators import pages
from palimpsest.plans import catalog, formats  # noqa: F401
from palimpsest.sources import history, readers

from .conftest import SF

KML = b"<kml xmlns='x'><Placemark><name> one </name></Placemark><Folder><Placemark><name>two</name><address>road</address><Point><coordinates>1,2</coordinates></Point></Placemark></Folder></kml>"


def saved(array):
    out = io.BytesIO()
    np.save(out, array)
    return out.getvalue()


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def database(tmp_path):
    with sqlite3.connect(tmp_path / "made") as db:
        db.execute("CREATE TABLE t (a)")
        db.execute("INSERT INTO t VALUES ('cell')")
    db.close()
    return (tmp_path / "made").read_bytes()


def test_each_file_by_its_reader(spark, tmp_path):
    root = tmp_path / "root"
    files = {
        "a/x.npy": saved(np.array(["red", "", "blue"])), "b.NPZ": zipped({"v.npy": saved(np.array([b"inner"])), "n.npy": saved(np.arange(3)), "notes.txt": b"no"}), "c.pkl": pickle.dumps({"word": 1}),
        "d.sqlite": database(tmp_path), "e.kml": KML, "f.kmz": zipped({"doc.KML": KML, "x.png": b"1"}), "g.txt": b"plain", "h": b"", "bad.kml": b"<kml><Placemark>", "empty.kml": b"",
    }
    for name, data in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    got = {}
    for r in readers.texts(spark, str(root)).collect():
        got.setdefault((r["path"].split("/root/", 1)[1], r["reader"]), []).append((r["ord"], r["text"], r["status"]))
    marks = [(0, "one |  |  |  | ", "ok"), (1, "two |  | road |  | 1,2", "ok")]
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        ("a/x.npy", "arrays"): [(0, "red", "text"), (2, "blue", "text")], ("b.NPZ!v.npy", "array archives"): [(0, "inner", "text")], ("b.NPZ!n.npy", "array archives"): [(None, None, "numeric")],
        ("c.pkl", "pickles"): [(0, "word", "ok")], ("d.sqlite", "databases"): [(0, '{"a": "cell"}', "ok")], ("e.kml", "maps"): marks, ("f.kmz!doc.KML", "map archives"): marks,
        ("g.txt", ""): [(None, None, "no_reader")], ("bad.kml", "maps"): [(0, "", "not_read")],
    }  # fmt: skip  # files without content are listed by no source


def test_placemarks_of_small_and_large_files_are_alike(spark, monkeypatch):
    """Files parsed at once and in pieces: placemarks within others and of two namespaces, a file of no bytes."""
    one = b"<Placemark><name>a&amp;lt;</name><description>x &amp;amp; <b>y</b></description></Placemark>"
    files = [b"<k xmlns='u'>" + one * 3 + b"</k>", b"<k><Placemark><name>out</name>" + one + b"</Placemark></k>", b"<k xmlns:p='q'>" + one + b"<p:Placemark><p:name>z</p:name></p:Placemark></k>", b"", one]
    df = spark.createDataFrame([(str(i), bytearray(x)) for i, x in enumerate(files)], "path string, content binary")
    at_once = sorted(tuple(r) for r in readers.placemarks(df).na.fill("").collect())
    monkeypatch.setattr(readers, "PIECE", 8)
    assert at_once == sorted(tuple(r) for r in readers.placemarks(df).na.fill("").collect()) and len(at_once) == 9


def test_orders_are_dealt_before_they_are_written(spark):
    """What is shuffled is keys of lines, not the texts made of them."""
    plan = catalog.QUERIES["s27_placemarks"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_placemarks_in_blocks(spark):
    many = b"<kml>" + b"".join(b"<Placemark><name>%d</name><description>&lt;p&gt;x&amp;amp;y</description></Placemark>" % i for i in range(50_000)) + b"</kml>"
    rows = readers.placemarks(spark.createDataFrame([("p", bytearray(many)), ("q", None)], "path string, content binary"), block=100)
    assert rows.agg(F.count("*"), F.max("ord"), F.count_distinct("name"), F.min("description"), F.max("description")).first() == (50_000, 49_999, 50_000, " x&y", " x&y")


def test_pages(spark):
    rows = [
        ("a", 1, 1, "h1", 50), ("a", 1, 2, "h2", 5), ("a", 1, 3, "h1", 50), ("a", 2, 1, "h1", 50), ("a", 2, 2, "now", 50), ("a", 2, 3, "h3", None), ("a", 2, 4, None, 90), ("a", 3, 1, None, 90), ("b", 1, 1, "now", 50),
    ]
    table = spark.createDataFrame(rows, "path string, version int, page int, print string, chars int")
    today = spark.createDataFrame([("a", "now"), ("a", "now"), ("c", "h1")], "path string, print string")
    status = pages.page_status(table, today)
    got = {(r["path"], r["version"], r["page"]): (r["status"], r["merged_page"]) for r in status.collect()}
    assert got == {
        ("a", 1, 1): ("kept", 1), ("a", 1, 2): ("kept_ocr_needed", 2), ("a", 1, 3): ("duplicate", None), ("a", 2, 1): ("duplicate", None), ("a", 2, 2): ("in_today", None), ("a", 2, 3): ("kept_ocr_needed", 3),
        ("a", 2, 4): ("kept", 4), ("a", 3, 1): ("duplicate", None), ("b", 1, 1): ("kept", 1),
    }
    assert {r["path"]: tuple(r)[1:] for r in pages.page_counts(status).collect()} == {"a": (3, 8, 4, 2, 3, 1, False), "b": (1, 1, 1, 0, 0, 0, True)}
    assert pages.page_status(table.limit(0), today.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("rule", "cases"),
    [
        (paths.is_git_file, {".git": True, "a\\.git\\x": True, "a/.gitignore": False, "x/y.PACK": True, "p.rev": True, "idx": False, None: False}),
        (paths.repo_root, {"org/r/.git": "org/r", "org/r.git": "org/r.git", ".git": ".git", None: ""}),
        (paths.too_long, {"a/" + "x" * 255: False, "a/" + "x" * 256: True, "é" * 128: True, "a/" * 2000: False, "a/" * 2000 + "b": True}),
        (paths.under_files, {"files/a/b": "a/b", "/x/files/a/files/b": "a/files/b", "x\\files\\b": "b", "profiles/b": "", "files/": "", None: ""}),
        (paths.is_temporary, {"a/.tmp.x": True, "a/b.tmp.12": True, "b.tmp.12.7": True, "b.tmp.copy": True, "b.tmp.x": False, "b.tmp.1.2.3": False, ".tmp.d/x": False}),
        (history.plausible_branch, {"main": True, "a/b": True, "refs/heads/x": True, "refs/x": False, "HEAD": False, "-": False, "": False, None: False, "0" * 40: False, "0" * 39: True}),
    ],
)
def test_names(spark, rule, cases):
    rows = spark.createDataFrame([(k,) for k in cases], "p string").select("p", rule(F.col("p")).alias("v")).collect()
    assert {r["p"]: r["v"] for r in rows} == cases
