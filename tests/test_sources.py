"""Sources, sinks and streaming on small files made here."""

import bz2
import gzip
import io
import json
import pickle
import sqlite3
import struct
import tarfile
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import sinks
from palimpsest.sources import binaries, history, tabular


def frame(spark, files):
    return spark.createDataFrame([(k, bytearray(v)) for k, v in files.items()], "path string, content binary")


def zipped(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k, v in files.items():
            z.writestr(k, v)
    return out.getvalue()


def tarred(files):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        for k, v in files.items():
            info = tarfile.TarInfo(k)
            info.size = len(v)
            t.addfile(info, io.BytesIO(v))
    return out.getvalue()


def test_archives(spark):
    inner = gzip.compress(tarred({"deep.txt": b"deep", "more.zip": zipped({"z": b"zz"})}))
    files = {"a.zip": zipped({"x.txt": b"x", "in.tgz": inner, "big.bin": b"0" * 50000}), "b.csv.gz": gzip.compress(b"1,2"), "c.bz2": bz2.compress(b"c"), "bad.zip": zipped({"q": b"q" * 50})[:40], "no.txt": b"plain"}
    rows = binaries.archive_members(frame(spark, files), most=20000).collect()
    got = {(r["path"], r["member"]): (r["status"], bytes(r["content"]) if r["content"] is not None else None) for r in rows}
    assert got[("a.zip", "x.txt")] == ("ok", b"x") and got[("a.zip", "big.bin")] == ("too_large", None)
    assert ("a.zip", "in.tgz!in.tar!deep.txt") in got and any(k[1].endswith("more.zip!z") for k in got)
    assert got[("b.csv.gz", "b.csv")] == ("ok", b"1,2") and got[("c.bz2", "c")] == ("ok", b"c")
    assert got[("bad.zip", "bad.zip")][0] == "damaged" and got[("no.txt", "no.txt")][0] == "not_an_archive"
    flat = binaries.archive_members(frame(spark, files), depth=1).where("path = 'a.zip'").collect()
    assert {r["status"] for r in flat if r["member"] == "in.tgz"} == {"too_deep"}


def test_split_sets(spark):
    df = spark.createDataFrame([("s", 2, b"b"), ("s", 1, b"a"), ("t", 1, b"x"), ("t", 3, b"z")], "k string, n int, c binary")
    got = {r["k"]: (r["status"], r["content"] and bytes(r["content"])) for r in binaries.join_split_sets(df, "k", "n", "c").collect()}
    assert got == {"s": ("ok", b"ab"), "t": ("gap", None)}


def test_pack_index_and_loose_objects(spark):
    ids = sorted(bytes([i]) * 20 for i in (1, 5, 5, 200))
    fan = [sum(x[0] <= k for x in ids) for k in range(256)]
    data = b"\xfftOc\x00\x00\x00\x02" + struct.pack(">256I", *fan) + b"".join(ids) + struct.pack(">4I", 1, 2, 3, 4) + struct.pack(">4I", 12, 13, 14, 1 << 31) + struct.pack(">Q", 1 << 33) + b"\0" * 40
    rows = binaries.pack_index(frame(spark, {"p.idx": data, "q.idx": b"junk"})).collect()
    assert [(r["object"][:2], r["crc32"], r["offset"]) for r in rows if r["path"] == "p.idx"] == [("01", 1, 12), ("05", 2, 13), ("05", 3, 14), ("c8", 4, 1 << 33)]
    assert [r["status"] for r in rows if r["path"] == "q.idx"] == ["not_v2"]
    import hashlib

    raw = b"blob 3\x00abc"
    name = hashlib.sha1(raw).hexdigest()
    got = binaries.loose_objects(frame(spark, {f"o/{name[:2]}/{name[2:]}": zlib.compress(raw), "o/00/11": b"?"})).collect()
    assert {(r["type"], r["size"], r["verified"], r["status"]) for r in got} == {("blob", 3, True, "ok"), (None, None, False, "damaged")}


class Boom:
    def __reduce__(self):
        return (pytest.fail, ("loaded",))


def test_pickles_are_read_and_never_loaded(spark):
    files = {"a": pickle.dumps({"name": "some text"}, 4) + pickle.dumps(["second"], 0), "b": pickle.dumps(Boom(), 0), "c": b"not a pickle"}
    rows = binaries.pickle_strings(frame(spark, files)).collect()
    texts = {(r["path"], r["text"]) for r in rows}
    assert {("a", "some text"), ("a", "second"), ("a", "name")} <= texts and any(r["kind"] == "class" for r in rows if r["path"] == "b")
    assert [r["status"] for r in rows if r["path"] == "c"] == ["not_read"]


def test_newest_versions_of_split_parts(spark):
    rows = [("s", 1, 1, b"old"), ("s", 1, 2, b"new-"), ("s", 2, 1, b"two"), ("t", 2, 1, b"x"), ("u", 1, 5, b"abc"), ("u", 3, 1, b"d"), ("v", 1, 1, b"12345678")]
    df = spark.createDataFrame([(k, n, v, bytearray(c)) for k, n, v, c in rows], "k string, n int, v int, c binary")
    got = {r["k"]: (r["parts"], r["status"], r["content"] and bytes(r["content"])) for r in binaries.join_split_sets(df, "k", "n", "c", "v", most=7).collect()}
    assert got == {"s": (2, "ok", b"new-two"), "t": (1, "gap", None), "u": (2, "gap", None), "v": (1, "too_large", None)}
    status = {(r["k"], r["n"], r["v"]): r["status"] for r in binaries.split_part_status(df, "k", "n", "v").collect()}
    assert status == {
        ("s", 1, 1): "split_part_older_version", ("s", 1, 2): "split_part", ("s", 2, 1): "split_part", ("t", 2, 1): "incomplete_set", ("u", 1, 5): "incomplete_set",
        ("u", 3, 1): "incomplete_set", ("v", 1, 1): "split_part",
    }


def test_columnar_files_and_arrays(spark):
    import io

    import numpy as np
    import pyarrow as pa
    from pyarrow import feather

    table = pa.table({"a": [1, None, 3], "b": ["x\ny", "z", ""], "c": [[1], None, [2, 3]]})
    files = {}
    for name, opened in (("file", pa.ipc.new_file), ("stream", pa.ipc.new_stream)):
        out = io.BytesIO()
        with opened(out, table.schema) as w:
            w.write_table(table)
        files[name] = out.getvalue()
    out = io.BytesIO()
    feather.write_feather(table.drop_columns("c"), out, version=1)
    files |= {"old": out.getvalue(), "bad": b"ARROW1 no more", "junk": b"\xff\xff\xff\xff junk"}
    rows = binaries.columnar_rows(frame(spark, files), block=2).collect()
    texts = lambda p: [r["text"] for r in sorted(rows, key=lambda r: r["ord"]) if r["path"] == p]
    assert texts("file") == texts("stream") == ["a | b | c", "1 | x y | [1]", " | z | ", "3 |  | [2, 3]"]
    assert texts("old")[0] == "a | b" and len(texts("old")) == 4
    assert all(r["status"].startswith("not_read") for r in rows if r["path"] in ("bad", "junk"))

    def saved(x):
        out = io.BytesIO()
        np.save(out, x, allow_pickle=True)
        return out.getvalue()

    arrays = {"u": np.array(["é", "", "long one"]), "s": np.array([b"a", b"bc"]), "n": np.arange(3), "o": np.array([{"a": 1}], dtype=object), "st": np.zeros(2, "i4,f8"), "big": np.array(["w"], ">U3")}
    got = binaries.npy_text(frame(spark, {k: saved(v) for k, v in arrays.items()} | {"bad": b"\x93NUMPY\x01"}), block=1).collect()
    assert sorted((r["path"], r["ord"], r["text"]) for r in got if r["status"] == "text") == [("big", 0, "w"), ("s", 0, "a"), ("s", 1, "bc"), ("u", 0, "é"), ("u", 2, "long one")]
    assert {r["path"]: r["status"] for r in got if r["status"] != "text"} == {"n": "numeric", "o": "object", "st": "structured", "bad": "bad_header"}


def test_other_binaries(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "x.db")
    db.execute("CREATE TABLE t (a INT, b TEXT)")
    db.execute("INSERT INTO t VALUES (1, 'x'), (2, NULL)")
    db.commit()
    db.close()
    rows = binaries.sqlite_rows(frame(spark, {"x": (tmp_path / "x.db").read_bytes(), "y": b"no database at all"})).collect()
    assert [json.loads(r["row"]) for r in rows if r["path"] == "x"] == [{"a": 1, "b": "x"}, {"a": 2, "b": None}]
    assert [r["status"] for r in rows if r["path"] == "y"] == ["not_read"]
    book = {"cells": [{"cell_type": "code", "outputs": [{"output_type": "stream", "text": ["a\n", "b"]}, {"output_type": "execute_result", "data": {"text/plain": ["42"]}}]}, {"cell_type": "markdown"}]}
    assert [r["text"] for r in binaries.notebook_outputs(frame(spark, {"n": json.dumps(book).encode()})).collect()] == ["a\nb", "42"]
    line = spark.createDataFrame([("see " + "a" * 40 + ".pdf and " + "B" * 64 + ".txt md5 " + "c" * 32,)], "value string")
    assert {(r["ext"], r["md5"]) for r in binaries.hash_names(line).collect()} == {("pdf", "c" * 32), ("txt", "c" * 32)}
    page = spark.createDataFrame([("<table><tr><th>A</th><td> b&nbsp;<b>c</b></td></tr><tr><td>1</td></tr></table>",)], "value string")
    assert [r["row"] for r in binaries.html_table_rows(page).orderBy("row_no").collect()] == [["A", "b c"], ["1"]]


def test_history_log(spark, tmp_path):
    z = "0" * 40
    a, b = "a" * 40, "b" * 40
    log = (
        f"\x1e{'1' * 40}\x1f\x1f2024-01-01T00:00:00+02:00\x1fme\x1ffirst\n\n:000000 100644 {z} {a} A\tx y.txt\n3\t0\tx y.txt\n"
        f"\x1e{'2' * 40}\x1f{'1' * 40} {'9' * 40}\x1f2024-01-02T00:00:00Z\x1fyou\x1fMerge branch 'dev' into main\n\n:100644 100644 {a} {b} R090\tx y.txt\tz.txt\n:000000 120000 {z} {b} A\tlink\n:100644 000000 {a} {z} D\tgone\n-\t-\tz.txt\n"
    )
    (tmp_path / "log").write_text(log)
    commits = history.commits(spark, str(tmp_path / "log"))
    rows = history.changes(commits).orderBy("commit", "line_no").collect()
    assert [(r["status"], r["score"], r["path"], r["old_path"]) for r in rows] == [("A", None, "x y.txt", None), ("R", 90, "z.txt", "x y.txt"), ("A", None, "link", None), ("D", None, "gone", None)]
    assert [r["path"] for r in history.with_content(history.changes(commits)).orderBy("commit").collect()] == ["x y.txt", "z.txt"]
    assert {(r["path"], r["added"], r["deleted"]) for r in history.numstat(commits).collect()} == {("x y.txt", 3, 0), ("z.txt", None, None)}
    assert [len(r["parents"]) for r in commits.orderBy("commit").collect()] == [0, 2]
    assert [r["name"] for r in history.merged_branches(commits).collect()] == ["dev"]
    (tmp_path / "HEAD").write_text(f"{a} {b} me <m@x> 1 +0000\tcheckout: moving from main to topic\n{a} {b} me <m@x> 1 +0000\tcommit: x\n")
    assert [(r["left"], r["name"]) for r in history.reflog_refs(spark, str(tmp_path / "HEAD")).collect()] == [("main", "topic")]


def test_tables(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a;b;c\n1;"x;y";3\n4;5\n6;7;8\n')
    rows = tabular.read_table(spark, str(tmp_path / "t.csv"), ["a", "c"]).collect()
    assert [(r["a"], r["b"], r["c"], r["_bad"] is None) for r in rows] == [("1", "x;y", "3", True), ("4", "5", None, False), ("6", "7", "8", True)]
    with pytest.raises(ValueError, match="missing column"):
        tabular.read_table(spark, str(tmp_path / "t.csv"), ["zz"])
    runs = spark.createDataFrame([("r1", "ok"), ("r2", "timeout")], "u string, status string")
    units = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "u string")
    assert {r[0] for r in tabular.not_done(units, runs, ["u"], retry=["timeout"]).collect()} == {"r2", "r3"}
    assert {r[0] for r in tabular.finished(units, runs, ["u"]).collect()} == {"r1"}


def test_sinks(spark, tmp_path):
    import hashlib

    good = hashlib.sha1(b"blob 3\x00abc").hexdigest()
    df = spark.createDataFrame([("txt", good, b"abc"), ("txt", good, b"abc"), ("txt", "0" * 40, b"bad")], "ext string, blob string, content binary")
    assert [r["blob"] for r in sinks.content_store(df, str(tmp_path / "store")).collect()] == ["0" * 40]
    assert spark.read.parquet(str(tmp_path / "store")).count() == 1
    small = spark.createDataFrame([("b", 2), ('a,"', 1)], "k string, n long")
    sinks.csv_lines(small, str(tmp_path / "csv"), ["n"], "k", ["k"])
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "csv").glob("part-*"))).decode()
    assert text == 'k,n\r\n"a,""",1\r\nb,2\r\ntotal,3\r\n'
    assert sinks.markdown(small.orderBy("n")).splitlines()[2:] == ['| a," | 1 |', "| b | 2 |"]
