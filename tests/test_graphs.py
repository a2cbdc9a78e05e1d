"""Trees, commit graphs, identities through renames, names and batches, against plain versions."""

import heapq
import random
import re
from collections import Counter, defaultdict
from itertools import count
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from palimpsest.operators import graph, identity, naming, planning, shared, trees
from palimpsest.plans.catalog import QUERIES

from .conftest import SF


def plain_files(rnd, n):
    path = lambda: "/".join(rnd.choice(["a", "b", "c.d", "e"]) for _ in range(rnd.randint(1, 5)))
    out = {}
    for _ in range(n):
        p = path()
        # A file is no folder of another one.
        if not any(q.startswith(p + "/") or p.startswith(q + "/") for q in out):
            out[p] = rnd.choice("xyz")
    return out


def test_tree_changes(spark):
    rnd = random.Random(3)
    sides = {}
    for i in range(30):
        old = plain_files(rnd, rnd.randint(0, 40))
        new = dict(old) if i % 3 else plain_files(rnd, 30)
        for p in rnd.sample(sorted(new), min(len(new), 3)):
            new[p] = "w"
        for p in rnd.sample(sorted(new), min(len(new), i % 4)):
            del new[p]
        sides[i] = (old, new)
    rows = [(i, k, p, b) for i, both in sides.items() for k in (0, 1) for p, b in both[k].items()]
    files = spark.createDataFrame([*rows, (None, 0, "p", "b"), (1, 0, None, "b")], "i long, k int, path string, blob string")
    roots, entries = trees.store(files, ["i", "k"])
    assert entries.count() == entries.distinct().count()
    pairs = roots.where("i IS NOT NULL").groupBy("i").agg(F.max(F.when(F.col("k") == 0, F.col("tree"))).alias("old_tree"), F.max(F.when(F.col("k") == 1, F.col("tree"))).alias("new_tree"))
    got = sorted((r["i"], r["path"], r["status"], r["old_blob"], r["new_blob"]) for r in trees.changes(pairs, entries).collect())
    want = sorted((i, p, "A" if p not in a else "D" if p not in b else "M", a.get(p), b.get(p)) for i, (a, b) in sides.items() for p in {*a, *b} if a.get(p) != b.get(p))
    assert got == want and {x[2] for x in got} == {"A", "D", "M"}
    back = trees.listed(roots.where("i IS NOT NULL"), entries).collect()
    assert sorted((r["i"], r["k"], r["path"], r["id"]) for r in back) == sorted(rows)


def test_equal_trees_are_not_opened(spark):
    """Two large trees that differ in one file: a pair is opened for each level of its path, in however many roots."""
    n = 20
    files = spark.range(n * n * n).select((F.col("id") % n).alias("x"), (F.col("id") / n % n).cast("int").alias("y"), (F.col("id") / n / n).cast("int").alias("z"))
    files = files.select(F.concat_ws("/", "x", "y", "z").alias("path"))
    both = files.select(F.lit(0).alias("k"), "path", F.lit("b").alias("blob")).unionByName(files.select(F.lit(1).alias("k"), "path", F.when(F.col("path") == "3/4/5", "c").otherwise("b").alias("blob")))
    roots, entries = trees.store(both, ["k"])
    tree = {r["k"]: r["tree"] for r in roots.collect()}
    pairs = spark.range(50).withColumns({"old_tree": F.lit(tree[0]), "new_tree": F.when(F.col("id") == 7, F.lit(None)).otherwise(F.lit(tree[1]))})
    opened = []
    got = trees.changes(pairs.where("id <> 7"), entries, opened=opened).collect()
    assert opened == [1, 1, 1] and len(got) == 49 and {r["path"] for r in got} == {"3/4/5"}
    gone = trees.changes(pairs.where("id = 7"), entries).collect()
    assert len(gone) == n**3 and {r["status"] for r in gone} == {"D"}
    assert trees.changes(pairs.limit(0), entries).count() == 0


def test_tree_kinds(spark):
    """A file that becomes a folder, a link, a submodule; modes alone."""
    rows = [("o", "a", "100644", "blob", "1"), ("o", "b", "100644", "blob", "2"), ("o", "m", "160000", "commit", "c1"), ("o", "x", "100644", "blob", "4"),
            ("n", "a", "040000", "tree", "ta"), ("n", "b", "120000", "blob", "2"), ("n", "m", "160000", "commit", "c2"), ("n", "x", "100755", "blob", "4"), ("ta", "f", "100644", "blob", "5")]
    entries = spark.createDataFrame(rows, "tree string, name string, mode string, kind string, id string")
    pairs = spark.createDataFrame([("p", "o", "n")], "k string, old_tree string, new_tree string")
    got = sorted(tuple(r)[1:3] for r in trees.changes(pairs, entries).collect())
    assert got == [("a", "D"), ("a/f", "A"), ("b", "T"), ("m", "M"), ("x", "M")]


def test_equal_entries_of_opened_trees(spark, monkeypatch):
    """Entries come from one of equal folders, not from a distinct of all; what both trees have is gone before entries meet by name."""
    plans = []
    monkeypatch.setattr(trees, "cut", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), shared.cut(df))[1])
    files = spark.createDataFrame([(k, f"{d}/f{i}", "c" if k and i == 3 else "b") for k in (0, 1) for d in ("x", "y") for i in range(9)], "k int, path string, blob string")
    roots, entries = trees.store(files, ["k"])
    assert "Aggregate" not in plans[-1] and entries.count() == 4 + 9 + 9
    rows = [("o", "a", "100644", "blob", "b1"), ("o", "a", "040000", "tree", "t"), ("n", "a", "100644", "blob", "b2"), ("n", "a", "040000", "tree", "t")]
    both = spark.createDataFrame(rows, "tree string, name string, mode string, kind string, id string")
    got = trees.changes(spark.createDataFrame([("p", "o", "n")], "k string, old_tree string, new_tree string"), both).collect()
    assert [(r["path"], r["status"], r["old_blob"], r["new_blob"]) for r in got] == [("a", "M", "b1", "b2")]


def random_graph(rnd, n):
    """Parents of each node: two long branches, the second brought up to date from the first, short branches merged back, new roots."""
    parents, main, side = {0: []}, 0, 0
    while len(parents) < n:
        v = len(parents)
        kind = rnd.random()
        if kind < 0.03:
            parents[v] = []  # a root of its own
            parents[v + 1] = [main, v]
            main = v + 1
        elif kind < 0.3:
            first, last = main, main
            for _ in range(rnd.randint(1, 5)):
                parents[len(parents)] = [last]
                last = len(parents) - 1
            parents[len(parents)] = [main, last]
            main = len(parents) - 1
        elif kind < 0.5:
            parents[v] = [side, main]
            side = v
        elif kind < 0.51:
            parents[v] = [main, side]
            main = v
        elif kind < 0.8:
            parents[v] = [main]
            main = v
        else:
            parents[v] = [side]
            side = v
    return {v: sorted(set(ps)) for v, ps in parents.items() if v < n}


@pytest.fixture(scope="module")
def dag(spark):
    rnd = random.Random(5)
    parents = random_graph(rnd, 300)
    name = [f"c{(i * 7919) % 1009}" for i in range(300)]
    commits = spark.createDataFrame([(name[v], "r", rnd.randint(0, 50)) for v in parents], "commit string, repo string, date long")
    edges = spark.createDataFrame([(name[v], name[p], 1) for v, ps in parents.items() for p in ps] + [(name[0], "shallow", 1), (name[5], None, 1)], "commit string, parent string, extra int")
    return parents, name, commits, edges


def test_commit_order(spark, dag):
    parents, name, commits, edges = dag
    level = {}
    for v in sorted(parents):
        level[v] = max((level[p] + 1 for p in parents[v]), default=0)
    got = {r["commit"]: r["generation"] for r in graph.generations(commits, edges).collect()}
    assert got == {name[v]: x for v, x in level.items()}
    rows = graph.commit_order(commits, edges, ["repo"], "date").collect()
    place = {r["commit"]: r["ord"] for r in rows}
    assert sorted(place.values()) == list(range(1, 301)) and all(place[name[p]] < place[name[v]] for v in parents for p in parents[v])
    date = {r["commit"]: r["date"] for r in rows}
    assert sorted(place, key=place.get) == sorted(place, key=lambda c: (got[c], date[c], c))


def test_cycles_and_empty_graphs(spark, dag):
    _, _, commits, edges = dag
    ring = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "c"), ("e", None), ("f", "e")], "commit string, parent string")
    nodes = ring.select("commit")
    assert {r["commit"]: r["generation"] for r in graph.generations(nodes, ring).collect()} == {"e": 0, "f": 1}
    assert graph.generations(commits.limit(0), edges).count() == 0


def test_long_chain(spark):
    """Rounds are logarithmic in a chain's length."""
    n = 100_000
    chain = spark.range(n).select(F.col("id").alias("commit"), (F.col("id") - 1).alias("parent"))
    rows = graph.generations(chain, chain.where("parent >= 0"))
    assert rows.where("generation <> commit").count() == 0 and rows.count() == n


def test_names_of_tips(spark):
    """Bitmaps of several words, several rows of a path, tips of another unit."""
    tips = spark.range(150).select(F.lit("r").alias("repo"), "id", F.format_string("t%03d", "id").alias("name")).withColumnRenamed("id", "tip")
    tips = tips.unionByName(tips.where("tip < 3").withColumns({"repo": F.lit("s"), "name": F.concat(F.lit("s"), "name")}))
    sets = [("r", "p", {0, 63, 64}), ("r", "p", {149}), ("s", "p", {1, 2}), ("r", "q", set(range(150))), ("r", "none", set())]
    word = lambda held, k: sum(1 << b for b in range(64) if 64 * k + b in held)
    signed = lambda w: w - (1 << 64) if w >> 63 else w
    state = spark.createDataFrame([(r, p, [signed(word(h, k)) for k in range(3)]) for r, p, h in sets], "repo string, path string, bitmap array<long>")
    got = {(r["repo"], r["path"]): (r["tips"], r["names"]) for r in graph.named(state, tips, ["repo"], ["repo", "path"], "name").collect()}
    assert got == {("r", "p"): (4, ["t000", "t063", "t064", "t149"]), ("s", "p"): (2, ["st001", "st002"]), ("r", "q"): (150, [f"t{i:03}" for i in range(150)])}
    has = state.select("path", *[graph.has(F.col("bitmap"), F.lit(i)).alias(str(i)) for i in (0, 1, 63, 149, 500)]).where("path = 'p'").collect()
    assert [list(r)[1:] for r in has] == [[True, False, True, False, False], [False, False, False, True, False], [False, True, False, False, False]]


@pytest.mark.parametrize("name", ["j35_exclusive_paths", "j28_path_tips"])
def test_tables_of_commits_stay_off_the_driver(spark, monkeypatch, name):
    """Compressed files of a few bytes a row are no reason to broadcast a table that has a row a commit."""
    real, plans = shared.cut, []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for module in (shared, graph):
        monkeypatch.setattr(module, "cut", lambda df: (plans.append(plan(df)), real(df))[1])
    monkeypatch.setattr(graph, "FEW", -1, raising=False)
    plans.append(plan(QUERIES[name](spark, SF)))
    assert len(plans) > 20 and any("Join" in p for p in plans) and not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize("words", [2])
def test_tips(spark, dag, monkeypatch, words):
    monkeypatch.setattr(graph, "WORDS", words)
    parents, name, commits, edges = dag
    rnd = random.Random(9)
    at = [rnd.randrange(300) for _ in range(150)]
    tips = spark.createDataFrame([(f"t{i:03}", "r", name[v]) for i, v in enumerate(at)], "branch string, repo string, commit string")
    tips = graph.tip_numbers(tips, ["repo"], "branch")
    assert {r["branch"]: r["tip"] for r in tips.collect()} == {f"t{i:03}": i for i in range(150)}
    want = defaultdict(set)
    for i, v in enumerate(at):
        todo = [v]
        while todo:
            x = todo.pop()
            if i not in want[x]:
                want[x].add(i)
                todo += parents[x]
    rows = graph.tips_of_commits(commits, edges, tips).withColumns({"m": graph.members(F.col("bitmap")), "k": graph.n_set(F.col("bitmap"))}).collect()
    assert len(rows) == 300
    for r in rows:
        own = want[name.index(r["commit"])]
        assert r["m"] == sorted(own) and r["k"] == len(own)


def test_state_at_tips(spark, dag):
    parents, name, commits, edges = dag
    rnd = random.Random(2)
    at = [rnd.randrange(250, 300) for _ in range(70)]
    tips = spark.createDataFrame([(i, name[v]) for i, v in enumerate(at)], "tip long, commit string")
    steps = [(v, f"p{rnd.randrange(40)}", rnd.choice("AMMD"), f"b{v}") for v in range(300)]
    above = {}
    for v in range(300):
        above[v] = {v}.union(*[above[p] for p in parents[v]])
    want = defaultdict(set)
    for i, v in enumerate(at):
        last = {p: (s, b) for w, p, s, b in steps if w in above[v]}
        for p, (s, b) in last.items():
            if s != "D":
                want[p, b].add(i)
    changes = spark.createDataFrame([(name[v], v, p, s, b) for v, p, s, b in steps], "commit string, ord long, path string, status string, blob string")
    state = graph.state_at_tips(changes.join(graph.tips_of_commits(commits, edges, tips), "commit"), ["path"], "ord", keep=["blob"])
    assert {(r["path"], r["blob"]): set(r["m"]) for r in state.withColumn("m", graph.members(F.col("bitmap"))).collect()} == want


def plain_records(changes, wanted):
    """Each name's record as the list of all changes in it."""
    record = defaultdict(list)
    for change in changes:
        _, name, old, status, _ = change
        if status.startswith("R") and record[old]:
            taken, record[old] = record[old], record[old] if old in wanted else []
            record[name] = taken + record[name]
        record[name] = [*record[name], change]
    out = {}
    for name, own in record.items():
        if own:
            kinds = Counter(c[3][0] if c[3][0] in "ADR" else "M" for c in own)
            ends = [f(own, key=lambda c: (c[4], c[0])) for f in (min, max)]
            out[name] = (len(own), *[kinds[k] for k in "AMDR"], *[f"c{c[0]}" for c in ends], ends[1][3])
    return out


@pytest.mark.parametrize("seed, some", [(1, False), (2, True), (3, True)])
def test_records_follow_renames(spark, seed, some):
    rnd = random.Random(seed)
    rows, want = [], {}
    names = [f"f{i}" for i in range(6)]
    wanted = names[:3] if some else []
    for unit in range(25):
        own = []
        for o in range(rnd.randint(1, 45)):
            status = rnd.choice(["A", "M", "M", "D", "R100", "R087", "T", "C"])
            own.append((o, rnd.choice(names), rnd.choice([*names, None]) if status[0] == "R" else None, status, rnd.randint(0, 20)))
        rows += [(unit, *r, f"c{r[0]}") for r in own]
        want |= {(unit, p): v for p, v in plain_records(own, wanted).items()}
    df = spark.createDataFrame(rows, "repo long, ord long, path string, old_path string, status string, ts long, commit string").repartition(3)
    keep = spark.createDataFrame([(u, p) for u in range(25) for p in wanted], "repo long, path string")
    got = identity.record_counts(df, ["repo"], keep if some else None).collect()
    assert {(r["repo"], r["path"]): tuple(r[c] for c in ("touched", "added", "modified", "deleted", "renamed", "first_commit", "last_commit", "last_status")) for r in got} == want


def test_records_without_renames_need_no_stretches(spark, monkeypatch):
    monkeypatch.setattr(identity, "_stretches", lambda *_: pytest.fail("names were cut into stretches"))
    rnd = random.Random(4)
    rows, want = [], {}
    for unit in [*range(8), None]:
        own = [(o, rnd.choice(["a", "b", "c"]), None, rnd.choice(["A", "M", "D", "R", "T"]), rnd.randint(0, 9)) for o in range(rnd.randint(1, 30))]
        rows += [(unit, *r, f"c{r[0]}") for r in own] + [(unit, 99, None, None, "A", 99, "c99")]
        want |= {(unit, p): v for p, v in plain_records(own, []).items()}
    df = spark.createDataFrame(rows, "repo long, ord long, path string, old_path string, status string, ts long, commit string").repartition(3)
    for changes in (df, df.withColumn("old_path", F.when(F.col("status") != "R", "a"))):  # an old name counts in a rename only
        got = identity.record_counts(changes, ["repo"], df.select("repo", "path").limit(1)).collect()
        assert {(r["repo"], r["path"]): tuple(r[c] for c in ("touched", "added", "modified", "deleted", "renamed", "first_commit", "last_commit", "last_status")) for r in got} == want


def spelled(path, k):
    """The k-th name that a path asks for."""
    return path if k == 1 else re.sub(r"(?<=[^/])(\.[^./]*)?$", rf"__case{k}\1", path, count=1)


def plain_names(rels, existing, fixed):
    """One path after another, each with the first name that is free."""
    free = lambda name: name.lower() not in used
    used = {str(folder).lower() for p in {*rels, *existing} for folder in PurePosixPath(p).parents}
    used.update(p.lower() for p in [*existing, *fixed.values()])
    out = {r: fixed.get(r, r) for r in rels if r in fixed or r in existing}
    for r in sorted(set(rels) - set(out)):
        out[r] = next(filter(free, (spelled(r, k) for k in count(1))))
        used.add(out[r].lower())
    return out


def test_keep_apart(spark):
    rnd = random.Random(4)
    part = lambda: rnd.choice(["a", "A", "b", "B.x", "b.X", ".c", ".C", "a__case2", "A__case3", "b__case2.x", "d."])
    path = lambda: "/".join(part() for _ in range(rnd.choice([1, 1, 2, 3])))
    rows, have, plan, want = [], [], [], {}
    for unit in range(40):
        rels = {path() for _ in range(rnd.randint(1, 30))}
        existing = {path() for _ in range(rnd.randint(0, 4))} | set(rnd.sample(sorted(rels), 1))
        fixed = {r: r + "_fixed" for r in rnd.sample(sorted(rels), min(len(rels), rnd.randint(0, 2)))}
        rows += [(unit, r) for r in rels]
        have += [(unit, r) for r in existing]
        plan += [(unit, r, n) for r, n in fixed.items()]
        want |= {(unit, r): n for r, n in plain_names(rels, existing, fixed).items()}
    kinds = "unit long, rel string"
    got = naming.keep_apart(spark.createDataFrame([*rows, (1, None)], kinds), "unit", "rel", spark.createDataFrame(have, kinds), spark.createDataFrame(plan, kinds + ", name string")).collect()
    assert {(r["unit"], r["rel"]): r["name"] for r in got} == want and len(got) == len(want)
    assert any("__case4" in n for n in want.values())
    alone = {(r["unit"], r["rel"]): r["name"] for r in naming.keep_apart(spark.createDataFrame(rows, kinds), "unit", "rel").collect()}
    by = defaultdict(set)
    for u, r in rows:
        by[u].add(r)
    assert alone == {(u, r): n for u, rels in by.items() for r, n in plain_names(rels, set(), {}).items()}


def test_share_safe(spark):
    cases = {"a:b/c*?.txt": "a_b/c__.txt", "x. /y..": "x__/y__", "a.b/c d": "a.b/c d", 'q"<>|\\\x01': "q_____" + "_", "...": "___", "": "", "a./. .": "a_/___"}
    got = spark.createDataFrame([(k,) for k in cases], "p string").select("p", naming.share_safe(F.col("p")).alias("s")).collect()
    assert {r["p"]: r["s"] for r in got} == cases


def test_balanced(spark):
    rnd = random.Random(6)
    rows, want = [], {}
    for group, n, sizes in [("all", 3000, 40), ("few", 3, 9), ("zero", 50, 1), ("many", 400, 10**6), (None, 70, 12)]:
        own = [(group, f"u{i:05}", rnd.choice([None, *range(sizes)]) if sizes < 100 else rnd.randrange(sizes)) for i in range(n)]
        rows += own
        heap = [(0, b) for b in range(7)]
        for _, u, s in sorted(own, key=lambda r: (-(r[2] or 0), r[1])):
            load, b = heapq.heappop(heap)
            want[group, u] = b
            heapq.heappush(heap, (load + (s or 0), b))
    df = spark.createDataFrame(rows, "org string, unit string, size long").repartition(4)
    got = planning.balanced(df, "unit", "size", 7, "org").collect()
    assert {(r["org"], r["unit"]): r["batch"] for r in got} == want and len(got) == len(rows)


def test_numbered(spark):
    rows = spark.range(2000).select((F.col("id") % 3 == 0).alias("hot"), F.when(F.col("id") % 7 > 0, F.lit("g")).alias("g"), F.xxhash64("id").alias("k"))
    got = shared.numbered(rows.repartition(5), ["g"], [F.col("k").desc()]).collect()
    for g in ("g", None):
        own = sorted((r for r in got if r["g"] == g), key=lambda r: r["n"])
        assert [r["n"] for r in own] == list(range(1, len(own) + 1)) and [r["k"] for r in own] == sorted((r["k"] for r in own), reverse=True)
