"""Stores of trees: folders named by what they hold, so that equal folders have equal names wherever they are.

A store is a table of entries: tree, name, mode, kind ('tree', 'blob' or 'commit'), id. Going down a level is a join for all roots at
once; a pair of trees that many roots share is opened once, and a pair of equal trees never.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut

#: Levels that are gone down at most; a deeper store has a cycle.
DEEPEST = 4096


def store(files: DataFrame, root: list[str], path: str = "path", blob: str = "blob", mode: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(roots, entries) of files: the columns of ``root`` and its tree; the distinct entries of all trees.

    Folders are named from the deepest level up by two checksums of their entries, each a partial aggregate, so that no
    folder's entries come together in one task. Files without a root or path are left out; of a path given twice the largest blob counts.
    """
    keys = [F.col(c).alias(f"_r{i}") for i, c in enumerate(root)]
    names = [f"_r{i}" for i in range(len(root))]
    rows = files.where(F.col(path).isNotNull()).select(*keys, F.col(path).alias("path"), F.struct(F.col(blob).cast("string").alias("id"), (F.col(mode) if mode else F.lit("100644")).alias("mode")).alias("f"))
    # A hash in front of the keys decides nearly all comparisons of the sort that the maximum of a struct needs.
    rows = rows.groupBy(F.xxhash64(*names, "path").alias("_h"), *names, "path").agg(F.max("f").alias("f"))
    level = rows.select(*names, "path", "f.mode", F.lit("blob").alias("kind"), "f.id")
    level = cut(level.withColumn("depth", F.size(F.split("path", "/")) - 1))
    deepest = level.agg(F.max("depth")).first()[0]
    levels: list[tuple[int, DataFrame, DataFrame]] = []
    above = None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        own = level.where(F.col("depth") == depth).drop("depth")
        own = own.unionByName(above) if above is not None else own
        folder = F.when(F.lit(depth) == 0, F.lit("")).otherwise(F.substring_index("path", "/", depth))
        own = own.select(*names, folder.alias("folder"), F.substring_index("path", "/", -1).alias("name"), "mode", "kind", "id")
        one = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "name", "mode", "kind", F.coalesce("id", F.lit(""))))
        trees = cut(own.groupBy(*names, "folder").agg(F.concat(F.lit("t"), F.md5(F.concat_ws(":", one(1), one(2), F.count("*")))).alias("tree")))
        levels.append((depth, own, trees))
        above = trees.select(*names, F.col("folder").alias("path"), F.lit("040000").alias("mode"), F.lit("tree").alias("kind"), F.col("tree").alias("id"))
    if above is None:
        return files.sparkSession.createDataFrame([], files.select(*root).schema).withColumn("tree", F.lit(None).cast("string")), level.select(F.lit("").alias("tree"), F.lit("").alias("name"), "mode", "kind", "id").limit(0)
    roots = above.select(*[F.col(n).alias(c) for n, c in zip(names, root, strict=True)], F.col("id").alias("tree"))
    # Of equal folders one gives the entries, so these are distinct without being compared. Folders without a whole root give none.
    folders = reduce(DataFrame.unionByName, [t.where(reduce(Column.__and__, [F.col(n).isNotNull() for n in names], F.lit(True))).withColumn("_d", F.lit(d)) for d, _, t in levels])
    first = cut(folders.groupBy("tree").agg(F.min(F.struct("_d", *names, "folder")).alias("at")).select("tree", "at.*"))
    entries = [own.join(first.where(F.col("_d") == d), [*names, "folder"]).select("tree", "name", "mode", "kind", "id") for d, own, _ in levels]
    return roots, cut(reduce(DataFrame.unionByName, entries))


def listed(roots: DataFrame, entries: DataFrame, tree: str = "tree") -> DataFrame:
    """Every file below each root: the columns of ``roots``, path, mode, id. Trees that are not in the store give nothing."""
    keys = [c for c in roots.columns if c != tree]
    frontier, out = cut(roots.select(*keys, F.col(tree).alias("_tree"), F.lit("").alias("_at"))), None
    for _ in range(DEEPEST):
        met = cut(frontier.join(entries, F.col("_tree") == F.col("tree")).select(*keys, F.concat("_at", "name").alias("path"), "mode", "kind", "id"))
        found = met.where("kind <> 'tree'").select(*keys, "path", "mode", "id")
        out = found if out is None else out.unionByName(found)
        frontier = met.where("kind = 'tree'").select(*keys, F.col("id").alias("_tree"), F.concat("path", F.lit("/")).alias("_at"))
        if frontier.isEmpty():
            break
    return out


def changes(pairs: DataFrame, entries: DataFrame, old: str = "old_tree", new: str = "new_tree", opened: list[int] | None = None) -> DataFrame:
    """What differs between each pair of trees: the columns of ``pairs`` but the trees, status, path, old_mode, new_mode, old_blob, new_blob.

    status: A, D, M, or T where the kind of file changed. A null tree is an empty one. Renames are not looked for. A file that becomes a
    folder goes (D) and what is in the folder comes (A). Trees with equal names are passed over with all that is below them. A pair of
    trees that several pairs share, or meet in several folders, is opened once; ``opened`` gets the number of pairs opened at each level.
    """
    keys = [c for c in pairs.columns if c not in (old, new)]
    frontier = pairs.select(*keys, F.lit("").alias("_at"), F.col(old).alias("_o"), F.col(new).alias("_n")).where("NOT (_o <=> _n)")
    frontier, out = cut(frontier), None
    side = lambda which, c: F.max(F.when(F.col("_new") == which, F.col(c)))
    for _ in range(DEEPEST):
        both = cut(frontier.select("_o", "_n").distinct().withColumn("_pair", F.monotonically_increasing_id()))
        n = both.count()
        if opened is not None and n:
            opened.append(n)
        if not n:
            break
        sides = both.select(F.col("_o").alias("tree"), "_pair", F.lit(1).alias("_in")).unionByName(both.select(F.col("_n").alias("tree"), "_pair", F.lit(2).alias("_in")))
        # Entries that both trees have go first, by a hashed count; only what is left is brought together by name.
        met = sides.where("tree IS NOT NULL").join(entries, "tree").groupBy("_pair", "name", "mode", "kind", "id").agg(F.bit_or("_in").alias("_in")).where("_in <> 3")
        met = met.withColumn("_new", F.col("_in") == 2).groupBy("_pair", "name").agg(
            *[side(w, c).alias(f"{c}{'2' if w else '1'}") for w in (False, True) for c in ("mode", "kind", "id")]
        )
        met = cut(met.where("NOT (id1 <=> id2) OR NOT (mode1 <=> mode2)").join(both, "_pair").drop("_pair"))
        rows = frontier.alias("f").join(met.alias("m"), F.expr("f._o <=> m._o AND f._n <=> m._n"))
        rows = cut(rows.select(*[F.col(f"f.{k}") for k in keys], F.concat("f._at", "m.name").alias("path"), *[F.col(f"m.{c}{i}") for i in (1, 2) for c in ("mode", "kind", "id")]))
        file1, file2 = F.col("kind1") != "tree", F.col("kind2") != "tree"
        out1, out2 = F.coalesce(file1, F.lit(False)), F.coalesce(file2, F.lit(False))
        found = rows.where(out1 | out2).select(
            *keys, "path",
            F.when(~out1, "A").when(~out2, "D").when((F.col("kind1") != F.col("kind2")) | (F.substring("mode1", 1, 3) != F.substring("mode2", 1, 3)), "T").otherwise("M").alias("status"),
            *[F.when(o, F.col(c)).alias(a) for o, c, a in ((out1, "mode1", "old_mode"), (out2, "mode2", "new_mode"), (out1, "id1", "old_blob"), (out2, "id2", "new_blob"))],
        )
        out = found if out is None else out.unionByName(found)
        tree = lambda i: F.when(F.col(f"kind{i}") == "tree", F.col(f"id{i}"))
        frontier = rows.select(*keys, F.concat("path", F.lit("/")).alias("_at"), tree(1).alias("_o"), tree(2).alias("_n")).where("NOT (_o <=> _n)")
    if out is None:
        kinds = {"path": "string", "status": "string", "old_mode": "string", "new_mode": "string", "old_blob": "string", "new_blob": "string"}
        out = frontier.select(*keys, *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()]).limit(0)
    return out
