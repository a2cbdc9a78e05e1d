"""A path's identity through time: counts of changes that follow renames.

A rename takes the old name's record to the new name; if that has a record, it is absorbed. The old name then has none, or
goes on with its own if it is wanted under that name too (a clone). A name's changes are cut into stretches by the renames from it and
to it. A stretch is a node: its record follows from the name's stretch before, unless the record went, and from the stretch of the old
name that a rename brought. Values go over that graph without a step for each rename.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import Weight, values
from .shared import cut

#: What is counted, by the first letter of the status; all others are modifications (fixed values).
COUNTS = {"added": "A", "deleted": "D", "renamed": "R"}
TAKE, BRING, OWN = 0, 1, 2


def _stretches(changes: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """A row for each thing that happens to a name (kind), with its stretch c, and the stretch of the record that the name has before (link)."""
    renamed = changes.where("s = 'R' AND old IS NOT NULL")
    side = lambda name, kind, rows: rows.select("unit", F.col(name).alias("name"), "ord", F.lit(kind).alias("kind"), "s", "point")
    events = side("old", TAKE, renamed).unionByName(side("path", BRING, renamed)).unionByName(side("path", OWN, changes))
    if wanted is None:
        events = events.withColumn("goes", F.col("kind") == TAKE)
    else:
        events = events.join(wanted, ["unit", "name"], "left").withColumn("goes", (F.col("kind") == TAKE) & F.col("_wanted").isNull()).drop("_wanted")
    by = Window.partitionBy("unit", "name").orderBy("ord", "kind")
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)
    events = events.withColumn("i", F.row_number().over(by)).withColumn("c", F.count_if(F.col("kind") != OWN).over(by))
    owned = F.max(F.when(F.col("kind") == OWN, F.struct("i", "c"))).over(earlier)
    went = F.coalesce(F.max(F.when(F.col("goes"), F.col("i"))).over(earlier), F.lit(0))
    return events.withColumn("_o", owned).withColumn("link", F.when(F.col("_o.i") > went, F.col("_o.c"))).drop("_o")


def record_counts(
    changes: DataFrame, unit: list[str], wanted: DataFrame | None = None, path: str = "path", old: str = "old_path",
    status: str = "status", order: str = "ord", stamp: str = "ts", commit: str = "commit",
) -> DataFrame:
    """Per unit and path that has a record in the end: touched, added, modified, deleted, renamed, first and last commit and stamp, last_status.

    ``order`` numbers the changes of a unit, oldest first, and tells them apart. Of first and last the stamp decides, then the order.
    ``wanted`` (unit and path): names that keep a record of their own when they are renamed. A record that two renames bring together
    counts twice, as it does in a walk over the changes. A rename of a name without a record is a change of the new name like any
    other. Windows are by name; without renames there are none. Null paths are left out; null units are a unit.
    """
    key = F.struct(*[F.col(c) for c in unit]).alias("unit")
    point = F.struct(F.col(stamp).alias("ts"), F.col(order).alias("ord"), F.col(commit).alias("commit"), F.col(status).alias("status")).alias("point")
    rows = changes.where(F.col(path).isNotNull()).select(key, F.col(path).alias("path"), F.col(old).alias("old"), F.substring(status, 1, 1).alias("s"), F.col(order).alias("ord"), point)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    counted: dict[str, Column] = {"touched": one} | {c: F.when(F.col("s") == k, one).otherwise(none) for c, k in COUNTS.items()}
    totals = [*[F.sum(x).alias(c) for c, x in counted.items()], F.min("point").alias("first"), F.max("point").alias("last")]
    modified = F.col("touched") - F.col("added") - F.col("deleted") - F.col("renamed")
    ends = [F.col(f"{e}.{c}").alias(f"{e}_{a}") for e in ("first", "last") for c, a in (("commit", "commit"), ("ts", "change"))]
    shown = lambda at: [*[F.col(f"{at}unit.{c}").alias(c) for c in unit], F.col(f"{at}name").alias(path), "touched", "added", modified.alias("modified"), "deleted", "renamed", *ends, F.col("last.status").alias("last_status")]
    if rows.where("s = 'R' AND old IS NOT NULL").isEmpty():  # each name has one stretch
        return cut(rows.groupBy("unit", F.col("path").alias("name")).agg(*totals).select(*shown("")))
    names = None if wanted is None else wanted.select(key, F.col(path).alias("name"), F.lit(True).alias("_wanted")).distinct()
    events = cut(_stretches(rows, names))
    node = lambda name, c: F.struct("unit", F.col(name).alias("name"), F.col(c).cast("long").alias("c"))
    own = events.where(F.col("kind") == OWN).groupBy("unit", "name", "c").agg(*totals, F.min_by(F.struct("link"), "i")["link"].alias("link"))
    lacks = lambda c: F.lit(None).cast(own.schema[c].dataType).alias(c)
    carried = [one.alias("m"), *[none.alias(c) for c in counted], lacks("first"), lacks("last")]
    nowhere = F.lit(None).cast(own.select(node("name", "c").alias("n")).schema["n"].dataType)
    mine = own.select(node("name", "c").alias("node"), nowhere.alias("parent"), one.alias("m"), *counted, "first", "last")
    before = own.where("link IS NOT NULL").select(node("name", "c").alias("node"), node("name", "link").alias("parent"), *carried)
    takes = events.where((F.col("kind") == TAKE) & F.col("link").isNotNull()).select("unit", "ord", F.col("name").alias("_from"), F.col("link").alias("_link"))
    brought = events.where(F.col("kind") == BRING).join(takes, ["unit", "ord"]).select(node("name", "c").alias("node"), node("_from", "_link").alias("parent"), *carried)
    plus = lambda c: Weight(c, lambda near, far: far(c) + far("m") * near(c), F.sum, operator.add)
    weights = [Weight("m", lambda near, far: near("m") * far("m"), F.sum, operator.add), *[plus(c) for c in counted]]
    weights += [Weight("first", lambda near, far: F.least(near("first"), far("first")), F.min, F.least), Weight("last", lambda near, far: F.greatest(near("last"), far("last")), F.max, F.greatest)]
    known = values(mine.unionByName(before).unionByName(brought), weights)
    last = events.groupBy("unit", "name").agg(F.max(F.when(F.col("kind") == OWN, F.struct("i", "c"))).alias("o"), F.max(F.when(F.col("goes"), F.col("i"))).alias("w"))
    last = last.where("o IS NOT NULL AND (w IS NULL OR o.i > w)").select(F.struct("unit", "name", F.col("o.c").cast("long").alias("c")).alias("node"))
    return last.join(known, "node").select(*shown("node."))
