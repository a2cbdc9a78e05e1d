"""What lies in folders: repositories below a root, the files of their active copies, inventories of trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.paths import ext_key, leaf


def below(paths: DataFrame, root: str, path: str = "path") -> DataFrame:
    """(org, repo, rel) of the files at <root>/<org>/<repo>/<rel>; others are left out."""
    plain = F.regexp_replace(path, r"\A[a-z0-9]+:/*(?=/)", "")
    base = root.rstrip("/") + "/"
    parts = F.split(F.substring("_p", len(base) + 1, 1 << 30), "/")
    rows = paths.select(plain.alias("_p")).where(F.col("_p").startswith(base)).select(parts.alias("_s")).where(F.size("_s") > 2)
    return rows.select(F.col("_s")[0].alias("org"), F.col("_s")[1].alias("repo"), F.array_join(F.slice("_s", F.lit(3), F.size("_s")), "/").alias("rel"))


def repositories(files: DataFrame) -> DataFrame:
    """(org, repo, kind) of the folders that are repositories: 'worktree' with a .git folder or file, 'bare' with HEAD and objects of their own."""
    top = F.substring_index("rel", "/", 1)
    has = files.groupBy("org", "repo").agg(F.bool_or(top == ".git").alias("_git"), F.bool_or(F.col("rel") == "HEAD").alias("_head"), F.bool_or(top == "objects").alias("_objects"))
    return has.select("org", "repo", F.when(F.col("_git"), "worktree").when(F.col("_head") & F.col("_objects"), "bare").alias("kind")).where("kind IS NOT NULL")


def active_files(files: DataFrame, exts: list[str] | None = None) -> DataFrame:
    """(org, repo, path, ext) of the active copies: whatever lies in a folder .git, at any depth, is left out; ``exts``: only these extensions."""
    rows = files.where(~F.col("rel").rlike(r"(?:^|/)\.git/")).select("org", "repo", F.col("rel").alias("path"), ext_key(F.col("rel")).alias("ext")).distinct()
    return rows if exts is None else rows.where(F.col("ext").isin(exts))


def inventory(files: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a file list for whole trees: the keys, relpath (the folder, '' at the top), filename; of ``files`` with the keys and path."""
    folder = F.when(F.contains("path", F.lit("/")), F.regexp_extract("path", r"(?s)\A(.*)/[^/]*\z", 1)).otherwise("")
    return files.select(*keys, folder.alias("relpath"), leaf(F.col("path")).alias("filename"))


def routes_by_type(rows: DataFrame, status: str = "status", path: str = "path") -> DataFrame:
    """(type, inner) with how many files went as text, whole, were left out as programs, or gave no text."""
    from palimpsest.functions.routes import PROGRAM, type_and_inner

    whole = F.col(status).isin("binary", "partly_binary")
    way = F.when(F.col(status) == "ok", "text").when(whole, F.when(F.col(path).rlike(PROGRAM), "left_out").otherwise("whole")).otherwise("no_text")
    kinds = rows.select(type_and_inner(F.col(path)).alias("t"), way.alias("way"))
    return kinds.groupBy("t.type", "t.inner").agg(*[F.count_if(F.col("way") == w).alias(w) for w in ("text", "whole", "left_out", "no_text")])
