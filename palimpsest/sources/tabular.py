"""Delimited files with a header: the delimiter is found from the header line; rows of a wrong width are set apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Delimiters that are tried (fixed values).
DELIMITERS = [",", "\t", "|", ";"]


def sniff(header: str) -> str:
    """The delimiter that the header line has most of; a comma if it has none."""
    return max(DELIMITERS, key=lambda d: (header.count(d), -DELIMITERS.index(d)))


def read_table(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    """All cells as text, with ``_bad``: the raw row where its width is wrong. Only the first line comes to the driver."""
    first = spark.read.text(path).first()
    header = first[0].lstrip("\ufeff") if first else ""
    sep = sniff(header)
    names = [n.strip().strip('"') for n in header.split(sep)] if header else []
    missing = [c for c in required or [] if c not in names]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
    schema = ", ".join(f"`{n}` string" for n in [*names, "_bad"])
    return spark.read.csv(path, schema=schema, header=True, sep=sep, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", enforceSchema=True, multiLine=True, escape='"')


def finished(rows: DataFrame, runs: DataFrame, unit: list[str], status: str = "status") -> DataFrame:
    """Rows of units whose last run was ok."""
    return rows.join(runs.where(F.col(status) == "ok").select(*unit).distinct(), unit, "left_semi")


def not_done(batch: DataFrame, runs: DataFrame, unit: list[str], status: str = "status", retry: list[str] | None = None) -> DataFrame:
    """Units still to be run: never run, or their status is one to try again."""
    done = runs.where(~F.col(status).isin(retry or [])) if retry else runs
    return batch.join(done.select(*unit).distinct(), unit, "left_anti")
