"""Every registered query of the engine against its SQL on the smallest tables."""

import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__  # noqa: F401  registers the queries
from palimpsest.plans.catalog import ORACLES, QUERIES

from .conftest import SF


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(float(v)) if isinstance(v, Decimal) else str(v)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in ORACLES:
        assert rows
        return
    found = db.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in found.fetchall())
    assert rows == want
