"""Every registered query with an oracle equals its DuckDB SQL (sf0.001)."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from data_dirs import SF_SMALL
from ratekit.plans.oracle import ORACLE_SQL
from ratekit.plans.queries import REGISTRY

TABLES = ["customer", "part", "orders", "lineitem", "embeddings"]


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def _canon(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(ORACLE_SQL) & set(REGISTRY)))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).fetchdf()
    gc, gr = _canon(got)
    wc, wr = _canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["occupation", "ratings", "mean_rating"]


def test_every_query_has_callable():
    q = entry.queries()
    assert set(entry.oracle_sql()) <= set(q)
    assert all(callable(fn) for fn in q.values())
    # the library's own queries hold without the training-text ones
    assert set(ORACLE_SQL) <= set(REGISTRY) <= set(q)
    assert not any(name.startswith("op") or name == "pipeline" for name in REGISTRY)
