"""Every SQL-backed query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = {c: i for i, c in enumerate(dcols)}
    exp = sorted((tuple(_norm(r[idx[c]]) for c in cols) for r in rel.fetchall()), key=repr)
    assert got == exp


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "SK_ID_CURR" in df.columns
