"""Generated inputs: the quantiser and its DuckDB twin agree on any double;
safe ratios never raise."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from riskweave.functions.scalar import safe_ratio
from riskweave.operators.aggregate import round_doubles
from riskweave.plans.oracle import grid

finite = st.floats(allow_nan=False, allow_infinity=False, width=64)
# decimal data with 7 digits: lands on halves of the kept digit
decimals = st.integers(min_value=-10**9, max_value=10**9).map(lambda i: i / 1e7)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(finite, decimals, st.integers(-10**6, 10**6).map(lambda i: i / 32.0)),
                min_size=1, max_size=200))
def test_quantiser_twin_agrees(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r[0] for r in round_doubles(df).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(i, float(x)) for i, x in enumerate(xs)])
    exp = [r[0] for r in con.execute(f"SELECT {grid('x')} FROM t ORDER BY i").fetchall()]
    assert got == exp


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), finite), st.one_of(st.none(), st.just(0.0), finite)),
                min_size=1, max_size=50))
def test_safe_ratio_total(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double")
    out = [r[0] for r in df.select(safe_ratio("a", "b")).collect()]
    for (a, b), v in zip(pairs, out):
        if a is None or b is None or b == 0.0:
            assert v == 0.0
