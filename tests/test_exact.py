"""Order-independent sums, means and variances, and quantile-binned mutual information."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import aggregate as A
from riskweave.operators import profile as PR
from riskweave.operators.exact import exact_mean, exact_sum, exact_var_pop, exact_var_samp


def _values(n=4000):
    rng = random.Random(7)
    return [rng.choice([rng.uniform(-1, 1), rng.uniform(0, 1e6), round(rng.uniform(0, 1e5), 2), -round(rng.uniform(0, 900), 2), 1e9 + 0.01])
            for _ in range(n)]


def test_same_bits_in_any_order(spark):
    values = _values()
    found = set()
    for seed in range(4):
        rows = values[:]
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame([(x,) for x in rows], "x double").repartition(seed * 3 + 1)
        r = df.agg(exact_sum(F.col("x")), exact_mean(F.col("x")), exact_var_pop(F.col("x")), exact_var_samp(F.col("x"))).first()
        found.add(tuple(r))
    assert len(found) == 1
    total, mean, var, _ = found.pop()
    true = sum(map(Fraction, values))
    assert abs(Fraction(total) - true) < Fraction(1, 10 ** 4) and abs(mean - float(true / len(values))) <= 1e-9 * abs(mean)
    assert math.isclose(var, np.var(values), rel_tol=1e-9)


def test_cents_of_large_amounts(spark):
    df = spark.createDataFrame([(123_456_789_012.37,), (0.01,), (-123_456_789_012.0,)] * 1000, "x double").repartition(7)
    assert math.isclose(df.agg(exact_sum(F.col("x"))).first()[0], 380.0, abs_tol=0.01)
    tens = spark.createDataFrame([(0.1,)] * 10, "x double")
    assert tens.agg(exact_sum(F.col("x"))).first()[0] == pytest.approx(1.0, abs=1e-15)


@pytest.mark.parametrize("rows, want", [
    ([], (None, None, None)), ([None], (None, None, None)), ([2.5], (2.5, 2.5, 0.0)), ([0.1, None, 0.1, 0.1], (0.3, 0.1, 0.0)),
    ([float("inf"), 1.0], (math.inf, math.inf, None)), ([-3.0, -0.25], (-3.25, -1.625, 1.890625))])
def test_edges(spark, rows, want):
    r = spark.createDataFrame([(x,) for x in rows], "x double").agg(exact_sum(F.col("x")), exact_mean(F.col("x")), exact_var_pop(F.col("x"))).first()
    for got, w, strict in zip(r, want, (True, True, want[2] is not None)):
        if strict:
            assert got is None if w is None else got == pytest.approx(w, abs=1e-12)


def test_nan_shows(spark):
    r = spark.createDataFrame([(1.0,), (float("nan"),)], "x double").agg(exact_sum(F.col("x"))).first()
    assert math.isnan(r[0])


def test_grouped_aggregates_use_them(spark):
    values = _values(3000)
    df = spark.createDataFrame([(k % 3, x) for k, x in enumerate(values)], "k long, x double")
    spec = {"x": ["sum", "mean", "var", "std_pop"]}
    frames = [A.grouped_agg(d, "k", spec).orderBy("k").collect() for d in (df.repartition(2), df.orderBy(F.desc("x")).repartition(9))]
    assert frames[0] == frames[1]
    for r in frames[0]:
        own = values[r["k"]::3]
        assert math.isclose(r["x_SUM"], math.fsum(own), rel_tol=1e-12) and math.isclose(r["x_VAR"], np.var(own, ddof=1), rel_tol=1e-9)


def _mi(values, labels, bins):
    order = sorted(values)
    bin_of = [min(bins - 1, bins * order.index(v) // len(values)) for v in values]
    n, out = len(values), 0.0
    for b in set(bin_of):
        for y in set(labels):
            nxy = sum(p == b and q == y for p, q in zip(bin_of, labels))
            if nxy:
                out += nxy / n * math.log(nxy * n / (bin_of.count(b) * labels.count(y)))
    return out


def test_mutual_information_of_quantile_bins(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 500)
    wide = np.exp(rng.normal(size=500) * 4 + y)          # long tail: equal widths would put nearly all into one bin
    ties = np.where(rng.random(500) < 0.6, 5.0, rng.integers(0, 9, 500)) + 0.0
    rows = [(float(a), float(b), 1.0, int(c)) for a, b, c in zip(wide, ties, y)] + [(None, float("nan"), None, 1), (1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "wide double, ties double, one double, y int").repartition(5)
    for stretches in (64, 4):  # few stretches: many values in each
        got = {r["feature"]: r["mi"] for r in PR.mutual_info_binned(df, ["wide", "ties", "one"], "y", 10, stretches).collect()}
        assert got["wide"] == pytest.approx(_mi(wide.tolist(), y.tolist(), 10), abs=1e-9)
        assert got["ties"] == pytest.approx(_mi(ties.tolist(), y.tolist(), 10), abs=1e-9)
        assert got["one"] == 0.0
    logged = df.withColumn("wide", F.log("wide"))
    assert {r["feature"]: r["mi"] for r in PR.mutual_info_binned(logged, ["wide"], "y").collect()}["wide"] == got["wide"]
