"""Cases that an earlier review found wrong."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.functions import names as N
from riskweave.operators import aggregate as agg
from riskweave.operators import encode as E
from riskweave.operators import evaluate as EV
from riskweave.operators import profile as PR


@pytest.mark.parametrize("n", [200, 300])
@pytest.mark.parametrize("reuse", ["true", "false"])
def test_label_codes_and_column_order(spark, n, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(3 * n).select(F.concat(F.lit("v"), F.lpad((F.col("id") % n).cast("string"), 5, "0")).alias("c"), "id")
        got = E.label_encode(df, ["c"])
        assert got.columns == ["c", "id"]
        assert all(r["c"] == r["id"] % n for r in got.collect())
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_dense_codes_are_unique_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        codes = E.dense_codes(spark.range(200_000).select(F.sha1(F.col("id").cast("string")).alias("v")), "v")
        lo, hi, n = codes.agg(F.min("code"), F.max("code"), F.countDistinct("code")).first()
        assert (lo, hi, n) == (0, 199_999, 200_000)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_nan_is_missing_in_medians(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, nan), (2.0, nan), (3.0, nan), (nan, nan), (nan, 4.0)], "a double, b double")
    assert E.exact_medians(df, ["a", "b"]) == {"a": 2.0, "b": 4.0}
    filled = E.median_impute(df, ["a", "b"]).collect()
    assert sorted(r["a"] for r in filled) == [1.0, 2.0, 2.0, 2.0, 3.0] and {r["b"] for r in filled} == {4.0}


def test_median_of_integers_is_not_cut(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,), (None,)], "k int")
    out = E.median_impute(df, ["k"])
    assert dict(out.dtypes)["k"] == "double" and sorted(r["k"] for r in out.collect()) == [1, 2, 2.5, 3, 10]


def test_folds_take_string_and_null_ids(spark):
    rows = [(f"id{i}", i % 2) for i in range(100)] + [(None, 0), (None, None), ("x", None)]
    folds = EV.stratified_folds(spark.createDataFrame(rows, "id string, y int"), "id", "y").collect()
    assert len(folds) == 103 and all(r["fold"] in range(5) for r in folds)
    per = {}
    for r in folds:
        per.setdefault((r["y"], r["fold"]), []).append(r)
    assert all(len(per[0, f]) in (10, 11) and len(per[1, f]) == 10 for f in range(5))


@pytest.mark.parametrize("method", ["aggregate", "gram"])
def test_constant_column_has_no_correlation(spark, method):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(0.1, float(a), float(b)) for a, b in rng.normal(size=(500, 2))], "c double, x double, y double")
    got = {(r["col_i"], r["col_j"]): r["r"] for r in PR.correlation_pairs(df, ["c", "x", "y"], method).collect()}
    assert got["c", "x"] is None and got["c", "y"] is None and got["x", "y"] is not None


def test_share_values_may_hold_backticks(spark):
    df = spark.createDataFrame([(1, "a`b"), (1, "c"), (2, "c")], "k int, c string")
    for method in ("expr", "pivot"):
        got = {r["k"]: r.asDict() for r in agg.category_shares(df, "k", "c", method=method).collect()}
        assert got[1]["c_a`b_MEAN"] == 0.5 and got[2]["c_c_MEAN"] == 1.0


def test_display_rounding_is_half_up(spark):
    df = spark.createDataFrame([(45.66,), (0.25,), (0.05,), (-0.25,), (1234567.89,)], "x double")
    assert [r[0] for r in df.select(agg.round_fixed(F.col("x"), 1)).collect()] == [45.7, 0.3, 0.1, -0.3, 1234567.9]


def test_names():
    names, mapping = N.clean_names(["a b", "a-b", "a_b", "1x", "y", "a_b_1"], target="y")
    assert names == ["a_b", "a_b_1", "a_b_2", "f_1x", "y", "a_b_1_1"]
    assert mapping == {"a b": "a_b", "a-b": "a_b_1", "a_b": "a_b_2", "1x": "f_1x", "a_b_1": "a_b_1_1"}
    assert N.revert_names(["a_b_1", "f_1x", "other"], mapping) == ["a-b", "1x", "other"]


def test_rename_by_map(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert N.rename_by_map(df, {"a": "x", "zz": "q"}).columns == ["x", "b"]


def test_logistic_penalty_is_that_of_c(spark):
    """On one 0/1 column the penalised optimum is found by hand (Newton steps on two numbers)."""
    from riskweave.operators import score as S
    rows = [(1.0, 1.0)] * 30 + [(1.0, 0.0)] * 10 + [(0.0, 1.0)] * 10 + [(0.0, 0.0)] * 50
    df = S.assembler(["x"]).transform(spark.createDataFrame(rows, "x double, label double"))
    spec = S.ModelSpec("lr", "logreg", weighting="none", max_iter=500, c=0.1)
    model = S.learner(spec, df).fit(df)
    x, y = np.array(rows).T
    a = b = 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-(a + b * x)))
        h = np.array([[(p * (1 - p)).sum(), (p * (1 - p) * x).sum()], [(p * (1 - p) * x).sum(), (p * (1 - p) * x * x).sum() + 1 / 0.1]])
        g = np.array([(y - p).sum(), ((y - p) * x).sum() - b / 0.1])
        a, b = np.array([a, b]) + np.linalg.solve(h, g)
    assert abs(model.intercept - a) < 1e-3 and abs(model.coefficients[0] - b) < 1e-3


def test_scorer_survives_a_restart(spark, tmp_path):
    from riskweave.operators import score as S
    df = spark.createDataFrame([(i, float(i % 7), float(i % 3), i % 2) for i in range(60)], "SK_ID_CURR long, u double, v double, y int")
    model, params = S.fit_pipeline(df, ["u", "v"], "y", S.LOGREG)
    S.save_scorer(model, ["u", "v"], params, 0.35, str(tmp_path / "scorer"))
    loaded = S.load_scorer(spark, str(tmp_path / "scorer"))
    assert loaded[1:] == (["u", "v"], params, 0.35)
    a = S.score(df, model, ["u", "v"], params, 0.35).collect()
    b = S.score(df, loaded[0], *loaded[1:]).collect()
    assert sorted(a) == sorted(b)


def test_client_lookup_and_lists(spark):
    from riskweave.operators import explore as X
    df = spark.createDataFrame([(3, 0.5), (1, 0.9), (3, 0.4), (None, 0.5)], "SK_ID_CURR long, TARGET_proba double")
    assert [r["TARGET_proba"] for r in X.client_by_id(df, 1).collect()] == [0.9]
    assert X.client_by_id(df, 7).collect() == [] and X.client_by_id(df, None).collect() == []
    assert [r[0] for r in X.client_ids(df).collect()] == [1, 3]
    assert X.client_ids(X.band_filter(df, "Low Risk")).collect() == []
    card = X.card_display(spark.createDataFrame([(1, 0, "TOTAL_PRICE", 1234.5), (1, 1, "SCORE_PCT", 45.66), (1, 2, "N", 2.0)],
                                                "SK_ID_CURR long, pos int, feature string, value double"))
    assert [r["display"] for r in card.orderBy("pos").collect()] == ["1,234", "45.7%", "2.00"]
