"""Golden cases worked out by hand for the data operators (FIXTURES.md §1, §4)."""

import math

import pytest
from pyspark.sql import functions as F

from riskweave.functions import names as N
from riskweave.operators import aggregate as agg
from riskweave.operators import encode as E
from riskweave.operators import evaluate as EV
from riskweave.operators import profile as PR
from riskweave.operators import select as SEL
from riskweave.plans import features as feat


@pytest.fixture(scope="module")
def mock_train(spark):
    rows = [(100001, 0, 0.5, 0.7, 0.3, 1), (100002, 1, 0.6, 0.7, 0.4, 0),
            (100003, 0, None, 0.7, 0.5, 1), (100004, 1, 0.8, 0.7, 0.6, 0),
            (100005, 0, 0.9, 0.7, 0.7, 1)]
    return spark.createDataFrame(rows, "SK_ID_CURR long, TARGET long, EXT_SOURCE_1 double, "
                                       "EXT_SOURCE_2 double, EXT_SOURCE_3 double, "
                                       "`NAME_EDUCATION_TYPE_Higher education` int")


def test_mock_shape(mock_train):
    assert mock_train.count() == 5 and len(mock_train.columns) == 6


def test_missing_filter_strict(mock_train):
    _, dropped = SEL.remove_high_missing(mock_train, 0.2, exclude=["TARGET"])
    assert dropped == []          # 0.2 is not > 0.2
    _, dropped = SEL.remove_high_missing(mock_train, 0.19, exclude=None)
    assert dropped == ["EXT_SOURCE_1"]


def test_variance_filter(mock_train):
    _, dropped = SEL.remove_low_variance(mock_train, "TARGET", 0.01, exclude=["SK_ID_CURR"])
    assert dropped == ["EXT_SOURCE_2"]
    v = {r["column_name"]: r["variance"] for r in PR.variance_table(
        mock_train, ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
                     "NAME_EDUCATION_TYPE_Higher education"]).collect()}
    assert v["EXT_SOURCE_1"] == pytest.approx(0.025)
    assert v["EXT_SOURCE_2"] == pytest.approx(0.0)
    assert v["EXT_SOURCE_3"] == pytest.approx(0.02)
    assert v["NAME_EDUCATION_TYPE_Higher education"] == pytest.approx(0.24)


def test_correlation_filter(mock_train):
    _, dropped = SEL.remove_high_correlation(mock_train, "TARGET", 0.9, exclude=["SK_ID_CURR"])
    assert dropped == ["EXT_SOURCE_3"]    # r = 1 with EXT_SOURCE_1 on the 4 shared rows
    pairs = PR.correlation_pairs(mock_train, ["EXT_SOURCE_1", "EXT_SOURCE_2"]).collect()
    assert pairs[0]["r"] is None           # constant column: no r


def test_anova_f_edge_cases(mock_train):
    cols = ["EXT_SOURCE_2", "EXT_SOURCE_3", "NAME_EDUCATION_TYPE_Higher education"]
    f = {r["feature"]: r["f_score"] for r in PR.anova_f(mock_train, cols, "TARGET").collect()}
    assert f["EXT_SOURCE_2"] is None
    assert f["EXT_SOURCE_3"] == pytest.approx(0.0)
    assert f["NAME_EDUCATION_TYPE_Higher education"] == math.inf
    top = PR.top_k_by_score(PR.anova_f(mock_train, cols, "TARGET"), 2).collect()
    assert [r["feature"] for r in top] == ["EXT_SOURCE_3", "NAME_EDUCATION_TYPE_Higher education"]


def test_clean_names():
    assert N.clean_name("NAME_EDUCATION_TYPE_Higher education") == "NAME_EDUCATION_TYPE_Higher_education"
    assert N.clean_name("A / B") == "A___B"
    assert N.clean_name("1x") == "f_1x"
    names, mapping = N.clean_names(["a_b", "a b", "TARGET"], target="TARGET")
    assert names == ["a_b", "a_b_1", "TARGET"]
    assert N.revert_names(["a_b_1"], mapping) == ["a b"]


def test_two_level_golden(spark):
    links = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (3, 30)], "SK_ID_CURR long, SK_ID_PREV long")
    ins = spark.createDataFrame(
        [(10, 100.0, 50.0, -30.0, -25.0, 1.0), (10, 0.0, 10.0, -20.0, -22.0, 2.0),
         (11, 50.0, 50.0, -10.0, None, 1.0), (20, None, 30.0, -5.0, -5.0, None),
         (99, 7.0, 7.0, -1.0, -1.0, 1.0)],
        "SK_ID_PREV long, AMT_INSTALMENT double, AMT_PAYMENT double, DAYS_INSTALMENT double, "
        "DAYS_ENTRY_PAYMENT double, NUM_INSTALMENT_VERSION double")
    rows = feat.instalment_row_features(ins)
    spec = {"NUM_INSTALMENT_VERSION": ["nunique"], "AMT_INSTALMENT": ["sum"], "PAYMENT_RATIO": ["mean"],
            "DAYS_LATE": ["max", "sum"], "IS_LATE": ["mean"], "DAYS_INSTALMENT": ["size"]}
    lvl1 = {r["SK_ID_PREV"]: r for r in agg.grouped_agg(rows, "SK_ID_PREV", spec, "INS_").collect()}
    assert lvl1[10]["INS_DAYS_INSTALMENT_SIZE"] == 2 and lvl1[10]["INS_NUM_INSTALMENT_VERSION_NUNIQUE"] == 2
    assert lvl1[10]["INS_AMT_INSTALMENT_SUM"] == 100 and lvl1[10]["INS_PAYMENT_RATIO_MEAN"] == 0.25
    assert lvl1[11]["INS_DAYS_LATE_MAX"] is None and lvl1[11]["INS_DAYS_LATE_SUM"] == 0
    assert lvl1[20]["INS_AMT_INSTALMENT_SUM"] == 0 and lvl1[20]["INS_NUM_INSTALMENT_VERSION_NUNIQUE"] == 0
    out = {r["SK_ID_CURR"]: r for r in agg.two_level_agg(rows, links, "SK_ID_PREV", "SK_ID_CURR", spec, "INS").collect()}
    c1 = out[1]
    assert c1["INS_INS_DAYS_INSTALMENT_SIZE_MEAN"] == 1.5 and c1["INS_INS_DAYS_INSTALMENT_SIZE_MAX"] == 2
    assert c1["INS_INS_AMT_INSTALMENT_SUM_MEAN"] == 75 and c1["INS_INS_AMT_INSTALMENT_SUM_MAX"] == 100
    assert c1["INS_INS_PAYMENT_RATIO_MEAN_MEAN"] == 0.625 and c1["INS_INS_PAYMENT_RATIO_MEAN_MAX"] == 1
    assert c1["INS_INS_DAYS_LATE_MAX_MEAN"] == 5 and c1["INS_INS_DAYS_LATE_SUM_MEAN"] == 2.5
    assert c1["INS_INS_IS_LATE_MEAN_MEAN"] == 0.25 and c1["INS_INS_IS_LATE_MEAN_MAX"] == 0.5
    assert out[2]["INS_INS_DAYS_INSTALMENT_SIZE_MEAN"] == 1 and out[2]["INS_INS_AMT_INSTALMENT_SUM_MAX"] == 0
    assert all(out[3][c] is None for c in out[3].asDict() if c != "SK_ID_CURR")
    assert set(out) == {1, 2, 3}       # loan 99 vanished


def test_latest_non_null_golden(spark):
    df = spark.createDataFrame([(1, 5, -300.0, 2.0, 1.0), (1, 6, -100.0, None, None), (1, 7, -100.0, None, None),
                                (2, 8, -50.0, None, 4.0), (2, 9, None, None, 5.0)],
                               "k long, id long, DAYS double, S double, T double")
    ex = agg.latest_non_null(df, "k", "DAYS", "id", ["DAYS", "S", "T"], prefix="R_")
    r = {x["k"]: x for x in agg.grouped_agg(df, "k", {}, extra=ex).collect()}
    assert (r[1]["R_DAYS"], r[1]["R_S"], r[1]["R_T"]) == (-100.0, 2.0, 1.0)
    assert (r[2]["R_DAYS"], r[2]["R_S"], r[2]["R_T"]) == (-50.0, None, 5.0)


def test_category_share_golden(spark):
    df = spark.createDataFrame([(5, 0, "0"), (5, -1, "C"), (5, -2, "0"), (5, -3, None), (6, 0, "X")],
                               "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string")
    out = {r["SK_ID_BUREAU"]: r for r in feat.bureau_balance_agg(df).collect()}
    assert out[5]["STATUS_0_MEAN"] == 0.5 and out[5]["STATUS_C_MEAN"] == 0.25 and out[5]["STATUS_X_MEAN"] == 0
    assert (out[5]["MONTHS_BALANCE_MIN"], out[5]["MONTHS_BALANCE_MAX"], out[5]["MONTHS_BALANCE_SIZE"]) == (-3, 0, 4)
    assert out[6]["STATUS_X_MEAN"] == 1 and out[6]["MONTHS_BALANCE_SIZE"] == 1


def test_cost_and_auc_golden(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.3), (0, 0.4), (0, 0.1), (1, 0.5)], "y int, p double")
    cost = {r["threshold"]: r["cost"] for r in EV.business_cost(df, "p", "y", [0.2, 0.35, 0.5]).collect()}
    assert cost == {0.2: 1, 0.35: 11, 0.5: 10}
    assert EV.roc_auc(df, "p", "y").first()["auc"] == pytest.approx(5 / 6)


def test_label_codes_golden(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "c string")
    assert [r["c"] for r in E.label_encode(df, ["c"]).collect()] == [2, 1, 1, 0]


def test_median_golden(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert E.medians(df, ["x"])["x"] == 2.5
    assert E.median_impute(df, ["x"]).agg(F.sum("x")).first()[0] == 18.5
