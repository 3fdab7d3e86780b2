"""Model-side operators on small fixtures with a planted answer (the
rows-only queries have no SQL twin)."""

import random

import pytest

from riskweave.operators import evaluate as EV
from riskweave.operators import score as S
from riskweave.operators import select as SEL

FAST_LR = S.ModelSpec("lr", "logreg", max_iter=30)
FAST_RF = S.ModelSpec("rf", "forest", num_trees=10, max_depth=4)


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(21)
    rows = []
    for i in range(240):
        y = i % 2
        rows.append((i, y, rnd.random(), y * 2.0 + rnd.random() * 0.1, rnd.random()))
    df = spark.createDataFrame(rows, "id long, y int, noise_a double, signal double, noise_b double")
    return EV.stratified_folds(df, "id", "y", 5).persist()


def test_cross_validate_reports_metrics(planted):
    r = S.cross_validate(planted, ["noise_a", "signal", "noise_b"], "y", FAST_LR)
    assert r["mean_auc"] == pytest.approx(1.0) and r["std_auc"] == pytest.approx(0.0)
    assert r["mean_cost"] == 0.0 and r["num_features"] == 3


def test_forward_selection_picks_signal_then_stops(planted):
    names, curve = SEL.forward_selection(planted, "y", 3, FAST_LR, 20, exclude=["id"], parallelism=3)
    assert names == ["signal"] and curve == [pytest.approx(1.0)]


def test_importance_ranks_signal_first(planted):
    names, table = SEL.select_by_model_importance(planted, "y", 1, FAST_RF, exclude=["id", "fold"])
    assert names == ["signal"]
    assert table.count() == 3


def test_rfe_keeps_signal(planted):
    names, curve = SEL.recursive_feature_elimination(planted, "y", FAST_RF, 0.5, 1, exclude=["id"])
    assert "signal" in names and [n for n, _ in curve] == [3, 2]


def test_compare_methods_rows(planted):
    out = SEL.compare_methods(planted, "y", {"all": ["noise_a", "signal"], "noise": ["noise_b"]},
                              specs=(FAST_LR,)).collect()
    by = {r.Method: r for r in out}
    assert set(by) == {"all", "noise"} and by["all"].Mean_roc_auc > by["noise"].Mean_roc_auc


def test_out_of_fold_covers_every_row_once(planted):
    oof = S.out_of_fold(planted, ["signal"], "y", FAST_LR, id_col="id")
    ids = [r.id for r in oof.collect()]
    assert sorted(ids) == list(range(240))


def test_select_optimal_runs_the_whole_search(spark, monkeypatch):
    from riskweave.plans import q_models as Q
    rnd = random.Random(5)
    names = [f"f{i:02d}" for i in range(12)]
    rows = [(i, i % 2, *(rnd.random() * 3 for _ in names)) for i in range(200)]
    df = EV.stratified_folds(spark.createDataFrame(rows, f"{Q.ID} long, {Q.LABEL} int, " + ", ".join(f"{n} double" for n in names)),
                             Q.ID, Q.LABEL, 5).persist()
    scored, fitted = [], []

    def cross_validate(df, features, label, spec, *args, **kwargs):  # every feature adds to the score
        scored.append((len(features), spec))
        return {"mean_auc": 0.5 + len(features) / 100, "std_auc": 0.0}

    def importance_table(df, target, features, spec):
        fitted.append((len(features), spec))
        return spark.createDataFrame([(i, f, 1.0) for i, f in enumerate(features)], "pos int, feature string, importance double")
    monkeypatch.setattr(Q, "labelled", lambda spark, sf_dir: df)
    monkeypatch.setattr(S, "cross_validate", cross_validate)
    monkeypatch.setattr(SEL, "importance_table", importance_table)
    out = Q.select_optimal(spark, "").collect()
    df.unpersist()
    assert sorted(r.feature for r in out) == names                  # no method is cut below the columns there are
    forward, compared = scored[:-8], scored[-8:]
    assert sorted(n for n, _ in forward) == sorted(n for n in range(1, 13) for _ in range(13 - n))  # every column left, every round
    assert {s for _, s in forward} == {S.BOOSTED}
    assert fitted == [(12, S.BOOSTED)] * 2
    assert compared == [(12, s) for _ in range(4) for s in (S.FOREST, S.BOOSTED)]
