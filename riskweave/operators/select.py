"""Feature selection.

Filters are one statistics pass each (missing share, population variance,
pairwise correlation, ANOVA F). Wrapper methods are driver loops over Spark
fits; what does not change between rounds is computed once (F scores, the
current best score), and candidate fits run from a thread pool.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import names as N
from riskweave.operators import encode as E
from riskweave.operators import profile as PR
from riskweave.operators import score as S


def _candidates(df: DataFrame, target: str, exclude: Sequence[str] | None) -> list[str]:
    ex = set(exclude or ()) | {target}
    return [c for c, t in df.dtypes if c not in ex and t not in ("string",)
            and not t.startswith(("array", "map", "struct"))]


def remove_high_missing(df: DataFrame, threshold: float = 0.9,
                        exclude: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """M1 (None exclude = nothing excluded)."""
    return E.drop_high_missing(df, threshold, exclude=exclude or ())


def remove_low_variance(df: DataFrame, target: str, threshold: float = 0.01,
                        exclude: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """M2: population variance must be strictly above the threshold."""
    cols = _candidates(df, target, exclude)
    if not cols:
        return df, []
    rows = PR.variance_table(df, cols, threshold).where(~F.col("kept")).select("column_name").collect()
    dropped = [c for c in cols if c in {r[0] for r in rows}]
    return df.drop(*dropped), dropped


def remove_high_correlation(df: DataFrame, target: str, threshold: float = 0.95,
                            exclude: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """M3: upper-triangle rule in column order."""
    cols = _candidates(df, target, exclude)
    if len(cols) < 2:
        return df, []
    dropped = PR.correlated_to_drop(PR.correlation_pairs(df, cols), cols, threshold)
    return df.drop(*dropped), dropped


def select_by_univariate(df: DataFrame, target: str, k: int = 100, method: str = "f_classif",
                         exclude: Sequence[str] | None = None) -> tuple[list[str], DataFrame]:
    """M4: top k by ANOVA F (or binned MI), names in column order + scores."""
    cols = _candidates(df, target, exclude)
    if method == "f_classif":
        scores = PR.anova_f(df, cols, target).withColumnRenamed("f_score", "score")
    elif method == "mutual_info":
        scores = PR.mutual_info_binned(df, cols, target).withColumnRenamed("mi", "score")
    else:
        raise ValueError(f"no score called {method!r}: known are f_classif and mutual_info")
    best = PR.top_k_by_score(scores, k, "score").collect()
    return [r["feature"] for r in best], scores


def importance_table(df: DataFrame, target: str, features: Sequence[str],
                     spec: S.ModelSpec) -> DataFrame:
    """(pos, feature, importance) of a tree model fitted on all rows."""
    model, _ = S.fit_pipeline(df, features, target, spec)
    imp = S.importances(model, features)
    return df.sparkSession.createDataFrame([(i, f, float(v)) for i, (f, v) in enumerate(imp)],
                                           "pos int, feature string, importance double")


def select_by_model_importance(df: DataFrame, target: str, k: int = 100,
                               spec: S.ModelSpec = S.FOREST,
                               exclude: Sequence[str] | None = None) -> tuple[list[str], DataFrame]:
    """M6: top k by importance (ties by column order)."""
    cols = _candidates(df, target, exclude)
    table = importance_table(df, target, cols, spec)
    top = table.orderBy(F.col("importance").desc(), "pos").limit(k).collect()
    return [r["feature"] for r in top], table


def forward_selection(df: DataFrame, target: str, k: int = 30, spec: S.ModelSpec = S.BOOSTED,
                      max_candidates: int = 20, fold_col: str = "fold",
                      exclude: Sequence[str] | None = None, parallelism: int = 8) -> tuple[list[str], list[float]]:
    """M7: greedy forward selection by mean CV AUC.

    Each round tries the best ``max_candidates`` unselected features by F
    (F does not depend on the round, so it is computed once); the best
    candidate is added only if it beats the current score (the previous
    round's best, not re-fitted); otherwise the search stops."""
    ex = list(exclude or ()) + [fold_col]
    cols = _candidates(df, target, ex)
    # Every candidate fit reads the same few columns: persist them once.
    df = df.select(*cols, target, fold_col).persist(StorageLevel.MEMORY_AND_DISK)
    f_scores = {r["feature"]: (r["f_score"], r["pos"])
                for r in PR.anova_f(df, cols, target).collect()}
    selected: list[str] = []
    curve: list[float] = []
    current = 0.0
    for _ in range(min(k, len(cols))):
        unselected = [c for c in cols if c not in selected]
        if len(unselected) > max_candidates:
            ranked = sorted(unselected, key=lambda c: (-(f_scores[c][0] if f_scores[c][0] is not None
                                                         else float("-inf")), -f_scores[c][1]))
            keep = set(ranked[:max_candidates])
            cand = [c for c in unselected if c in keep]
        else:
            cand = unselected

        def evaluate(c):
            try:
                return c, S.cv_auc(df, selected + [c], target, spec, fold_col, parallelism=1)
            except IllegalArgumentException as e:  # the learner refuses the data; lost executors are Spark's to retry
                warnings.warn(f"{c} is left out: {e}", stacklevel=2)
                return c, None

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            results = list(pool.map(evaluate, cand))
        best_c, best_s = None, current
        for c, s in results:          # candidate order: first best wins
            if s is not None and s > best_s:
                best_c, best_s = c, s
        if best_c is None:
            break
        selected.append(best_c)
        curve.append(best_s)
        current = best_s
    df.unpersist()
    return selected, curve


def recursive_feature_elimination(df: DataFrame, target: str, spec: S.ModelSpec = S.BOOSTED,
                                  step: float = 0.2, min_features: int = 50, fold_col: str = "fold",
                                  exclude: Sequence[str] | None = None) -> tuple[list[str], list[tuple[int, float]]]:
    """M8: score, drop max(1, floor(step * n)) least important, never below
    ``min_features``; best count by CV AUC; final pick = top-n importance of
    the model on all candidate features. With no more than ``min_features``
    candidates, all are returned (nothing to eliminate)."""
    ex = list(exclude or ()) + [fold_col]
    cols = _candidates(df, target, ex)
    df = df.select(*cols, target, fold_col).persist(StorageLevel.MEMORY_AND_DISK)
    current = list(cols)
    curve: list[tuple[int, float]] = []
    while len(current) > min_features:
        curve.append((len(current), S.cv_auc(df, current, target, spec, fold_col)))
        imp = sorted(importance_table(df, target, current, spec).collect(),
                     key=lambda r: (r["importance"], r["pos"]))
        n_drop = min(max(1, int(len(current) * step)), len(current) - min_features)
        if n_drop <= 0:
            break
        drop = {r["feature"] for r in imp[:n_drop]}
        current = [c for c in current if c not in drop]
    if not curve:
        df.unpersist()
        return cols, curve
    best_n = max(curve, key=lambda t: t[1])[0]
    full = importance_table(df, target, cols, spec).orderBy(F.col("importance").desc(), "pos").limit(best_n)
    out = [r["feature"] for r in full.collect()]
    df.unpersist()
    return out, curve


def importance_top_then_cut(df: DataFrame, target: str, k: int = 50, cut: int = 30,
                            spec: S.ModelSpec = S.BOOSTED, exclude: Sequence[str] | None = None) -> list[str]:
    """What the reference's orchestrator calls RFE: importance top k, cut to ``cut``."""
    names, _ = select_by_model_importance(df, target, k, spec, exclude)
    return names[:cut]


def compare_methods(df: DataFrame, target: str, methods: Mapping[str, Sequence[str]],
                    specs: Sequence[S.ModelSpec] = (S.FOREST, S.BOOSTED),
                    fold_col: str = "fold") -> DataFrame:
    """Each method x model -> mean / sd AUC; failures are skipped."""
    rows = []
    for name, feats in methods.items():
        for spec in specs:
            try:
                r = S.cross_validate(df, list(feats), target, spec, fold_col)
            except IllegalArgumentException as e:  # the learner refuses the data; lost executors are Spark's to retry
                warnings.warn(f"{name} with {spec.name} is left out: {e}", stacklevel=2)
                continue
            rows.append((len(rows), name, spec.name, len(feats), r["mean_auc"], r["std_auc"]))
    return df.sparkSession.createDataFrame(
        rows, "pos int, Method string, Model string, Num_Features int, Mean_roc_auc double, Std_roc_auc double")


def select_optimal_features(train: DataFrame, target: str, id_col: str, fold_col: str = "fold",
                            test: DataFrame | None = None,
                            k_univariate: int = 100, k_importance: int = 100, k_forward: int = 30,
                            forward_spec: S.ModelSpec = S.BOOSTED,
                            importance_spec: S.ModelSpec = S.BOOSTED, forward_candidates: int = 20,
                            compare_specs: Sequence[S.ModelSpec] = (S.FOREST, S.BOOSTED)) -> dict:
    """Clean names -> missing .9 -> variance .01 -> correlation .95 ->
    univariate / importance / forward / importance-cut -> compare -> best by
    AUC -> original names."""
    keep = [id_col, fold_col]
    cleaned, mapping = N.clean_feature_names(train, target)
    cleaned = cleaned.persist(StorageLevel.MEMORY_AND_DISK)  # every step reads the features, which come from whole texts
    mapped_keep = [mapping.get(c, c) for c in keep]
    df, miss = remove_high_missing(cleaned, 0.9, exclude=[target, *mapped_keep])
    df, low = remove_low_variance(df, target, 0.01, exclude=mapped_keep)
    df, corr = remove_high_correlation(df, target, 0.95, exclude=mapped_keep)
    uni, _ = select_by_univariate(df, target, k_univariate, exclude=mapped_keep)
    imp, _ = select_by_model_importance(df, target, k_importance, importance_spec, exclude=mapped_keep)
    fwd, _ = forward_selection(df, target, k_forward, forward_spec, forward_candidates,
                               fold_col=mapped_keep[1], exclude=mapped_keep[:1])
    cut = importance_top_then_cut(df, target, 50, 30, importance_spec, exclude=mapped_keep)
    methods = {"univariate": uni, "importance": imp, "forward": fwd, "importance_cut": cut}
    methods = {k: v for k, v in methods.items() if v}
    table = compare_methods(df, target, methods, specs=compare_specs, fold_col=mapped_keep[1])
    best = table.orderBy(F.col("Mean_roc_auc").desc_nulls_last(), "pos").first()
    cleaned.unpersist()
    chosen = methods[best["Method"]] if best else []
    features = N.revert_names(chosen, mapping)
    out = {"dropped": {"missing": miss, "variance": low, "correlation": corr},
           "methods": methods, "comparison": table, "best_method": best["Method"] if best else None,
           "features": features,
           # the selected frames: features in selection order, label and id carried
           "train": train.select(*features, target, id_col)}
    if test is not None:
        out["test"] = test.select(*features, id_col)
    return out
