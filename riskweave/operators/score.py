"""Models, cross-validation and scoring.

Learners are ``pyspark.ml`` estimators; the reference's leaf-wise boosted
trees become ``GBTClassifier`` (another algorithm: compare by AUC band, not
by value). Cross-validation fits the k folds from a thread pool on one
persisted, assembled frame; scores are computed out-of-fold in Spark and
reduced by the exact AUC / cost operators, so no predictions are collected.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.scalar import threshold_label
from riskweave.operators import encode as E
from riskweave.operators import evaluate as EV

FEATURES_COL, WEIGHT_COL = "features", "weight"


@dataclass(frozen=True)
class ModelSpec:
    name: str
    kind: str                 # logreg | forest | gbt
    weighting: str = "balanced"   # balanced | pos10 | none
    max_iter: int = 100
    num_trees: int = 50
    max_depth: int = 5
    seed: int = 42
    c: float = 1.0            # inverse strength of the logistic regression's L2 penalty

    def estimator(self, total_weight: float | None = None):
        """The learner. ``total_weight`` (of the training rows) scales the L2 penalty:
        C times the summed loss plus half the squared norm is the mean loss plus
        1 / (C * total weight) of that norm."""
        common = dict(featuresCol=FEATURES_COL, labelCol="label")
        if self.weighting != "none":
            common["weightCol"] = WEIGHT_COL
        if self.kind == "logreg":
            penalty = 1.0 / (self.c * total_weight) if total_weight else 0.0
            return LogisticRegression(maxIter=self.max_iter, regParam=penalty, elasticNetParam=0.0,
                                      standardization=False, **common)
        if self.kind == "forest":
            return RandomForestClassifier(numTrees=self.num_trees, maxDepth=self.max_depth,
                                          seed=self.seed, **common)
        if self.kind == "gbt":
            return GBTClassifier(maxIter=self.max_iter, maxDepth=self.max_depth, seed=self.seed, **common)
        raise ValueError(f"unknown model kind {self.kind!r}")


# The reference's four learners (LR 1000 iterations, forest 50 trees,
# boosted 100 rounds balanced, boosted 100 rounds positives x10). Forest
# depth is unlimited in the reference; Spark caps depth at 30, 12 is used.
LOGREG = ModelSpec("LogisticRegression", "logreg", max_iter=1000)
FOREST = ModelSpec("RandomForest", "forest", num_trees=50, max_depth=12)
BOOSTED = ModelSpec("GBT_balanced", "gbt", max_iter=100)
BOOSTED_POS10 = ModelSpec("GBT_pos10", "gbt", weighting="pos10", max_iter=100)
REFERENCE_MODELS = (LOGREG, FOREST, BOOSTED, BOOSTED_POS10)


ROWS_PER_PARTITION = 100_000   # training rows per task; each boosting round / tree level is a job


def prepare(df: DataFrame, features: Sequence[str], label: str, scale: bool = True,
            weighting: str = "balanced") -> tuple[DataFrame, dict]:
    """Scale (population sd, sd 0 -> 1), cast the label to double, attach the
    class weight, size partitions to the row count. Returns the frame and the
    scaler parameters.

    Class counts come back as k numbers, so the weights enter the plan as
    literals. Iterative learners run one job per round or tree level; a
    small table spread over many partitions pays task overhead on every job,
    so it is repartitioned to ceil(n / ROWS_PER_PARTITION) partitions (only
    ever fewer than it had; large tables keep their parallelism).
    """
    params = E.standardise_params(df, list(features)) if scale else {}
    out = E.standardise(df, list(features), params) if scale else df
    out = out.withColumn("label", F.col(label).cast("double"))
    counts = {r["label"]: r["n"] for r in
              out.where(F.col("label").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    if weighting != "none" and counts:
        w = None
        for c, nc in sorted(counts.items()):
            val = n / (len(counts) * nc) if weighting == "balanced" else (10.0 if c == 1 else 1.0)
            w = (F.when(F.col("label") == F.lit(c), F.lit(float(val))) if w is None
                 else w.when(F.col("label") == F.lit(c), F.lit(float(val))))
        out = out.withColumn(WEIGHT_COL, w)
    target = max(1, -(-n // ROWS_PER_PARTITION))
    try:
        current = out.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view on Spark Connect
        current = 0
    if target * 2 <= current:
        out = out.repartition(target)
    return out, params


def learner(spec: ModelSpec, data: DataFrame):
    """The learner of ``spec`` for ``data``; only a penalised one needs the rows' total weight."""
    if spec.kind != "logreg":
        return spec.estimator()
    weight = F.col(WEIGHT_COL) if WEIGHT_COL in data.columns else F.lit(1.0)
    return spec.estimator(data.agg(F.sum(weight)).first()[0])


def save_scorer(model: PipelineModel, features: Sequence[str], params: Mapping[str, tuple[float, float]],
                threshold: float, path: str) -> None:
    """All that scoring needs, in one folder: model, feature contract, scaler parameters, threshold."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    rows = [(k, f, *map(float, params.get(f, (0.0, 1.0))), float(threshold)) for k, f in enumerate(features)]
    (spark.createDataFrame(rows, "pos int, feature string, mean double, sd double, threshold double")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/contract"))


def load_scorer(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str], dict[str, tuple[float, float]], float]:
    """(model, features, scaler parameters, threshold) of a folder written by :func:`save_scorer`."""
    rows = spark.read.parquet(f"{path}/contract").orderBy("pos").collect()  # a row per feature
    return (PipelineModel.load(f"{path}/model"), [r["feature"] for r in rows],
            {r["feature"]: (r["mean"], r["sd"]) for r in rows}, rows[0]["threshold"])


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES_COL, handleInvalid="keep")


def positive_proba(pred: DataFrame, out: str = "TARGET_proba") -> DataFrame:
    """Probability of class 1."""
    return pred.withColumn(out, vector_to_array(F.col("probability")).getItem(1))


def cross_validate(df: DataFrame, features: Sequence[str], label: str, spec: ModelSpec,
                   fold_col: str = "fold", k: int = 5, threshold: float = 0.5,
                   parallelism: int = 4) -> dict:
    """Mean / population sd of the exact AUC and the 10·FN + FP cost
    over k folds. ``df`` must carry ``fold_col`` (see stratified_folds)."""
    src = df.select(*features, label, fold_col).persist(StorageLevel.MEMORY_AND_DISK)
    prep, _ = prepare(src, features, label, weighting=spec.weighting)
    data = assembler(features).transform(prep).select(FEATURES_COL, "label", fold_col,
                                                      *([WEIGHT_COL] if spec.weighting != "none" else []))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)

    def fit(f: int):
        return learner(spec, part := data.where(F.col(fold_col) != f)).fit(part)

    t0 = time.time()
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            models = list(pool.map(fit, range(k)))
        # Out-of-fold scores of all folds, then one grouped pass per metric.
        oof = None
        for f, m in enumerate(models):
            part = positive_proba(m.transform(data.where(F.col(fold_col) == f))).select(
                fold_col, "label", "TARGET_proba")
            oof = part if oof is None else oof.unionByName(part)
        oof = oof.persist(StorageLevel.MEMORY_AND_DISK)
        aucs_by = {r[fold_col]: r["auc"] for r in
                   EV.roc_auc(oof, "TARGET_proba", "label", group=[fold_col]).collect()}
        cost_by = {r[fold_col]: r["cost"] for r in
                   EV.business_cost(oof, "TARGET_proba", "label", [threshold], group=[fold_col]).collect()}
        oof.unpersist()
    finally:
        data.unpersist()
        src.unpersist()
    aucs = [aucs_by[f] for f in range(k) if aucs_by.get(f) is not None]
    costs = [cost_by[f] for f in range(k) if f in cost_by]

    def mean(xs):
        return sum(xs) / len(xs) if xs else None

    def sd(xs):
        m = mean(xs)
        return (sum((x - m) ** 2 for x in xs) / len(xs)) ** 0.5 if xs else None

    return {"model": spec.name, "num_features": len(features), "mean_auc": mean(aucs),
            "std_auc": sd(aucs), "mean_cost": mean([float(c) for c in costs]),
            "seconds": time.time() - t0}


def out_of_fold(df: DataFrame, features: Sequence[str], label: str, spec: ModelSpec,
                fold_col: str = "fold", k: int = 5, id_col: str | None = None,
                parallelism: int = 4) -> DataFrame:
    """Out-of-fold probabilities (fold, label, TARGET_proba[, id]) of k fits:
    the input of the threshold sweep (M18) without refitting per threshold.
    The result is persisted (the caller unpersists it)."""
    keep = [c for c in (id_col,) if c]
    src = df.select(*keep, *features, label, fold_col).persist(StorageLevel.MEMORY_AND_DISK)
    prep, _ = prepare(src, features, label, weighting=spec.weighting)
    data = assembler(features).transform(prep).select(
        *keep, FEATURES_COL, "label", fold_col, *([WEIGHT_COL] if spec.weighting != "none" else []))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        models = list(pool.map(lambda f: learner(spec, part := data.where(F.col(fold_col) != f)).fit(part), range(k)))
    oof = None
    for f, m in enumerate(models):
        part = positive_proba(m.transform(data.where(F.col(fold_col) == f))).select(
            *keep, fold_col, "label", "TARGET_proba")
        oof = part if oof is None else oof.unionByName(part)
    oof = oof.persist(StorageLevel.MEMORY_AND_DISK)
    oof.count()
    data.unpersist()
    src.unpersist()
    return oof


def cv_auc(df: DataFrame, features: Sequence[str], label: str, spec: ModelSpec,
           fold_col: str = "fold", k: int = 5, parallelism: int = 4) -> float:
    return cross_validate(df, features, label, spec, fold_col, k, parallelism=parallelism)["mean_auc"]


def leaderboard(df: DataFrame, features: Sequence[str], label: str,
                specs: Sequence[ModelSpec] = REFERENCE_MODELS, fold_col: str = "fold") -> DataFrame:
    """One row per model (mean / sd AUC, mean cost, seconds)."""
    with ThreadPoolExecutor(max_workers=max(1, len(specs))) as pool:
        rows = list(pool.map(lambda s: cross_validate(df, features, label, s, fold_col), specs))
    return df.sparkSession.createDataFrame(
        [(r["model"], r["num_features"], r["mean_auc"], r["std_auc"], r["mean_cost"], r["seconds"]) for r in rows],
        "model string, num_features int, mean_auc double, std_auc double, mean_cost double, seconds double")


def fit_pipeline(df: DataFrame, features: Sequence[str], label: str, spec: ModelSpec) -> tuple[PipelineModel, dict]:
    """Final fit on all rows; returns the fitted pipeline and scaler params."""
    # The statistics passes of ``prepare`` and the learner's own passes read
    # the same few columns: compute them once.
    src = df.select(*features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        prep, params = prepare(src, features, label, weighting=spec.weighting)
        keep = [*features, "label", *([WEIGHT_COL] if spec.weighting != "none" else [])]
        prep = prep.select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = Pipeline(stages=[assembler(features), learner(spec, prep)]).fit(prep)
        finally:
            prep.unpersist()
    finally:
        src.unpersist()
    return model, params


def score(df: DataFrame, model: PipelineModel, features: Sequence[str], params: dict,
          threshold: float = 0.5, id_col: str = "SK_ID_CURR") -> DataFrame:
    """Scale with the training parameters -> model -> probability ->
    label at the threshold; carries the id through (not a row index)."""
    scaled = E.standardise(df, list(features), params)
    pred = positive_proba(model.transform(scaled))
    return pred.select(id_col, "TARGET_proba",
                       threshold_label("TARGET_proba", threshold).alias("TARGET"),
                       F.lit(float(threshold)).alias("threshold"))


def fit_whole(df: DataFrame, features: Sequence[str], label: str, spec: ModelSpec, encoders: Sequence = ()) -> PipelineModel:
    """Encoders, scaler and learner fitted as one pipeline, which scores rows as they come (F14, F17 with the model)."""
    from riskweave.operators.fitted import PopulationScaler
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        prep, _ = prepare(src, features, label, scale=False, weighting=spec.weighting)
        first = Pipeline(stages=[*encoders, PopulationScaler(list(features))]).fit(prep)
        ready = assembler(features).transform(first.transform(prep)).select(
            FEATURES_COL, "label", *([WEIGHT_COL] if spec.weighting != "none" else [])).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fitted = learner(spec, ready).fit(ready)
        finally:
            ready.unpersist()
    finally:
        src.unpersist()
    return PipelineModel([*first.stages, assembler(features), fitted])


def save_whole(model: PipelineModel, features: Sequence[str], threshold: float, path: str) -> None:
    """A pipeline of :func:`fit_whole`, its feature contract and its threshold, in one folder."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    (spark.createDataFrame([(k, f, float(threshold)) for k, f in enumerate(features)], "pos int, feature string, threshold double")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/contract"))


def load_whole(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str], float]:
    rows = spark.read.parquet(f"{path}/contract").orderBy("pos").collect()  # a row per feature
    return PipelineModel.load(f"{path}/model"), [r["feature"] for r in rows], rows[0]["threshold"]


def score_whole(df: DataFrame, model: PipelineModel, threshold: float, id_col: str) -> DataFrame:
    """Probability and label of rows as they come."""
    return positive_proba(model.transform(df)).select(
        id_col, "TARGET_proba", threshold_label("TARGET_proba", threshold).alias("TARGET"), F.lit(float(threshold)).alias("threshold"))


def importances(model, features: Sequence[str]) -> list[tuple[str, float]]:
    """Tree-model importances in column order (gain-based in Spark)."""
    stage = model.stages[-1] if isinstance(model, PipelineModel) else model
    vals = stage.featureImportances.toArray().tolist()
    return list(zip(features, vals))
