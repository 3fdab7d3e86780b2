"""Profile, selection-statistic and evaluation queries (A16-A23, M1-M5, M9,
M18, K4-K6, S7-S8) on lineitem and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import evaluate as EV
from riskweave.operators import profile as PR
from riskweave.operators.aggregate import round_doubles
from riskweave.plans import oracle as O
from riskweave.plans import testdata_views as V
from riskweave.plans.catalog import register

# Feature frame over lineitem: a constant column (no variance, no r, F NULL),
# a copy of the discount (r = 1, dropped by the correlation rule), the label
# itself as a feature (no within-class spread, F = +inf).
FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber",
            "CONST_ONE", "DISCOUNT_X2", "IS_R")
TARGET = "TARGET"


def lineitem_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = V.read_table(spark, sf_dir, "lineitem")
    is_r = (F.col("l_returnflag") == F.lit("R")).cast("int")
    return li.select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber",
                     F.lit(1.0).alias("CONST_ONE"), (F.col("l_discount") * F.lit(2.0)).alias("DISCOUNT_X2"),
                     is_r.cast("double").alias("IS_R"), is_r.alias(TARGET),
                     (F.col("l_discount") * F.lit(10.0)).alias("SCORE"))


_LI_CTE = """li AS (
  SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber,
         CAST(1.0 AS DOUBLE) AS CONST_ONE, l_discount * CAST(2.0 AS DOUBLE) AS DISCOUNT_X2,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS IS_R,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS TARGET,
         l_discount * CAST(10.0 AS DOUBLE) AS SCORE
  FROM lineitem)"""


# --- A16, M2 ---------------------------------------------------------------------

@register("variance_filter", f"WITH {_LI_CTE}\n" + "\nUNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS pos, '{c}' AS column_name, {O.xvar(c)} AS variance, "
    f"coalesce({O.xvar(c)} > CAST(0.01 AS DOUBLE), false) AS kept FROM li"
    for i, c in enumerate(FEATURES)))
def variance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PR.variance_table(lineitem_features(spark, sf_dir), FEATURES, 0.01)


# --- A17, M3 ---------------------------------------------------------------------

def _corr_sql(x: str, y: str) -> str:
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    cov = f"covar_pop(CASE WHEN {both} THEN CAST({x} AS DOUBLE) END, CASE WHEN {both} THEN CAST({y} AS DOUBLE) END)"
    sx = f"stddev_pop(CASE WHEN {both} THEN CAST({x} AS DOUBLE) END)"
    sy = f"stddev_pop(CASE WHEN {both} THEN CAST({y} AS DOUBLE) END)"
    return f"{cov} / nullif({sx} * {sy}, 0)"


_PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1, len(FEATURES))]
_PAIRS_SQL = f"WITH {_LI_CTE},\npairs AS (" + "\nUNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS i, CAST({j} AS INTEGER) AS j, '{FEATURES[i]}' AS col_i, "
    f"'{FEATURES[j]}' AS col_j, {_corr_sql(FEATURES[i], FEATURES[j])} AS r FROM li"
    for i, j in _PAIRS) + ")"


@register("correlation_pairs", _PAIRS_SQL + f"\nSELECT i, j, col_i, col_j, {O.grid('r')} AS r, {O.grid('abs(r)')} AS abs_r FROM pairs")
def correlation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson r of every column pair over pairwise-complete rows."""
    return round_doubles(PR.correlation_pairs(lineitem_features(spark, sf_dir), FEATURES))


@register("correlation_filter", _PAIRS_SQL + "\n, cols AS (" + " UNION ALL ".join(
    f"SELECT CAST({k} AS INTEGER) AS pos, '{c}' AS column_name" for k, c in enumerate(FEATURES))
    + ")\nSELECT pos, column_name, EXISTS (SELECT 1 FROM pairs WHERE pairs.j = cols.pos AND abs(r) > 0.95) AS dropped FROM cols")
def correlation_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column j dropped when an earlier column has |r| > 0.95 with it."""
    pairs = PR.correlation_pairs(lineitem_features(spark, sf_dir), FEATURES)
    dropped = set(PR.correlated_to_drop(pairs, FEATURES, 0.95))
    return spark.createDataFrame([(k, c, c in dropped) for k, c in enumerate(FEATURES)],
                                 "pos int, column_name string, dropped boolean")


# --- A18, K4, M4 -------------------------------------------------------------------

_ANOVA_SQL = f"""WITH {_LI_CTE},
pc AS (SELECT TARGET, {', '.join(f'count({c}) AS n{i}, {O.xmean(c)} AS m{i}, {O.xvar(c)} AS v{i}, min(CAST({c} AS DOUBLE)) AS lo{i}, max(CAST({c} AS DOUBLE)) AS hi{i}' for i, c in enumerate(FEATURES))}
       FROM li WHERE TARGET IS NOT NULL GROUP BY TARGET),
lg AS ({' UNION ALL '.join(f"SELECT CAST({i} AS INTEGER) AS pos, '{c}' AS feature, n{i} AS n, m{i} AS m, v{i} AS v, lo{i} AS lo, hi{i} AS hi FROM pc" for i, c in enumerate(FEATURES))}),
gm AS (SELECT pos, {O.xsum('n * m')} / CAST(sum(n) AS DOUBLE) AS gm FROM lg WHERE n > 0 GROUP BY pos),
s AS (SELECT pos, feature, {O.xsum('n * (m - gm) * (m - gm)')} AS ssb, {O.xsum('n * v')} AS ssw, CAST(sum(n) AS DOUBLE) AS n,
             count(*) AS k, min(lo) = max(hi) AS constant
      FROM lg JOIN gm USING (pos) WHERE n > 0 GROUP BY pos, feature),
f AS (SELECT pos, feature, CASE WHEN constant THEN CAST(NULL AS DOUBLE)
                             WHEN ssw = 0 AND ssb > 0 THEN CAST('Infinity' AS DOUBLE)
                             WHEN ssw = 0 THEN CAST(NULL AS DOUBLE)
                             ELSE (ssb / (k - 1)) / (ssw / (n - k)) END AS f_score FROM s)"""


@register("anova_f", _ANOVA_SQL + f"\nSELECT pos, feature, {O.rnd('f_score')} AS f_score FROM f")
def anova_f(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PR.anova_f(lineitem_features(spark, sf_dir), FEATURES, TARGET)


@register("univariate_topk", _ANOVA_SQL + f"\nSELECT pos, feature, {O.rnd('f_score')} AS f_score FROM f "
          "ORDER BY f_score DESC NULLS LAST, pos DESC LIMIT 3")
def univariate_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 by F (the limit is the operator), reported in column order."""
    scores = PR.anova_f(lineitem_features(spark, sf_dir), FEATURES, TARGET)
    return PR.top_k_by_score(scores, 3)


# --- A19 ----------------------------------------------------------------------------

_MI_TERM = ("floor((CAST(nxy AS DOUBLE) / CAST(n AS DOUBLE)) * ln((CAST(nxy AS DOUBLE) * CAST(n AS DOUBLE)) / (CAST(nx AS DOUBLE) * CAST(ny AS DOUBLE)))"
            f" * CAST({int(PR.LOG_UNIT)} AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST({int(PR.LOG_UNIT)} AS DOUBLE)")
_MI_SQL = f"""WITH {_LI_CTE},
b AS ({' UNION ALL '.join(
    f"SELECT CAST({i} AS INTEGER) AS pos, '{c}' AS feature, CAST({c} AS DOUBLE) AS v, TARGET AS y FROM li" for i, c in enumerate(FEATURES))}),
vals AS (SELECT pos, v, count(*) AS n FROM b WHERE v IS NOT NULL AND y IS NOT NULL GROUP BY ALL),
below AS (SELECT pos, v, coalesce(sum(n) OVER (PARTITION BY pos ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
                 sum(n) OVER (PARTITION BY pos) AS total FROM vals),
cells AS (SELECT pos, feature, (10 * below) // total AS bin, y, count(*) AS nxy FROM b JOIN below USING (pos, v)
          WHERE y IS NOT NULL GROUP BY ALL),
t AS (SELECT *, sum(nxy) OVER (PARTITION BY pos, bin) AS nx, sum(nxy) OVER (PARTITION BY pos, y) AS ny,
             sum(nxy) OVER (PARTITION BY pos) AS n FROM cells)
SELECT pos, feature, {O.xsum(_MI_TERM)} AS mi FROM t GROUP BY pos, feature"""


@register("mutual_info_binned", _MI_SQL)
def mutual_info_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PR.mutual_info_binned(lineitem_features(spark, sf_dir), FEATURES, TARGET, 10)


# --- A23 ------------------------------------------------------------------------------

@register("class_weights", f"""WITH c AS (SELECT quality, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY quality)
SELECT quality, n, {O.rnd('CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n)')} AS weight_balanced,
       CASE WHEN quality = 1 THEN CAST(10.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS weight_pos FROM c""")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.class_weights(V.read_table(spark, sf_dir, "labels"), "quality", 10.0)


# --- M5 --------------------------------------------------------------------------------

@register("strat_folds", """SELECT doc_id, quality, toxic,
  CAST((row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1) % 5 AS INTEGER) AS fold FROM labels""")
def strat_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified 5 folds by quality, positions in id order, no one-task window."""
    return EV.stratified_folds(V.read_table(spark, sf_dir, "labels"), "doc_id", "quality", 5)


# --- M9 ----------------------------------------------------------------------------------

@register("roc_auc", f"""WITH {_LI_CTE},
p AS (SELECT SCORE AS s, sum(TARGET) AS pos, sum(1 - TARGET) AS neg FROM li GROUP BY SCORE),
q AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM p)
SELECT {O.rnd('sum(pos * (nb + neg * 0.5)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE))')} AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM q""")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact AUC of the discount as a score for the 'R' flag (heavy ties)."""
    return EV.roc_auc(lineitem_features(spark, sf_dir), "SCORE", TARGET)


# --- A20, F19 ---------------------------------------------------------------------------

def _cost_sql(group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return "\nUNION ALL ".join(
        f"SELECT {g}CAST({t} AS DOUBLE) AS threshold, count(*) FILTER (WHERE TARGET = 1 AND SCORE < {t}) AS fn, "
        f"count(*) FILTER (WHERE TARGET = 0 AND SCORE >= {t}) AS fp FROM li{gb}" for t in EV.THRESHOLDS)


@register("business_cost", f"WITH {_LI_CTE}, c AS ({_cost_sql()})\n"
          "SELECT threshold, CAST(fn AS BIGINT) AS fn, CAST(fp AS BIGINT) AS fp, CAST(10 * fn + fp AS BIGINT) AS cost FROM c")
def business_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN, FP and 10·FN + FP at the seven sweep thresholds, one pass."""
    return EV.business_cost(lineitem_features(spark, sf_dir), "SCORE", TARGET)


# --- M18, A21, K5 ------------------------------------------------------------------------

# Folds: stratified by order status over orders in key order (M5), inherited
# by every line of the order (a grouped split: no order straddles folds).
_FOLDS_SQL = """of AS (SELECT o_orderkey,
  CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM orders)"""

_SWEEP_SQL = f"""WITH {_FOLDS_SQL}, {_LI_CTE.replace('FROM lineitem)', ', of.fold FROM lineitem JOIN of ON l_orderkey = of.o_orderkey)')},
c AS ({_cost_sql('fold')}),
s AS (SELECT threshold, avg(10 * fn + fp) AS mean_cost, sqrt({O.xvar('(10 * fn + fp)')}) AS std_cost,
             CAST(count(*) AS BIGINT) AS n_folds FROM c GROUP BY threshold)"""


def _order_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = V.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return EV.stratified_folds(orders, "o_orderkey", "o_orderstatus", 5).select(
        F.col("o_orderkey").alias("l_orderkey"), "fold")


def _lines_with_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_features(spark, sf_dir).join(_order_folds(spark, sf_dir), "l_orderkey", "inner")


@register("threshold_sweep", _SWEEP_SQL + f"""
SELECT threshold, {O.rnd('mean_cost')} AS mean_cost, {O.rnd('std_cost')} AS std_cost, n_folds,
       row_number() OVER (ORDER BY mean_cost ASC NULLS LAST, CASE WHEN threshold <> 0.5 THEN 1 ELSE 0 END, threshold) = 1 AS best
FROM s""")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-fold cost at every threshold, mean and sd over 5 folds, best marked."""
    df = _lines_with_folds(spark, sf_dir)
    return EV.threshold_sweep(df, "SCORE", TARGET, "fold")


# --- S7, S8, K6 ---------------------------------------------------------------------------

@register("best_run", _SWEEP_SQL + f"""
SELECT 'threshold=' || CAST(threshold AS VARCHAR) AS run_name, threshold, {O.rnd('mean_cost')} AS mean_cost
FROM s ORDER BY mean_cost ASC NULLS LAST, CASE WHEN threshold <> 0.5 THEN 1 ELSE 0 END, threshold LIMIT 1""")
def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each sweep threshold logged as a run (long metric rows in the shared
    run table, replaced if they were logged before), read back, pivoted, best picked by
    cost ascending (the reference's ordering picks the worst)."""
    from riskweave.sources import runs
    df = _lines_with_folds(spark, sf_dir)
    sweep = EV.threshold_sweep(df, "SCORE", TARGET, "fold")
    long = runs.metrics_to_runs(sweep, run_name=F.concat(F.lit("threshold="), F.col("threshold").cast("string")),
                                params=["threshold"], metrics=["mean_cost", "std_cost"], experiment="threshold_sweep", tags={"data": sf_dir})
    path = runs.run_table_path(spark)
    runs.append_runs(long, path)
    wide = runs.read_runs(spark, path, "threshold_sweep", {"data": sf_dir})
    best = runs.best_run(wide, "mean_cost", ascending=True, prefer={"threshold": EV.START_THRESHOLD})
    return best.select("run_name", F.col("threshold").cast("double").alias("threshold"), "mean_cost")
