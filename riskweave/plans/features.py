"""The client feature table (raw loan tables -> one wide row per client).

Each stage is a function of DataFrames that returns a lazy DataFrame; the
whole table is one Spark plan unless the caller writes a stage out (see
``riskweave.sources.io.write_stage``) to cut lineage.

Physical shape: every child table is aggregated before it meets the client
(pre-aggregation Catalyst will not do across joins), each output leaves
its group-by hash-partitioned on ``SK_ID_CURR``, so the star of left joins
only shuffles the client table once more; AQE turns joins whose measured
side is small into broadcast joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.scalar import (abs_widened, clamp_min_keep_null, days_to_years,
                                        null_if_sentinel, positive_flag, safe_ratio,
                                        sentinel_flag)
from riskweave.operators import aggregate as agg
from riskweave.operators import encode
from riskweave.plans import loan_specs as S

CURR, PREV, BUREAU = "SK_ID_CURR", "SK_ID_PREV", "SK_ID_BUREAU"


# --- row features (F1, F10-F12) ---------------------------------------------

def instalment_row_features(ins: DataFrame) -> DataFrame:
    return ins.withColumns({
        "PAYMENT_RATIO": safe_ratio("AMT_PAYMENT", "AMT_INSTALMENT"),
        "PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
        "DAYS_LATE": clamp_min_keep_null(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")),
    }).withColumn("IS_LATE", positive_flag("DAYS_LATE"))


def pos_row_features(pos: DataFrame) -> DataFrame:
    return pos.withColumn("INSTALMENT_FUTURE_RATIO",
                          safe_ratio("CNT_INSTALMENT_FUTURE", "CNT_INSTALMENT"))


def credit_card_row_features(cc: DataFrame) -> DataFrame:
    return cc.withColumns({
        "BALANCE_TO_LIMIT_RATIO": safe_ratio("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"),
        "DRAWING_LIMIT_RATIO": safe_ratio("AMT_DRAWINGS_CURRENT", "AMT_CREDIT_LIMIT_ACTUAL"),
    })


def bureau_row_features(bureau: DataFrame) -> DataFrame:
    return bureau.withColumns({
        "DEBT_CREDIT_RATIO": safe_ratio("AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM"),
        "CREDIT_OVERDUE_DEBT_RATIO": safe_ratio("AMT_CREDIT_MAX_OVERDUE", "AMT_CREDIT_SUM_DEBT"),
    })


def previous_row_features(prev: DataFrame) -> DataFrame:
    return prev.withColumns({
        "CREDIT_TO_ANNUITY_RATIO": safe_ratio("AMT_CREDIT", "AMT_ANNUITY"),
        "CREDIT_TO_GOODS_RATIO": safe_ratio("AMT_CREDIT", "AMT_GOODS_PRICE"),
    })


# --- stage 1-2: bureau ----------------------------------------------------------

def bureau_balance_agg(bb: DataFrame, status_col: str = "STATUS",
                       values: Sequence | None = None) -> DataFrame:
    """One row per SK_ID_BUREAU: month min/max/size and a share per status."""
    return agg.category_shares(bb, BUREAU, status_col, values=values,
                               name_prefix=f"{status_col}_", spec=S.BUREAU_BALANCE_SPEC)


def bureau_rules():
    return [
        (lambda c: c in S.BUREAU_RATIO_COLS, ["min", "mean", "max", "var"]),
        (lambda c: "STATUS_" in c, ["mean"]),
        (lambda c: c in S.BUREAU_AMOUNT_COLS, ["min", "mean", "max", "sum"]),
    ]


def bureau_client_agg(bureau: DataFrame, bb_agg: DataFrame | None,
                      order_col: str = "DAYS_CREDIT") -> DataFrame:
    """J1 + label codes + ratios + rule spec + loan count + latest values.

    The statistics are one hash aggregate. The latest values need a
    struct-ordered ``max_by``, which only a sort-based aggregate can run;
    they get their own narrow aggregate over a column-pruned read of the
    bureau rows, so only (client, day, id, 3 values) are sorted, not the wide
    rows. Both outputs are hash-partitioned on the client: the join adds no
    exchange.
    """
    b = bureau if bb_agg is None else bureau.join(bb_agg, BUREAU, "left")
    b = agg.rows_by_key(encode.label_encode(b, encode.string_columns(b)), CURR, bureau)
    b = bureau_row_features(b)
    spec = agg.rule_spec(b, bureau_rules(), exclude=(BUREAU, CURR))
    stats = agg.grouped_agg(b, CURR, spec, prefix="BUREAU_",
                            extra=[F.count(F.col(BUREAU)).alias("BUREAU_LOAN_COUNT")])
    narrow = agg.rows_by_key(bureau.select(CURR, BUREAU, *dict.fromkeys([order_col, *S.BUREAU_RECENT_COLS])), CURR)
    latest = agg.grouped_agg(narrow, CURR, {}, extra=agg.latest_non_null(
        narrow, CURR, order_col, BUREAU, S.BUREAU_RECENT_COLS, prefix="BUREAU_RECENT_"))
    return stats.join(latest, CURR, "left")


# --- stage 3: previous applications ----------------------------------------------

def previous_client_agg(prev: DataFrame, approved_code: int = 1,
                        status_col: str = "NAME_CONTRACT_STATUS") -> DataFrame:
    """Per-client stats of previous loans; approval rate as a conditional rate.

    ``approved_code`` is the label code counted as approved (the reference
    counts code 1, whatever value that code stands for).
    """
    p = agg.rows_by_key(encode.label_encode(prev, encode.string_columns(prev)), CURR)
    p = previous_row_features(p)
    spec = agg.rule_spec(p, [(lambda c: c in S.PREV_WIDE_COLS, ["min", "mean", "max", "sum"])],
                         exclude=(PREV, CURR))
    extra = [F.count(F.col(PREV)).alias("PREV_APP_COUNT"),
             agg.conditional_rate(F.col(status_col) == F.lit(approved_code), PREV,
                                  "PREV_APPROVAL_RATE")]
    return agg.grouped_agg(p, CURR, spec, prefix="PREV_", extra=extra)


def loan_links(prev: DataFrame) -> DataFrame:
    """(client, loan) pairs; reused by the three two-level aggregates."""
    return prev.select(CURR, PREV)


# --- stage 4: child tables of previous loans (A11) -------------------------------

def pos_client_agg(pos: DataFrame, links: DataFrame) -> DataFrame:
    return agg.two_level_agg(pos_row_features(agg.rows_by_key(pos, PREV)), links, PREV, CURR, S.POS_SPEC, "POS")


def instalments_client_agg(ins: DataFrame, links: DataFrame) -> DataFrame:
    return agg.two_level_agg(instalment_row_features(agg.rows_by_key(ins, PREV)), links, PREV, CURR, S.INS_SPEC, "INS")


def credit_card_client_agg(cc: DataFrame, links: DataFrame) -> DataFrame:
    return agg.two_level_agg(credit_card_row_features(agg.rows_by_key(cc, PREV)), links, PREV, CURR, S.CC_SPEC, "CC")


# --- stage 5: application table ---------------------------------------------------

def application_features(train: DataFrame, test: DataFrame, target: str = "TARGET",
                         sentinel_first: bool = False, fit_on: str = "all") -> DataFrame:
    """U1 union -> drop > 75 % missing -> median fill -> abs days -> years ->
    sentinel flag -> ratios filled with their median (F2).

    Reference order by default (sentinel nulled after the years were taken
    and after median imputation). ``sentinel_first=True`` nulls it first;
    ``fit_on='train'`` takes medians from training rows only (no leak).
    """
    df = train.unionByName(test, allowMissingColumns=True)
    fit = df.where(F.col(target).isNotNull()) if fit_on == "train" else df
    df, _ = encode.drop_high_missing(df, S.APP_MISSING_DROP, exclude=(target,), stats_df=fit)
    if sentinel_first and "DAYS_EMPLOYED" in df.columns:
        # corrected order: flag, then null, so the median and the fill skip the sentinel
        df = df.withColumn("DAYS_EMPLOYED_ANOM", sentinel_flag(F.abs(F.col("DAYS_EMPLOYED"))))
        df = df.withColumn("DAYS_EMPLOYED", null_if_sentinel(F.abs(F.col("DAYS_EMPLOYED"))))
    num = [c for c, t in df.dtypes if c != target and t not in ("string", "boolean")
           and not t.startswith(("array", "map", "struct"))]
    fit = df.where(F.col(target).isNotNull()) if fit_on == "train" else df
    df = encode.median_impute(df, num, stats_df=fit)
    df = df.withColumns({c: abs_widened(c, integral=False) for c in S.APP_ABS_DAYS if c in df.columns})
    df = df.withColumns({y: days_to_years(d) for y, d in S.APP_YEARS.items() if d in df.columns})
    if "DAYS_EMPLOYED" in df.columns and not sentinel_first:
        df = df.withColumn("DAYS_EMPLOYED_ANOM", sentinel_flag("DAYS_EMPLOYED"))
        df = df.withColumn("DAYS_EMPLOYED", null_if_sentinel("DAYS_EMPLOYED"))
    ratios = {n: (a, b) for n, (a, b) in S.APP_RATIOS.items() if a in df.columns and b in df.columns}
    return encode.ratio_impute(df, ratios)


# --- stage 6: merge ---------------------------------------------------------------

def merge_features(app: DataFrame, parts: Sequence[DataFrame], target: str = "TARGET") -> DataFrame:
    """One-hot the strings, left-join every per-client table, fill 0 (not the label)."""
    app = encode.one_hot(app, encode.string_columns(app))
    out = app
    for p in parts:
        out = out.join(p, CURR, "left")
    fill_cols = [c for c, t in out.dtypes if c != target and t != "string"]
    return out.na.fill(0, subset=fill_cols).withColumns(
        {c: F.coalesce(F.col(c), F.lit(False)) for c, t in out.dtypes if t == "boolean"})


def split_train_test(df: DataFrame, target: str = "TARGET") -> tuple[DataFrame, DataFrame]:
    """P5: train = label present; test = label missing, label dropped."""
    return df.where(F.col(target).isNotNull()), df.where(F.col(target).isNull()).drop(target)


def build_feature_table(tables: dict[str, DataFrame], target: str = "TARGET",
                        checkpoint_dir: str | None = None, shapes: dict | None = None) -> DataFrame:
    """§3.1 end to end on the eight raw tables (keys as in the reference).

    With ``checkpoint_dir`` (a folder in the shared checkpoint location)
    every per-client part is written as Parquet and re-read before the
    merge: a lost executor then costs one stage, not the whole lineage, and
    the merge plans from file statistics (AQE can broadcast small parts).
    ``shapes`` (a dict) receives (rows, columns) per checkpointed stage,
    counted while writing.
    """
    from riskweave.sources.io import normalise_missing
    tables = {k: normalise_missing(v) for k, v in tables.items()}
    bb = bureau_balance_agg(tables["bureau_balance"])
    bureau = bureau_client_agg(tables["bureau"], bb)
    prev = tables["previous_application"]
    links = loan_links(prev)
    # The three child tables of previous loans share one link shuffle and
    # one client-level group-by.
    children = agg.two_level_aggs(
        [(pos_row_features(agg.rows_by_key(tables["pos_cash_balance"], PREV)), S.POS_SPEC, "POS"),
         (instalment_row_features(agg.rows_by_key(tables["installments_payments"], PREV)), S.INS_SPEC, "INS"),
         (credit_card_row_features(agg.rows_by_key(tables["credit_card_balance"], PREV)), S.CC_SPEC, "CC")],
        links, PREV, CURR)
    parts = {"bureau": bureau, "previous": previous_client_agg(prev), "loan_children": children}
    app = application_features(tables["application_train"], tables["application_test"], target)
    if checkpoint_dir is not None:
        from riskweave.sources.io import checkpoint_stage
        spark = app.sparkSession
        parts = {k: checkpoint_stage(spark, v, f"{checkpoint_dir}/{k}", shapes, k) for k, v in parts.items()}
        app = checkpoint_stage(spark, app, f"{checkpoint_dir}/application", shapes, "application")
    return merge_features(app, list(parts.values()), target)
