"""Aggregation queries: A1-A11, J1-J5 on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import aggregate as agg
from riskweave.plans import features as feat
from riskweave.plans import oracle as O
from riskweave.plans import testdata_views as V
from riskweave.plans.catalog import register
from riskweave.plans.loan_specs import INS_SPEC

# --- flagship: instalments -> loan -> client ---------------------------------

TWO_LEVEL_SQL = O.two_level_sql(
    child_cte=O.INSTALMENTS_CTE + ",\n" + O.INSTALMENT_FEATURES_CTE,
    child_table="ins_rows",
    link_sql="SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV FROM orders",
    child_key="SK_ID_PREV", parent_key="SK_ID_CURR",
    spec=INS_SPEC, types=O.INS_TYPES, prefix="INS")


@register("two_level_agg", TWO_LEVEL_SQL)
def two_level_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """56 client columns ``INS_INS_{COL}_{AGG}_{MEAN|MAX}``."""
    out = feat.instalments_client_agg(V.instalments(spark, sf_dir), V.loan_links(spark, sf_dir))
    return out


# --- A1, A3-A6, P9 -------------------------------------------------------------

MULTI_SPEC = {
    "l_quantity": ["min", "max", "mean", "sum", "var", "size"],
    "l_extendedprice": ["min", "max", "mean", "sum", "var"],
    "l_partkey": ["nunique"],
    "l_discount": ["count"],
}
_MULTI_TYPES = {"l_quantity": "double", "l_extendedprice": "double", "l_partkey": "bigint",
                "l_discount": "double"}


@register("grouped_multi_agg",
          f"SELECT l_suppkey, {', '.join(O.spec_select(MULTI_SPEC, _MULTI_TYPES, 'LI_')[0])} "
          f"FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey")
def grouped_multi_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = V.read_table(spark, sf_dir, "lineitem")
    return agg.grouped_agg(li, "l_suppkey", MULTI_SPEC, prefix="LI_")


# --- A2, F1, F14, J4, A9: bureau loans per client --------------------------------

@register("rule_driven_agg", O.bureau_agg_sql(None))
def rule_driven_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.bureau_client_agg(V.bureau(spark, sf_dir), None)


@register("balance_rollup", O.bureau_agg_sql(O.RETURN_FLAGS))
def balance_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly balance stats joined to their loan, then rolled up per client."""
    bb = feat.bureau_balance_agg(V.bureau_balance_from_lineitem(spark, sf_dir))
    return feat.bureau_client_agg(V.bureau(spark, sf_dir), bb)


# --- A7, A8, F13 -----------------------------------------------------------------

@register("category_share", f"WITH {O.BB_EVENTS_CTE} "
          f"SELECT SK_ID_BUREAU, min(MONTHS_BALANCE) AS MONTHS_BALANCE_MIN, max(MONTHS_BALANCE) AS "
          f"MONTHS_BALANCE_MAX, count(*) AS MONTHS_BALANCE_SIZE, "
          f"{', '.join(O.shares_sql('STATUS', O.EVENT_TYPES, 'STATUS_'))} "
          f"FROM bb WHERE SK_ID_BUREAU IS NOT NULL GROUP BY SK_ID_BUREAU")
def category_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.bureau_balance_agg(V.bureau_balance_from_events(spark, sf_dir))


# --- A9, K1, T7 ------------------------------------------------------------------

_LATEST_SQL = f"""WITH o AS (
  SELECT o_custkey, o_orderkey, CAST({O.days_before('o_orderdate')} AS INTEGER) AS DAYS_ORDER,
         CASE WHEN o_orderpriority = '5-LOW' THEN CAST(NULL AS DOUBLE) ELSE o_totalprice END AS PRICE,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS STATUS
  FROM orders)
SELECT o_custkey, {O.latest_sql('DAYS_ORDER', 'DAYS_ORDER', 'o_orderkey', 'RECENT_DAYS_ORDER', 'int')},
       {O.latest_sql('PRICE', 'DAYS_ORDER', 'o_orderkey', 'RECENT_PRICE', 'double')},
       {O.latest_sql('STATUS', 'DAYS_ORDER', 'o_orderkey', 'RECENT_STATUS', 'str')}
FROM o WHERE o_custkey IS NOT NULL GROUP BY o_custkey"""


@register("latest_value", _LATEST_SQL)
def latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last non-missing value per column after sorting each client's orders by day."""
    o = V.read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", V.days_before("o_orderdate").alias("DAYS_ORDER"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("PRICE"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
         .otherwise(F.col("o_orderstatus")).alias("STATUS"))
    exprs = agg.latest_non_null(o, "o_custkey", "DAYS_ORDER", "o_orderkey",
                                ["DAYS_ORDER", "PRICE", "STATUS"], prefix="RECENT_")
    return agg.grouped_agg(o, "o_custkey", {}, extra=exprs)


# --- A10, J5, A4 ----------------------------------------------------------------

@register("conditional_rate", O.prev_agg_sql(1))
def conditional_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous applications per client; approval rate = share of status code 1."""
    return feat.previous_client_agg(V.previous_applications(spark, sf_dir), 1)


# --- J2 ---------------------------------------------------------------------------

_L1_ITEMS, _L1_TYPES = O.spec_select(INS_SPEC, O.INS_TYPES, "INS_")


@register("link_join", f"""WITH {O.INSTALMENTS_CTE}, {O.INSTALMENT_FEATURES_CTE},
lvl1 AS (SELECT SK_ID_PREV, {', '.join(_L1_ITEMS)} FROM ins_rows WHERE SK_ID_PREV IS NOT NULL GROUP BY SK_ID_PREV)
SELECT o.o_custkey AS SK_ID_CURR, o.o_orderkey AS SK_ID_PREV, {', '.join('lvl1."' + n + '"' for n in _L1_TYPES)}
FROM orders o LEFT JOIN lvl1 ON o.o_orderkey = lvl1.SK_ID_PREV""")
def link_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(client, loan) pairs with their loan-level stats; loans without rows keep NULLs."""
    ins = feat.instalment_row_features(agg.rows_by_key(V.instalments(spark, sf_dir), "SK_ID_PREV"))
    lvl1 = agg.grouped_agg(ins, "SK_ID_PREV", INS_SPEC, prefix="INS_")
    return V.loan_links(spark, sf_dir).join(lvl1, "SK_ID_PREV", "left")
