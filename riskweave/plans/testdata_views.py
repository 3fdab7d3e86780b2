"""The loan schema mapped onto the driver's test tables (Spark side).

Raw loan data is not available, so the test tables play its roles:
``customer`` = client, ``orders`` = previous loan (``o_orderkey`` = loan id,
``o_custkey`` = client), ``lineitem`` = instalments of a loan, ``events`` =
monthly status rows. Every view is a projection of a given table, so the
work of each query grows with the tables. The DuckDB twins of these views
are in ``riskweave.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import read_table

# Fixed reference date for relative days (days before "now", as DAYS_* columns).
REFERENCE_DATE = "1999-01-01"


def days_before(ts_col: str):
    return F.datediff(F.to_date(F.col(ts_col)), F.lit(REFERENCE_DATE).cast("date"))


def instalments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as instalments_payments; open lines have no payment yet."""
    li = read_table(spark, sf_dir, "lineitem")
    days_inst = days_before("l_shipdate").cast("double")
    is_open = F.col("l_linestatus") == F.lit("O")
    return li.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("l_tax").alias("NUM_INSTALMENT_VERSION"),
        F.col("l_linenumber").alias("NUM_INSTALMENT_NUMBER"),
        days_inst.alias("DAYS_INSTALMENT"),
        F.when(is_open, F.lit(None).cast("double"))
         .otherwise(days_inst + F.col("l_quantity") - F.lit(25.0)).alias("DAYS_ENTRY_PAYMENT"),
        F.col("l_extendedprice").alias("AMT_INSTALMENT"),
        F.when(is_open, F.lit(None).cast("double"))
         .otherwise(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("AMT_PAYMENT"),
    )


def loan_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("SK_ID_CURR"), F.col("o_orderkey").alias("SK_ID_PREV"))


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as credit-bureau loans of a client.

    Finished orders owe nothing (debt 0, so the overdue/debt ratio meets a
    zero denominator); urgent orders carry a tenth of the price overdue.
    """
    o = read_table(spark, sf_dir, "orders")
    finished = F.col("o_orderstatus") == F.lit("F")
    return o.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_BUREAU"),
        F.col("o_orderstatus").alias("CREDIT_ACTIVE"),
        F.col("o_orderpriority").alias("CREDIT_TYPE"),
        days_before("o_orderdate").alias("DAYS_CREDIT"),
        F.col("o_totalprice").alias("AMT_CREDIT_SUM"),
        F.when(finished, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("AMT_CREDIT_SUM_DEBT"),
        F.when(F.col("o_orderpriority") == F.lit("1-URGENT"), F.col("o_totalprice") * F.lit(0.1))
         .otherwise(F.lit(0.0)).alias("AMT_CREDIT_MAX_OVERDUE"),
    )


def months_index(ts_col: str):
    return (F.lit(12) * (F.year(F.col(ts_col)) - F.lit(1999)) + F.month(F.col(ts_col)) - F.lit(1))


def bureau_balance_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as monthly balance rows of a bureau loan; status = return flag."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("SK_ID_BUREAU"),
                     months_index("l_shipdate").alias("MONTHS_BALANCE"),
                     F.col("l_returnflag").alias("STATUS"))


def bureau_balance_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as monthly status rows; low-value events carry no status."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("SK_ID_BUREAU"),
                     months_index("ts").alias("MONTHS_BALANCE"),
                     F.when(F.col("value") < F.lit(1.0), F.lit(None).cast("string"))
                      .otherwise(F.col("event_type")).alias("STATUS"))


def previous_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as previous applications; low-priority ones have no annuity."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_PREV"),
        F.col("o_orderstatus").alias("NAME_CONTRACT_STATUS"),
        F.col("o_totalprice").alias("AMT_CREDIT"),
        F.when(F.col("o_orderpriority") == F.lit("5-LOW"), F.lit(0.0))
         .otherwise(F.col("o_totalprice") / F.lit(12.0)).alias("AMT_ANNUITY"),
        (F.col("o_totalprice") * F.lit(0.9)).alias("AMT_GOODS_PRICE"),
        days_before("o_orderdate").alias("DAYS_DECISION"),
    )


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("SK_ID_CURR"), "c_nationkey", "c_acctbal", "c_mktsegment")


def applications(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """part as loan applications: (train with TARGET, test without).

    Brand#1x parts are the test rows. Large parts carry the "no employment"
    sentinel; tiny parts have no annuity; size-1 parts have a zero goods
    price; car age is mostly missing (dropped by the > 75 % rule).
    """
    p = read_table(spark, sf_dir, "part")
    size, price = F.col("p_size"), F.col("p_retailprice")
    base = p.select(
        F.col("p_partkey").alias("SK_ID_CURR"),
        (size > F.lit(25)).cast("double").alias("TARGET"),
        F.col("p_brand").startswith("Brand#1").alias("_test"),
        (-(F.lit(7000) + size * F.lit(300))).alias("DAYS_BIRTH"),
        F.when(size > F.lit(45), F.lit(365243)).otherwise(-(size * F.lit(97))).alias("DAYS_EMPLOYED"),
        (-(size * F.lit(50))).alias("DAYS_REGISTRATION"),
        (-(size * F.lit(10))).alias("DAYS_ID_PUBLISH"),
        (price * F.lit(100.0)).alias("AMT_INCOME_TOTAL"),
        (price * F.lit(300.0)).alias("AMT_CREDIT"),
        F.when(size < F.lit(5), F.lit(None).cast("double")).otherwise(price * F.lit(20.0)).alias("AMT_ANNUITY"),
        F.when(size == F.lit(1), F.lit(0.0)).otherwise(price * F.lit(250.0)).alias("AMT_GOODS_PRICE"),
        (size % F.lit(4)).cast("double").alias("CNT_FAM_MEMBERS"),
        F.when(size < F.lit(40), F.lit(None).cast("double")).otherwise(size.cast("double")).alias("OWN_CAR_AGE"),
        F.col("p_type").alias("NAME_TYPE"),
    )
    train = base.where(~F.col("_test")).drop("_test")
    test = base.where(F.col("_test")).drop("_test", "TARGET")
    return train, test


def pos_cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as monthly POS balance rows of a loan."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        months_index("l_shipdate").alias("MONTHS_BALANCE"),
        F.col("l_quantity").alias("CNT_INSTALMENT"),
        F.when(F.col("l_linestatus") == F.lit("F"), F.lit(0.0))
         .otherwise(F.col("l_quantity") - F.col("l_linenumber")).alias("CNT_INSTALMENT_FUTURE"),
        F.col("l_linenumber").alias("SK_DPD"),
        (F.col("l_returnflag") == F.lit("R")).cast("int").alias("SK_DPD_DEF"))


def credit_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as monthly card balance rows; open lines have no limit (0)."""
    li = read_table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    return li.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        months_index("l_shipdate").alias("MONTHS_BALANCE"),
        (price * F.col("l_tax")).alias("AMT_BALANCE"),
        F.when(F.col("l_linestatus") == F.lit("O"), F.lit(0.0)).otherwise(price).alias("AMT_CREDIT_LIMIT_ACTUAL"),
        (price * F.col("l_discount")).alias("AMT_DRAWINGS_CURRENT"),
        (price * (F.lit(1.0) - F.col("l_discount"))).alias("AMT_PAYMENT_CURRENT"),
        F.col("l_linenumber").alias("SK_DPD"),
        (F.col("l_returnflag") == F.lit("A")).cast("int").alias("SK_DPD_DEF"))


def client_applications(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """customer as loan applications (train with TARGET, test = BUILDING
    segment). Nation 3 carries the "no employment" sentinel; households
    have no annuity; nation 0, 5, ... have no family count (zero divisor);
    car age is mostly missing (dropped by the > 75 % rule)."""
    c = read_table(spark, sf_dir, "customer")
    bal, nat = F.col("c_acctbal"), F.col("c_nationkey")
    credit = F.abs(bal) * F.lit(30.0) + F.lit(500.0)
    base = c.select(
        F.col("c_custkey").alias("SK_ID_CURR"),
        (bal < F.lit(0.0)).cast("double").alias("TARGET"),
        (F.col("c_mktsegment") == F.lit("BUILDING")).alias("_test"),
        (-(F.lit(7000) + nat * F.lit(400))).alias("DAYS_BIRTH"),
        F.when(nat == F.lit(3), F.lit(365243)).otherwise(-(nat * F.lit(120))).alias("DAYS_EMPLOYED"),
        (-(nat * F.lit(30))).alias("DAYS_REGISTRATION"),
        (-(nat * F.lit(7))).alias("DAYS_ID_PUBLISH"),
        (F.abs(bal) * F.lit(10.0) + F.lit(1000.0)).alias("AMT_INCOME_TOTAL"),
        credit.alias("AMT_CREDIT"),
        F.when(F.col("c_mktsegment") == F.lit("HOUSEHOLD"), F.lit(None).cast("double"))
         .otherwise(credit / F.lit(20.0)).alias("AMT_ANNUITY"),
        (credit * F.lit(0.9)).alias("AMT_GOODS_PRICE"),
        (nat % F.lit(5)).cast("double").alias("CNT_FAM_MEMBERS"),
        F.when(nat < F.lit(20), F.lit(None).cast("double")).otherwise(nat.cast("double")).alias("OWN_CAR_AGE"),
        F.col("c_mktsegment").alias("NAME_TYPE"))
    train = base.where(~F.col("_test")).drop("_test")
    test = base.where(F.col("_test")).drop("_test", "TARGET")
    return train, test


def loan_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight raw tables of the feature pipeline, from the test tables."""
    train, test = client_applications(spark, sf_dir)
    return {"bureau_balance": bureau_balance_from_lineitem(spark, sf_dir), "bureau": bureau(spark, sf_dir),
            "previous_application": previous_applications(spark, sf_dir),
            "pos_cash_balance": pos_cash(spark, sf_dir), "installments_payments": instalments(spark, sf_dir),
            "credit_card_balance": credit_card(spark, sf_dir),
            "application_train": train, "application_test": test}
