"""Dashboard queries on clients with predicted default probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import explore as X
from riskweave.operators import profile as PR
from riskweave.operators.exact import exact_sum
from riskweave.plans import oracle as O
from riskweave.plans import testdata_views as V
from riskweave.plans.catalog import register

CARD_FEATURES = ("c_acctbal", "N_ORDERS", "TOTAL_PRICE", "DAYS_FIRST_ORDER")
NEAR_COLS = ("c_acctbal", "N_ORDERS", "TOTAL_PRICE")


def scored_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client features ⋈ predictions on the client id (inner).

    The "prediction" is the client's share of finished orders, a [0, 1]
    value derived from the tables (the model scores come from M21)."""
    o = V.read_table(spark, sf_dir, "orders")
    per_client = o.groupBy(F.col("o_custkey").alias("SK_ID_CURR")).agg(
        F.count(F.lit(1)).alias("N_ORDERS"), exact_sum(F.col("o_totalprice")).alias("TOTAL_PRICE"),
        F.min(V.days_before("o_orderdate")).alias("DAYS_FIRST_ORDER"),
        F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("TARGET_proba"))
    c = V.read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("SK_ID_CURR"), "c_acctbal")
    return c.join(per_client, "SK_ID_CURR", "inner")


_SCORED_CTE = f"""sc AS (
  SELECT c.c_custkey AS SK_ID_CURR, c.c_acctbal, o.N_ORDERS, o.TOTAL_PRICE, o.DAYS_FIRST_ORDER, o.TARGET_proba
  FROM customer c JOIN (
    SELECT o_custkey, count(*) AS N_ORDERS, {O.xsum('o_totalprice')} AS TOTAL_PRICE,
           CAST(min({O.days_before('o_orderdate')}) AS INTEGER) AS DAYS_FIRST_ORDER,
           avg(CASE WHEN o_orderstatus = 'F' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END) AS TARGET_proba
    FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey)"""


@register("risk_band", f"""WITH {_SCORED_CTE}
SELECT SK_ID_CURR, {O.rnd('TARGET_proba')} AS TARGET_proba, {O.rnd('TARGET_proba * 100.0', 1)} AS score_pct,
       CASE WHEN TARGET_proba < 0.3 THEN 'Low Risk' WHEN TARGET_proba < 0.7 THEN 'Moderate Risk'
            WHEN TARGET_proba IS NOT NULL THEN 'High Risk' END AS band
FROM sc WHERE TARGET_proba >= 0.3 AND TARGET_proba < 0.7""")
def risk_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moderate-risk clients with their percent score and band label."""
    df = X.band_filter(scored_clients(spark, sf_dir), "Moderate Risk")
    out = X.with_band(df).select("SK_ID_CURR", "TARGET_proba",
                                 (F.col("TARGET_proba") * F.lit(100.0)).alias("score_pct"), "band")
    return out.withColumn("score_pct", _round1(F.col("score_pct")))


def _round1(c):
    from riskweave.operators.aggregate import round_fixed
    return round_fixed(c, 1)


@register("client_card", f"""WITH {_SCORED_CTE},
m AS (SELECT * FROM sc WHERE TARGET_proba >= 0.3 AND TARGET_proba < 0.7),
f AS (SELECT * FROM m ORDER BY SK_ID_CURR LIMIT 1)
SELECT SK_ID_CURR, 0 AS pos, 'c_acctbal' AS feature, {O.rnd('c_acctbal')} AS value FROM f
UNION ALL SELECT SK_ID_CURR, 1, 'N_ORDERS', {O.rnd('N_ORDERS')} FROM f
UNION ALL SELECT SK_ID_CURR, 2, 'TOTAL_PRICE', {O.rnd('TOTAL_PRICE')} FROM f
UNION ALL SELECT SK_ID_CURR, 3, 'DAYS_FIRST_ORDER', {O.rnd('DAYS_FIRST_ORDER')} FROM f
UNION ALL SELECT SK_ID_CURR, 4, 'YEARS_SINCE_FIRST_ORDER', {O.rnd('floor(abs(DAYS_FIRST_ORDER) / 365)')} FROM f
UNION ALL SELECT SK_ID_CURR, 5, 'SCORE_PCT', {O.rnd('TARGET_proba * 100.0', 1)} FROM f
UNION ALL SELECT (SELECT SK_ID_CURR FROM f), 6, 'BAND_MEAN_TOTAL_PRICE', {O.rnd(O.xmean('TOTAL_PRICE'), 2)} FROM m""")
def client_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First moderate-risk client: card values transposed, whole years, percent
    score, and the band's mean of the compared feature."""
    from riskweave.functions.scalar import whole_years
    band = X.band_filter(scored_clients(spark, sf_dir), "Moderate Risk")
    client = X.first_client(band).withColumns({
        "YEARS_SINCE_FIRST_ORDER": whole_years(F.abs(F.col("DAYS_FIRST_ORDER"))).cast("double"),
        "SCORE_PCT": _round1(F.col("TARGET_proba") * F.lit(100.0))})
    card = X.client_card(client, [*CARD_FEATURES, "YEARS_SINCE_FIRST_ORDER", "SCORE_PCT"])
    # (X.card_display adds the display strings; the check compares values)
    from riskweave.operators.aggregate import round_fixed
    # One number and one id come back to the driver (no cross join of rows).
    mean_val = X.feature_mean(band, "TOTAL_PRICE").first()["mean"]
    cid = client.select("SK_ID_CURR").first()
    extra = spark.createDataFrame([(cid["SK_ID_CURR"] if cid else None, 6, "BAND_MEAN_TOTAL_PRICE", mean_val)],
                                  "SK_ID_CURR long, pos int, feature string, value double")
    extra = extra.withColumn("value", round_fixed(F.col("value"), 2))
    return card.unionByName(extra)


@register("histogram", f"""WITH mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
pr AS (SELECT o_totalprice AS p FROM orders ORDER BY o_orderkey LIMIT 1),
b AS (SELECT CAST(least(floor((o_totalprice - lo) / (hi - lo) * 50.0) + 1, 50) AS INTEGER) AS bin FROM orders, mm
      WHERE o_totalprice IS NOT NULL),
c AS (SELECT bin, count(*) AS count FROM b GROUP BY bin)
SELECT bin, {O.rnd('lo + (bin - 1) * ((hi - lo) / 50.0)')} AS lo, {O.rnd('lo + bin * ((hi - lo) / 50.0)')} AS hi,
       count, bin = CAST(least(floor((p - lo) / (hi - lo) * 50.0) + 1, 50) AS INTEGER) AS is_probe_bin
FROM c, mm, pr""")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50 equal-width bins of the order price; the first order's bin marked."""
    o = V.read_table(spark, sf_dir, "orders")
    probe = o.orderBy("o_orderkey").select("o_totalprice").first()
    return PR.histogram(o, "o_totalprice", 50, probe=probe[0] if probe else None)


@register("nearest_clients", f"""WITH {_SCORED_CTE},
pr AS (SELECT * FROM sc ORDER BY SK_ID_CURR LIMIT 1),
d AS (SELECT sc.SK_ID_CURR, sc.TARGET_proba, sc.c_acctbal, sc.N_ORDERS, sc.TOTAL_PRICE,
             sqrt((CAST(sc.c_acctbal AS DOUBLE) - pr.c_acctbal) * (CAST(sc.c_acctbal AS DOUBLE) - pr.c_acctbal)
                + (CAST(sc.N_ORDERS AS DOUBLE) - pr.N_ORDERS) * (CAST(sc.N_ORDERS AS DOUBLE) - pr.N_ORDERS)
                + (CAST(sc.TOTAL_PRICE AS DOUBLE) - pr.TOTAL_PRICE) * (CAST(sc.TOTAL_PRICE AS DOUBLE) - pr.TOTAL_PRICE)) AS distance
      FROM sc, pr)
SELECT SK_ID_CURR, {O.rnd('TARGET_proba')} AS TARGET_proba, {O.rnd('c_acctbal')} AS c_acctbal, N_ORDERS,
       {O.rnd('TOTAL_PRICE')} AS TOTAL_PRICE, {O.rnd('distance')} AS distance,
       CAST(row_number() OVER (ORDER BY distance, SK_ID_CURR) AS INTEGER) AS rank
FROM d ORDER BY distance, SK_ID_CURR LIMIT 10""")
def nearest_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten clients closest to the first client (itself included)."""
    sc = scored_clients(spark, sf_dir).select("SK_ID_CURR", "TARGET_proba", *NEAR_COLS)
    probe = X.first_client(sc)
    return X.nearest_clients(sc, probe, NEAR_COLS, 10)


def _money(x: str) -> str:
    """Twin of ``format_number(x, 0)``: half to even, commas between thousands."""
    return f"format('{{:,}}', CAST(round_even({x}, 0) AS BIGINT))"


@register("client_lookup", f"""WITH {_SCORED_CTE},
ids AS (SELECT SK_ID_CURR FROM sc WHERE TARGET_proba >= 0.7),
last AS (SELECT * FROM sc WHERE SK_ID_CURR = (SELECT max(SK_ID_CURR) FROM ids))
SELECT 'id' AS kind, SK_ID_CURR, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS VARCHAR) AS display FROM ids
UNION ALL SELECT 'card', SK_ID_CURR, 'c_acctbal', {_money('c_acctbal')} FROM last
UNION ALL SELECT 'card', SK_ID_CURR, 'TOTAL_PRICE', {_money('TOTAL_PRICE')} FROM last
UNION ALL SELECT 'card', SK_ID_CURR, 'SCORE_PCT', printf('%.1f', {O.rnd('TARGET_proba * 100.0', 1)}) || '%' FROM last
UNION ALL SELECT 'card', SK_ID_CURR, 'N_ORDERS', printf('%.2f', CAST(N_ORDERS AS DOUBLE)) FROM last""")
def client_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the high-risk band, and the last of them looked up and shown as display strings."""
    scored = scored_clients(spark, sf_dir)
    ids = X.client_ids(X.band_filter(scored, "High Risk"))
    none = F.lit(None).cast("string")
    out = ids.select(F.lit("id").alias("kind"), "SK_ID_CURR", none.alias("feature"), none.alias("display"))
    last = ids.agg(F.max("SK_ID_CURR")).first()[0]  # one id
    client = X.client_by_id(scored, last).withColumn("SCORE_PCT", _round1(F.col("TARGET_proba") * F.lit(100.0)))
    card = X.card_display(X.client_card(client, ["c_acctbal", "TOTAL_PRICE", "SCORE_PCT", "N_ORDERS"]))
    return out.unionByName(card.select(F.lit("card").alias("kind"), "SK_ID_CURR", "feature", "display"))
