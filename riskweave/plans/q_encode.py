"""Encoding, imputation, profile and schema queries (F2-F17, A12-A14, U1,
P5-P13, J3, S1-S5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import names as N
from riskweave.functions.scalar import (abs_widened, days_to_years, null_if_sentinel,
                                        sentinel_flag)
from riskweave.operators import contract as C
from riskweave.operators import encode as E
from riskweave.plans import features as feat
from riskweave.plans import oracle as O
from riskweave.plans import testdata_views as V
from riskweave.plans.catalog import register
from riskweave.plans.loan_specs import INS_SPEC
from riskweave.session import scratch_path

# --- F4, F14 ------------------------------------------------------------------

_LABEL_SQL = f"""WITH o AS (
  SELECT o_orderkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders),
{O.label_codes_cte('cs', 'o', 'o_orderstatus')}, {O.label_codes_cte('cp', 'o', 'o_orderpriority')}
SELECT o.o_orderkey, cs.code AS o_orderstatus, cp.code AS o_orderpriority
FROM o JOIN cs ON coalesce(o.o_orderstatus, 'Unknown') = cs.v
       JOIN cp ON coalesce(o.o_orderpriority, 'Unknown') = cp.v"""


@register("label_encode", _LABEL_SQL)
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of sorted distinct values; the missing priority of pending orders is 'Unknown'."""
    o = V.read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
         .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    return E.label_encode(o, ["o_orderstatus", "o_orderpriority"])


# --- F4, F15 --------------------------------------------------------------------

_ONEHOT_SQL = ("SELECT c_custkey, " + O.rnd("c_acctbal") + " AS c_acctbal, "
               + ", ".join(f"CAST(CASE WHEN coalesce(c_mktsegment, 'Unknown') = '{v}' THEN 1 ELSE 0 END "
                           f"AS INTEGER) AS \"c_mktsegment_{v}\"" for v in O.SEGMENTS)
               + " FROM customer")


@register("one_hot", _ONEHOT_SQL)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = V.read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return E.one_hot(c, ["c_mktsegment"])


# --- A12, F6, M1 ------------------------------------------------------------------

def _nulled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = V.read_table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    return o.select(
        "o_orderkey", "o_custkey", price.alias("PRICE"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("double")).otherwise(price).alias("P_LOW"),
        F.when(F.col("o_orderstatus") != "O", F.lit(None).cast("double")).otherwise(price).alias("P_OPEN"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"), price)
         .otherwise(F.lit(None).cast("double")).alias("P_RARE"),
        V.days_before("o_orderdate").alias("DAYS_ORDER"))


_NULLED_CTE = f"""o AS (
  SELECT o_orderkey, o_custkey, o_totalprice AS PRICE,
         CASE WHEN o_orderpriority = '5-LOW' THEN CAST(NULL AS DOUBLE) ELSE o_totalprice END AS P_LOW,
         CASE WHEN o_orderstatus <> 'O' THEN CAST(NULL AS DOUBLE) ELSE o_totalprice END AS P_OPEN,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN o_totalprice
              ELSE CAST(NULL AS DOUBLE) END AS P_RARE,
         CAST({O.days_before('o_orderdate')} AS INTEGER) AS DAYS_ORDER
  FROM orders)"""
_NULLED_COLS = ("o_orderkey", "o_custkey", "PRICE", "P_LOW", "P_OPEN", "P_RARE", "DAYS_ORDER")

_MISSING_SQL = f"WITH {_NULLED_CTE}, s AS (SELECT " + ", ".join(
    f"avg(CASE WHEN {c} IS NULL THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END) AS {c}"
    for c in _NULLED_COLS) + " FROM o)\n" + "\nUNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS pos, '{c}' AS column_name, {O.rnd(c)} AS missing_share, "
    f"{c} > CAST(0.75 AS DOUBLE) AS dropped_75, {c} > CAST(0.9 AS DOUBLE) AS dropped_90 FROM s"
    for i, c in enumerate(_NULLED_COLS))


@register("missing_profile", _MISSING_SQL)
def missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing share per column in one aggregate, unpivoted to one row per column."""
    o = _nulled_orders(spark, sf_dir)
    cols = o.columns
    wide = o.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column_name"), F.col(c).alias("missing_share"))
        for i, c in enumerate(cols)])))
    return long.select(
        "pos", "column_name", "missing_share",
        (F.col("missing_share") > F.lit(0.75)).alias("dropped_75"),
        (F.col("missing_share") > F.lit(0.9)).alias("dropped_90"))


# P_RARE has ~93 % missing: above both thresholds in the test tables.
@register("drop_high_missing", f"WITH {_NULLED_CTE} SELECT o_orderkey, o_custkey, {O.rnd('PRICE')} AS PRICE, "
          f"{O.rnd('P_LOW')} AS P_LOW, {O.rnd('P_OPEN')} AS P_OPEN, DAYS_ORDER FROM o")
def drop_high_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _dropped = E.drop_high_missing(_nulled_orders(spark, sf_dir), 0.75)
    return df


# --- A13, F5, F2 -----------------------------------------------------------------

@register("median_impute", f"""WITH {_NULLED_CTE},
m AS (SELECT median(P_LOW) AS m_low, median(P_OPEN) AS m_open, median(P_RARE) AS m_rare FROM o)
SELECT o_orderkey, {O.rnd('coalesce(P_LOW, m_low)')} AS P_LOW, {O.rnd('coalesce(P_OPEN, m_open)')} AS P_OPEN,
       {O.rnd('coalesce(P_RARE, m_rare)')} AS P_RARE FROM o, m""")
def median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _nulled_orders(spark, sf_dir).select("o_orderkey", "P_LOW", "P_OPEN", "P_RARE")
    return E.median_impute(o, ["P_LOW", "P_OPEN", "P_RARE"])


@register("ratio_impute", f"""WITH {_NULLED_CTE},
r AS (SELECT o_orderkey, CAST(PRICE AS DOUBLE) / nullif(CAST(CASE WHEN P_LOW IS NULL THEN 0 ELSE DAYS_ORDER END AS DOUBLE), 0) AS PRICE_DAY_RATIO FROM o),
m AS (SELECT median(PRICE_DAY_RATIO) AS med FROM r)
SELECT o_orderkey, {O.rnd('coalesce(PRICE_DAY_RATIO, med)')} AS PRICE_DAY_RATIO FROM r, m""")
def ratio_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratio with a zero denominator (low-priority orders) filled with the ratio's median."""
    o = _nulled_orders(spark, sf_dir).select(
        "o_orderkey", "PRICE",
        F.when(F.col("P_LOW").isNull(), F.lit(0)).otherwise(F.col("DAYS_ORDER")).alias("DEN"))
    return E.ratio_impute(o, {"PRICE_DAY_RATIO": ("PRICE", "DEN")}).select("o_orderkey", "PRICE_DAY_RATIO")


# --- F7-F9 -------------------------------------------------------------------------

@register("sentinel_flag", """WITH a AS (
  SELECT p_partkey, abs(CASE WHEN p_size > 45 THEN 365243 ELSE -(p_size * 97) END) AS DE,
         abs(-(7000 + p_size * 300)) AS DAYS_BIRTH FROM part)
SELECT p_partkey, DAYS_BIRTH, """ + O.rnd("CAST(DAYS_BIRTH AS DOUBLE) / CAST(365.0 AS DOUBLE)") + """ AS AGE_YEARS,
       """ + O.rnd("CAST(DE AS DOUBLE) / CAST(365.0 AS DOUBLE)") + """ AS EMPLOYMENT_YEARS,
       DE = 365243 AS DAYS_EMPLOYED_ANOM,
       CASE WHEN DE = 365243 THEN NULL ELSE DE END AS DAYS_EMPLOYED FROM a""")
def sentinel_flag_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """abs -> years -> flag -> NULL, in the reference's order (years keep the sentinel)."""
    p = V.read_table(spark, sf_dir, "part")
    size = F.col("p_size")
    d = p.select("p_partkey",
                 abs_widened(F.when(size > 45, F.lit(365243)).otherwise(-(size * 97)), False).alias("DE"),
                 abs_widened(-(F.lit(7000) + size * 300), False).alias("DAYS_BIRTH"))
    return d.select(
        "p_partkey", "DAYS_BIRTH", days_to_years("DAYS_BIRTH").alias("AGE_YEARS"),
        days_to_years("DE").alias("EMPLOYMENT_YEARS"),
        sentinel_flag("DE").alias("DAYS_EMPLOYED_ANOM"),
        null_if_sentinel("DE").alias("DAYS_EMPLOYED"))


# --- U1, P5, F2, F5, F6, F7-F9: whole application stage ----------------------------

_APP_SQL = f"""WITH {O.APP_RAW_CTE},
med AS (SELECT median(AMT_ANNUITY) AS m_ann FROM app_raw),
a1 AS (
  SELECT SK_ID_CURR, TARGET, abs(DAYS_BIRTH) AS DAYS_BIRTH, abs(DAYS_EMPLOYED) AS DE,
         abs(DAYS_REGISTRATION) AS DAYS_REGISTRATION, abs(DAYS_ID_PUBLISH) AS DAYS_ID_PUBLISH,
         AMT_INCOME_TOTAL, AMT_CREDIT, coalesce(AMT_ANNUITY, m_ann) AS AMT_ANNUITY, AMT_GOODS_PRICE,
         CNT_FAM_MEMBERS, NAME_TYPE
  FROM app_raw, med),
a2 AS (
  SELECT *, CAST(DAYS_BIRTH AS DOUBLE) / 365.0 AS AGE_YEARS, CAST(DE AS DOUBLE) / 365.0 AS EMPLOYMENT_YEARS,
         CAST(DAYS_REGISTRATION AS DOUBLE) / 365.0 AS REGISTRATION_YEARS,
         CAST(DAYS_ID_PUBLISH AS DOUBLE) / 365.0 AS ID_PUBLISH_YEARS,
         DE = 365243 AS DAYS_EMPLOYED_ANOM, CASE WHEN DE = 365243 THEN NULL ELSE DE END AS DAYS_EMPLOYED,
         AMT_INCOME_TOTAL / nullif(AMT_CREDIT, 0) AS r1, AMT_INCOME_TOTAL / nullif(CNT_FAM_MEMBERS, 0) AS r2,
         AMT_ANNUITY / nullif(AMT_INCOME_TOTAL, 0) AS r3, AMT_CREDIT / nullif(AMT_GOODS_PRICE, 0) AS r4
  FROM a1),
rm AS (SELECT median(r1) AS m1, median(r2) AS m2, median(r3) AS m3, median(r4) AS m4 FROM a2)
SELECT SK_ID_CURR, TARGET, DAYS_BIRTH, DAYS_EMPLOYED, DAYS_REGISTRATION, DAYS_ID_PUBLISH,
       {O.rnd('AMT_INCOME_TOTAL')} AS AMT_INCOME_TOTAL, {O.rnd('AMT_CREDIT')} AS AMT_CREDIT,
       {O.rnd('AMT_ANNUITY')} AS AMT_ANNUITY, {O.rnd('AMT_GOODS_PRICE')} AS AMT_GOODS_PRICE,
       {O.rnd('CNT_FAM_MEMBERS')} AS CNT_FAM_MEMBERS, NAME_TYPE,
       {O.rnd('AGE_YEARS')} AS AGE_YEARS, {O.rnd('EMPLOYMENT_YEARS')} AS EMPLOYMENT_YEARS,
       {O.rnd('REGISTRATION_YEARS')} AS REGISTRATION_YEARS, {O.rnd('ID_PUBLISH_YEARS')} AS ID_PUBLISH_YEARS,
       DAYS_EMPLOYED_ANOM,
       {O.rnd('coalesce(r1, m1)')} AS INCOME_CREDIT_RATIO, {O.rnd('coalesce(r2, m2)')} AS INCOME_PER_PERSON,
       {O.rnd('coalesce(r3, m3)')} AS ANNUITY_INCOME_RATIO, {O.rnd('coalesce(r4, m4)')} AS CREDIT_GOODS_RATIO
FROM a2, rm"""


@register("application_features", _APP_SQL)
def application_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of train and test, > 75 % missing columns dropped (OWN_CAR_AGE here),
    medians filled, days made positive, years, sentinel, ratios with median fill."""
    train, test = V.applications(spark, sf_dir)
    return feat.application_features(train, test)


# --- U1, P5 --------------------------------------------------------------------------

@register("union_split", f"""SELECT c_custkey AS SK_ID_CURR, c_nationkey, {O.rnd('c_acctbal')} AS c_acctbal,
  CAST(CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS TARGET, 'train' AS split
FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL
SELECT c_custkey, c_nationkey, {O.rnd('c_acctbal')}, CAST(NULL AS DOUBLE), 'test' FROM customer
WHERE c_mktsegment = 'BUILDING'""")
def union_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train rows carry a label, test rows lack the column; union by name, split back."""
    c = V.read_table(spark, sf_dir, "customer")
    base = c.select(F.col("c_custkey").alias("SK_ID_CURR"), "c_nationkey", "c_acctbal", "c_mktsegment")
    train = (base.where(F.col("c_mktsegment") != "BUILDING")
                 .withColumn("TARGET", (F.col("c_acctbal") < 0).cast("double")).drop("c_mktsegment"))
    test = base.where(F.col("c_mktsegment") == "BUILDING").drop("c_mktsegment")
    both = E.union_by_name(train, test)
    tr, te = feat.split_train_test(both)
    out = (tr.withColumn("split", F.lit("train"))
             .unionByName(te.withColumn("split", F.lit("test")), allowMissingColumns=True))
    return out


# --- J3, F3: star of left joins ------------------------------------------------------

def _star_sql() -> str:
    b_sql, b_t = O.bureau_agg_sql(None, with_types=True)
    p_sql, p_t = O.prev_agg_sql(1, with_types=True)
    i_sql, i_t = O.two_level_sql(
        child_cte=O.INSTALMENTS_CTE + ",\n" + O.INSTALMENT_FEATURES_CTE, child_table="ins_rows",
        link_sql="SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV FROM orders",
        child_key="SK_ID_PREV", parent_key="SK_ID_CURR", spec=INS_SPEC, types=O.INS_TYPES,
        prefix="INS", with_types=True)
    cols = ["c.SK_ID_CURR", "c.c_nationkey", f"{O.rnd('c.c_acctbal')} AS c_acctbal"]
    cols += [f"CAST(CASE WHEN coalesce(c.c_mktsegment, 'Unknown') = '{v}' THEN 1 ELSE 0 END AS INTEGER) "
             f"AS \"c_mktsegment_{v}\"" for v in O.SEGMENTS]
    for alias, types in (("b", b_t), ("p", p_t), ("i", i_t)):
        for n, t in types.items():
            zero = "CAST(0.0 AS DOUBLE)" if t == "double" else "0"
            cols.append(f'{O.typed(f"coalesce({alias}.\"{n}\", {zero})", t) if t != "double" else f"coalesce({alias}.\"{n}\", {zero})"} AS "{n}"')
    return (f"WITH c AS (SELECT c_custkey AS SK_ID_CURR, c_nationkey, c_acctbal, c_mktsegment FROM customer)\n"
            f"SELECT {', '.join(cols)}\nFROM c LEFT JOIN ({b_sql}) b ON c.SK_ID_CURR = b.SK_ID_CURR\n"
            f"LEFT JOIN ({p_sql}) p ON c.SK_ID_CURR = p.SK_ID_CURR\n"
            f"LEFT JOIN ({i_sql}) i ON c.SK_ID_CURR = i.SK_ID_CURR")


@register("star_merge", _star_sql())
def star_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client row one-hot encoded and left-joined to three per-client feature
    tables (bureau, previous loans, instalments two-level), missing -> 0."""
    parts = [feat.bureau_client_agg(V.bureau(spark, sf_dir), None),
             feat.previous_client_agg(V.previous_applications(spark, sf_dir), 1),
             feat.instalments_client_agg(V.instalments(spark, sf_dir), V.loan_links(spark, sf_dir))]
    return feat.merge_features(V.clients(spark, sf_dir), parts)


# --- A14, F16 --------------------------------------------------------------------------

_NARROW_COLS = (("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                ("l_discount", "double"), ("l_tax", "double"))


def _narrow_case(c: str, t: str) -> str:
    if t == "double":
        return "'double'"
    return (f"CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint' "
            f"WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint' "
            f"WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END")


@register("type_narrow", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS source_type, {O.rnd(f'min({c})')} AS min_value, "
    f"{O.rnd(f'max({c})')} AS max_value, {_narrow_case(c, t)} AS narrow_type FROM lineitem"
    for c, t in _NARROW_COLS))
def type_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest integer type per column from one min/max pass; floats stay double."""
    li = V.read_table(spark, sf_dir, "lineitem")
    types = dict(li.dtypes)
    plan = E.narrow_plan(li, [c for c, _ in _NARROW_COLS])
    rows = [(n, types[n], float(lo), float(hi), t) for n, lo, hi, t in plan]
    # The plan holds one row per column (p values, not data rows).
    return spark.createDataFrame(
        rows, "column_name string, source_type string, min_value double, max_value double, narrow_type string")


# --- F17 ---------------------------------------------------------------------------------

@register("standardise", f"""WITH c AS (SELECT c_custkey, c_acctbal, CAST(c_nationkey >= 0 AS INTEGER) * 1.0 AS k FROM customer),
s AS (SELECT {O.xmean('c_acctbal')} AS m1, sqrt({O.xvar('c_acctbal')}) AS s1, {O.xmean('k')} AS m2, sqrt({O.xvar('k')}) AS s2 FROM c)
SELECT c_custkey, {O.rnd('(c_acctbal - m1) / CASE WHEN s1 = 0 OR s1 IS NULL THEN 1.0 ELSE s1 END')} AS c_acctbal,
       {O.rnd('(k - m2) / CASE WHEN s2 = 0 OR s2 IS NULL THEN 1.0 ELSE s2 END')} AS k FROM c, s""")
def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(x - mean) / population sd; a constant column (k) has sd 0 -> divides by 1."""
    c = V.read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", ((F.col("c_nationkey") >= 0).cast("int") * F.lit(1.0)).alias("k"))
    return E.standardise(c, ["c_acctbal", "k"])


# --- P6-P8, F21 ---------------------------------------------------------------------------

@register("clean_names", r"""WITH v AS (SELECT DISTINCT coalesce(p_type, 'Unknown') AS v FROM part),
n AS (SELECT CAST(1 + row_number() OVER (ORDER BY v) AS INTEGER) AS pos, 'p_type_' || v AS original FROM v
      UNION ALL SELECT 0, 'p_partkey' UNION ALL SELECT 1, 'p_retailprice')
SELECT pos, original,
       regexp_replace(regexp_replace(original, '[^\w\s]', '_', 'g'), '\s+', '_', 'g') AS cleaned FROM n""")
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of a one-hot frame over part types (blanks inside values) cleaned for a model."""
    p = V.read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_type")
    wide = E.one_hot(p, ["p_type"])
    _, mapping = N.clean_feature_names(wide)
    rows = [(i, o, mapping[o]) for i, o in enumerate(wide.columns)]
    return spark.createDataFrame(rows, "pos int, original string, cleaned string")


# --- P13, U2 ------------------------------------------------------------------------------

@register("schema_diff", """WITH c AS (SELECT c_custkey, c_acctbal, c_mktsegment,
                         CASE WHEN c_mktsegment = 'BUILDING' THEN 'test' ELSE 'train' END AS split FROM customer),
cols AS (
  SELECT split, 'c_custkey' AS column_name, 'bigint' AS t FROM (SELECT DISTINCT split FROM c)
  UNION ALL SELECT split, 'c_acctbal', 'double' FROM (SELECT DISTINCT split FROM c)
  UNION ALL SELECT DISTINCT split, 'c_mktsegment_' || coalesce(c_mktsegment, 'Unknown'), 'int' FROM c),
l AS (SELECT column_name, t FROM cols WHERE split = 'train'),
r AS (SELECT column_name, t FROM cols WHERE split = 'test')
SELECT coalesce(l.column_name, r.column_name) AS column_name, l.t AS left_type, r.t AS right_type,
       l.column_name IS NOT NULL AND r.column_name IS NOT NULL AS in_both
FROM l FULL OUTER JOIN r ON l.column_name = r.column_name""")
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train vs test column sets after one-hot encoding each split on its own
    (the test split lacks the segments it never saw): the check run before
    scoring. The one-hot columns come from a distinct-value scan of each split."""
    c = V.read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    train = E.one_hot(c.where(F.col("c_mktsegment") != "BUILDING"), ["c_mktsegment"])
    test = E.one_hot(c.where(F.col("c_mktsegment") == "BUILDING"), ["c_mktsegment"])
    rows = [(col, lt, rt, lt is not None and rt is not None) for col, lt, rt in N.schema_diff(train, test)]
    return spark.createDataFrame(rows, "column_name string, left_type string, right_type string, in_both boolean")


# --- P12 -----------------------------------------------------------------------------------

_CONTRACT = ("P_LOW", "P_OPEN", "PRICE")


@register("contract_check", f"""WITH {_NULLED_CTE}
SELECT o_orderkey, nullif(concat_ws(',', CASE WHEN P_LOW IS NULL THEN 'P_LOW' END,
       CASE WHEN P_OPEN IS NULL THEN 'P_OPEN' END, CASE WHEN PRICE IS NULL THEN 'PRICE' END), '') AS missing_features,
       {O.rnd('P_LOW')} AS P_LOW, {O.rnd('P_OPEN')} AS P_OPEN, {O.rnd('PRICE')} AS PRICE FROM o""")
def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows checked against an ordered contract; missing values listed per row
    (accepted rows have NULL), extra columns dropped, contract order kept."""
    df = C.enforce_columns(_nulled_orders(spark, sf_dir), _CONTRACT, keep=["o_orderkey"])
    return df.withColumn("missing_features", C.missing_features(_CONTRACT))


# --- S1-S5, P1, P2, P10, P11, A24 ----------------------------------------------------------

@register("io_roundtrip", f"""SELECT c_custkey, c_name, c_nationkey, {O.rnd('c_acctbal')} AS c_acctbal, c_mktsegment,
  'csv' AS via FROM customer
UNION ALL SELECT c_custkey, c_name, c_nationkey, {O.rnd('c_acctbal')}, c_mktsegment, 'parquet' FROM customer""")
def io_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the customer table as CSV and Parquet into the shared checkpoint
    folder, read both back (CSV through the declared schema and the missing
    tokens), report rows and columns (A24)."""
    from riskweave.sources import io
    cust = V.read_table(spark, sf_dir, "customer")
    csv_path, pq_path = scratch_path(spark, "customer-csv"), scratch_path(spark, "customer-pq")
    io.write_csv(cust, csv_path)
    io.write_stage(cust, pq_path)
    schema = ", ".join(f"{n} {t}" for n, t in cust.dtypes)
    back_csv = io.read_csv(spark, csv_path, schema)
    back_pq = io.read_stage(spark, pq_path)
    assert io.profile(back_pq)[1] == len(cust.columns)
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return (back_csv.select(*cols).withColumn("via", F.lit("csv"))
            .unionByName(back_pq.select(*cols).withColumn("via", F.lit("parquet"))))


# --- §3.1 end to end ---------------------------------------------------------------------

@register("feature_table", O.feature_table_sql())
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole client feature table: balance shares -> bureau rollup, previous
    loans, three two-level child aggregates, application stage, one-hot, star
    of left joins, fill 0. Parts are checkpointed to the shared folder."""
    from riskweave.sources import runs
    tables = V.loan_tables(spark, sf_dir)
    shapes: dict = {}
    out = feat.build_feature_table(tables, checkpoint_dir=scratch_path(spark, "features"), shapes=shapes)
    # Stage shapes, counted while the stages were written, go to the run table
    runs.log_run(spark, runs.run_table_path(spark), "feature_pipeline", "shapes", {},
                 {f"{k}_{d}": v for k, (r, c) in shapes.items() for d, v in (("rows", r), ("columns", c))})
    return out


# --- F4, F5, F14, F15, F17 fitted, saved and loaded ------------------------------------------

_FITTED_COLS = ("c_custkey", "c_name", "segment", "balance")
_FITTED_SQL = f"""WITH c AS (
  SELECT c_custkey, c_name, CASE WHEN c_nationkey % 2 = 1 THEN NULL ELSE c_mktsegment END AS segment,
         CASE WHEN c_nationkey = 5 THEN NULL ELSE c_acctbal END AS balance, c_mktsegment <> 'BUILDING' AND c_custkey % 2 = 0 AS train FROM customer),
names AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT coalesce(c_name, 'Unknown') AS v FROM c WHERE train)),
m AS (SELECT median(balance) AS med FROM c WHERE train),
filled AS (SELECT c.*, coalesce(balance, med) AS b FROM c, m),
s AS (SELECT {O.xmean('b')} AS mean, sqrt({O.xvar('b')}) AS sd FROM filled WHERE train)
SELECT c_custkey, coalesce(names.code, -1) AS c_name, (b - mean) / CASE WHEN sd = 0 THEN 1.0 ELSE sd END AS balance,
       {', '.join(f"CAST(coalesce(segment, 'Unknown') = '{v}' AS INTEGER) AS segment_{v}" for v in ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY", "Unknown"))}
FROM filled LEFT JOIN names ON coalesce(c_name, 'Unknown') = names.v, s"""


@register("fitted_encoders", _FITTED_SQL)
def fitted_encoders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoders learn from half of the clients without one segment; all clients are encoded from disk alone.

    The other half's names and the left-out segment are unseen."""
    from pyspark.ml import Pipeline, PipelineModel

    from riskweave.operators.fitted import CategoryEncoder, MedianFill, PopulationScaler
    from riskweave.session import scratch_path
    c = V.read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_nationkey") % 2 != 1, F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_nationkey") != 5, F.col("c_acctbal")).alias("balance"), "c_mktsegment")
    train = c.where((F.col("c_mktsegment") != "BUILDING") & (F.col("c_custkey") % 2 == 0))
    path = scratch_path(spark, "encoders")
    Pipeline(stages=[MedianFill(["balance"]), PopulationScaler(["balance"]), CategoryEncoder(["c_name"]),
                     CategoryEncoder(["segment"], kind="onehot")]).fit(train).write().save(path)
    return PipelineModel.load(path).transform(c.select(*_FITTED_COLS))


# --- S1: malformed records ---------------------------------------------------------------------

@register("csv_rejects", """SELECT 'row' AS kind, o_orderkey AS id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS price,
       CAST(NULL AS VARCHAR) AS cause, CAST(NULL AS BIGINT) AS records
FROM orders WHERE o_orderstatus <> 'P' AND o_custkey % 7 <> 0
UNION ALL SELECT 'cause', NULL, NULL, 'price', count(*) FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0
UNION ALL SELECT 'cause', NULL, NULL, 'day', count(*) FROM orders WHERE o_custkey % 7 = 0 HAVING count(*) > 0""")
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV with missing tokens and malformed prices and days: the rows that fit, and the rejects by cause."""
    from riskweave.session import scratch_path
    from riskweave.sources import io
    o = V.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("12,5O")).when(F.col("o_orderpriority") == "5-LOW", F.lit("NA"))
        .otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(F.col("o_custkey") % 7 == 0, F.lit("yesterday")).otherwise(V.days_before("o_orderdate").cast("string")).alias("day"))
    path = scratch_path(spark, "malformed")
    io.write_csv(o, path)
    rows, rejects = io.read_csv_checked(spark, path, "id long, price double, day int")
    none = lambda t: F.lit(None).cast(t)
    return rows.select(F.lit("row").alias("kind"), "id", "price", none("string").alias("cause"), none("long").alias("records")).unionByName(
        io.reject_counts(rejects).select(F.lit("cause").alias("kind"), none("long").alias("id"), none("double").alias("price"), "cause", "records"))


# --- F16 applied -----------------------------------------------------------------------------------

@register("narrowed_table", """SELECT n AS column_name, t AS type, total FROM (
  SELECT 'l_orderkey' AS n, CASE WHEN max(l_orderkey) <= 127 THEN 'tinyint' WHEN max(l_orderkey) <= 32767 THEN 'smallint'
         WHEN max(l_orderkey) <= 2147483647 THEN 'int' ELSE 'bigint' END AS t, CAST(sum(l_orderkey) AS BIGINT) AS total FROM lineitem
  UNION ALL SELECT 'l_linenumber', CASE WHEN max(l_linenumber) <= 127 THEN 'tinyint' ELSE 'smallint' END, CAST(sum(l_linenumber) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'l_quantity', 'double', CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) FROM lineitem)""")
def narrowed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns cast to their narrowest types, written, read back and summed: the types hold on disk and no value changes."""
    from riskweave.session import scratch_path
    from riskweave.sources import io
    cols = ["l_orderkey", "l_linenumber", "l_quantity"]
    narrow = io.checkpoint_stage(spark, E.narrow_types(V.read_table(spark, sf_dir, "lineitem").select(*cols)), scratch_path(spark, "narrow"))
    totals = narrow.agg(*(F.sum(F.col(c).cast("long")).alias(c) for c in cols))
    return totals.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type"), F.col(c).alias("total"))
                                            for c, t in narrow.dtypes))))
