"""Exploration queries of the scoring dashboard (P3, P4, P14-P16, F8, F18,
F20, F23, A15, K7), as parameterised DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.functions.scalar import RISK_BAND_EDGES, l2_distance, percent_score, risk_band
from riskweave.operators.exact import exact_mean

BANDS = {"All": (None, None), "Low Risk": (None, RISK_BAND_EDGES[0]),
         "Moderate Risk": RISK_BAND_EDGES, "High Risk": (RISK_BAND_EDGES[1], None)}


def band_filter(df: DataFrame, band: str = "All", proba_col: str = "TARGET_proba") -> DataFrame:
    """Low < .3 <= moderate < .7 <= high (pushed to the scan when the
    probability is a stored column)."""
    lo, hi = BANDS[band]
    out = df
    if lo is not None:
        out = out.where(F.col(proba_col) >= F.lit(lo))
    if hi is not None:
        out = out.where(F.col(proba_col) < F.lit(hi))
    return out


def with_band(df: DataFrame, proba_col: str = "TARGET_proba") -> DataFrame:
    """percent score (1 digit) and band label."""
    return df.withColumns({"score_pct": percent_score(proba_col, 1), "band": risk_band(proba_col)})


def client_by_id(df: DataFrame, client_id, id_col: str = "SK_ID_CURR") -> DataFrame:
    """The rows of one client; none if the id is not there (a null id finds nothing)."""
    return df.where(F.col(id_col) == F.lit(client_id))


def client_ids(df: DataFrame, id_col: str = "SK_ID_CURR") -> DataFrame:
    """The sorted list of the (filtered) clients' ids, each once; empty if the filter leaves none."""
    return df.select(id_col).where(F.col(id_col).isNotNull()).distinct().orderBy(id_col)


def first_client(df: DataFrame, id_col: str = "SK_ID_CURR") -> DataFrame:
    """The first client id of the (filtered) list; empty if none."""
    return df.orderBy(id_col).limit(1)


def client_card(client: DataFrame, features: Sequence[str], id_col: str = "SK_ID_CURR") -> DataFrame:
    """One client's row transposed to (feature, value)."""
    return client.select(id_col, F.inline(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"))
        for i, f in enumerate(features)])))


def feature_mean(df: DataFrame, col: str) -> DataFrame:
    """Mean of a column over the (filtered) clients, shown with 2 digits."""
    return df.agg(exact_mean(F.col(col)).alias("mean"))


def nearest_clients(df: DataFrame, probe: DataFrame, cols: Sequence[str], k: int = 10,
                    id_col: str = "SK_ID_CURR") -> DataFrame:
    """K7: the k rows closest to the probe row by unscaled L2 distance over
    ``cols`` (the probe itself included, distance ties broken by id).

    The probe's few values come to the driver and enter the plan as
    literals; ``orderBy(...).limit(k)`` plans as a distributed top-k (each
    task keeps k rows), so no task sees all rows."""
    row = probe.select(*[F.col(c).cast("double").alias(c) for c in cols]).first()
    if row is None:
        return df.sparkSession.createDataFrame([], df.select(*df.columns).schema).withColumns(
            {"distance": F.lit(None).cast("double"), "rank": F.lit(None).cast("int")})
    dist = l2_distance(list(cols), {c: row[c] for c in cols})
    top = (df.select(*df.columns, dist.alias("distance"))
             .orderBy(F.col("distance").asc_nulls_last(), F.col(id_col)).limit(k))
    # k rows: numbering them is bounded work.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(
        F.col("distance").asc_nulls_last(), F.col(id_col))))


MONEY_FEATURES = ("AMT_INCOME_TOTAL", "AMT_CREDIT", "TOTAL_PRICE", "c_acctbal")


def card_display(card: DataFrame) -> DataFrame:
    """display strings for a transposed card: money without decimals,
    percent with one, other values with two (grouping commas)."""
    v, f = F.col("value"), F.col("feature")
    return card.withColumn("display", F.when(f.isin(*MONEY_FEATURES), F.format_number(v, 0))
                           .when(f == F.lit("SCORE_PCT"), F.concat(F.format_number(v, 1), F.lit("%")))
                           .otherwise(F.format_number(v, 2)))
