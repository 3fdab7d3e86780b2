"""Feature contract (P12): ordered names the model was fitted on.

Column level: a missing contract column is an error, extra columns are
dropped (or rejected), the output is in contract order. Row level: rows with
a missing contract value are routed to a reject output with the list of
missing features, instead of failing the whole batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    pass


def enforce_columns(df: DataFrame, contract: Sequence[str], keep: Sequence[str] = (),
                    extra: str = "drop") -> DataFrame:
    cols = set(df.columns)
    missing = [c for c in contract if c not in cols]
    if missing:
        raise ContractError(f"missing contract features: {missing}")
    extras = [c for c in df.columns if c not in set(contract) and c not in set(keep)]
    if extras and extra == "error":
        raise ContractError(f"features outside the contract: {extras}")
    return df.select(*[c for c in keep if c in cols], *contract)


def missing_features(contract: Sequence[str]) -> Column:
    """Comma list of contract features missing in the row, NULL if none."""
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in contract])
    return F.when(names == F.lit(""), F.lit(None).cast("string")).otherwise(names)


def split_rows(df: DataFrame, contract: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); rejected rows carry ``missing_features``."""
    tagged = df.withColumn("missing_features", missing_features(contract))
    return (tagged.where(F.col("missing_features").isNull()).drop("missing_features"),
            tagged.where(F.col("missing_features").isNotNull()))
