"""Registered queries on the driver's test tables, each with its DuckDB oracle.

Every query reads whole tables (or views Spark derives from them); nothing is
sampled, capped or filtered by id to make the check cheap. Sums, means and
variances do not depend on the order of rows (``operators.exact``), so doubles
are compared as they are; only ``correlation_pairs`` is quantised on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _load_all():
    # Import for side effects: each module registers its queries.
    from riskweave.plans import q_aggregate, q_encode, q_evaluate, q_explore, q_models  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
