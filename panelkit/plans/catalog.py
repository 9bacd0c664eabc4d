"""Query catalog: one Spark query and (where SQL can say it) one DuckDB SQL per operator.

Query modules register with ``@query(key, sql)``. Doubles that are results of
arithmetic are rounded to 6 places on both sides so the oracle hash compares
values, not the last bit of a floating-point sum order.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}
DOC: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        DOC[key] = (fn.__doc__ or "").strip().splitlines()[0] if fn.__doc__ else ""
        return fn
    return deco


def r6(c) -> Column:
    """Round a double result to 6 places (the SQL side uses round(x, 6))."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def load_all() -> None:
    """Import every query module so its entries register."""
    from . import (q_sources, q_filters, q_joins, q_aggs, q_windows, q_ranking,  # noqa: F401
                   q_scalars, q_features, q_model, q_metrics, q_streaming, q_wide, q_loads)
