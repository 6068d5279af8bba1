"""Query catalogue: name -> Spark plan and DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input tables. Oracle SQL runs on the same parquet files as DuckDB
views. Computed columns carry the same alias on both sides; doubles that
depend on summation order are rounded to 6 places on both sides.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

_MODULES = (
    "strataforge.plans.q_frame",
    "strataforge.plans.q_clean",
    "strataforge.plans.q_profile",
    "strataforge.plans.q_sampling",
    "strataforge.plans.q_results",
    "strataforge.plans.q_text",
    "strataforge.plans.q_model",
    "strataforge.plans.q_classify",
    "strataforge.plans.q_incremental",
)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(m)
        except ModuleNotFoundError as e:  # phases not yet written
            if e.name != m:
                raise


def r6(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def cte(**parts: str) -> str:
    """``WITH a AS (...), b AS (...)`` prefix."""
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in parts.items()) + "\n"
