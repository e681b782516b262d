"""Registry of runnable queries: name -> (callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


# Values are cut to six digits with the same floating-point steps in Spark and in SQL. The offset is a hair above one
# half, so a value that sits exactly between two results goes up on both sides whatever the order of a float sum.
_HALF = "0.5000001"


def r6(col: Column | str) -> Column:
    """Six digits by floor(x * 1e6 + half) / 1e6."""
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(c.cast("double") * F.lit(1e6) + F.lit(float(_HALF))) / F.lit(1e6)


def q6(expr: str) -> str:
    return f"(FLOOR(CAST({expr} AS DOUBLE) * CAST(1e6 AS DOUBLE) + CAST({_HALF} AS DOUBLE)) / CAST(1e6 AS DOUBLE))"
