"""Registry of named queries: each is a (spark, sf_dir) -> DataFrame job over
the driver's tables, optionally paired with an ANSI SQL oracle text."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r6(c):
    """Round a double result to 6 decimals (sums depend on evaluation order)."""
    from pyspark.sql import functions as F
    return F.round(c, 6)


def union_all_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)
