"""Names of all registered queries with their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, fn: Query, sql: Optional[str] = None) -> None:
    if name in QUERIES:
        raise ValueError(f"duplicate query {name}")
    QUERIES[name] = fn
    if sql is not None:
        ORACLES[name] = sql


def query(name: str, sql: Optional[str] = None):
    def wrap(fn: Query) -> Query:
        register(name, fn, sql)
        return fn
    return wrap


# -- result columns ------------------------------------------------------------
def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def r6_double(c: str) -> Column:
    """``r6`` of a column of doubles, with the same results. Spark rounds by way of decimal text, which
    takes longer than a distance; only values near a tie, huge ones, NULL and NaN need it."""
    v = F.col(c)
    scaled = v * 1e6
    plain = (F.abs(v) < 1e6) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3)
    return F.when(plain, F.floor(scaled + 0.5) / 1e6).otherwise(F.round(v, 6))


def us(c: str = "ts") -> Column:
    return F.unix_micros(c)


def win_start(c: str = "window") -> Column:
    return F.unix_seconds(f"{c}.start")
