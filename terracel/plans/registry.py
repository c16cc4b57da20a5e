"""Registered queries: a Spark callable and, where SQL can say it, its twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = with_views(sql)
        return fn

    return register


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """``df`` with the named columns rounded (and minus zero made zero)."""
    return df.withColumns({c: F.round(F.col(c), n) + F.lit(0.0) for c, n in digits.items()})
