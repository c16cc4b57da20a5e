"""Queries of this subpackage and their SQL twins."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` under ``name``."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load_all() -> None:
    """Import every operator module of this subpackage, which registers its query."""
    package = importlib.import_module(__package__)
    for module in pkgutil.iter_modules(package.__path__):
        importlib.import_module(f"{__package__}.{module.name}")
