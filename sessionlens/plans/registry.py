"""Registry of named queries: a Spark builder and, where SQL can say the
same thing, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sessionlens.sources.fixtures import sessions_narrow, sessions_wide, with_views


@dataclass
class Query:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(key: str, sql: str | None = None, note: str = ""):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``; ``sql`` is
    DuckDB text over the ``wide`` / ``narrow`` CTEs (added here)."""
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, with_views(sql) if sql else None, note)
        return fn
    return deco


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions_wide(spark, sf_dir)


def narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions_narrow(spark, sf_dir)
