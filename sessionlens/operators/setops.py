"""Sorts, limits, unions and set differences (rows 127-132; 128 is
``profile.top_groups``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.schema import ROW_ORD


def sort_sessions(df: DataFrame, by: str = "user_time") -> DataFrame:
    """Sort by (user, time), by time, or by original order; nulls last and
    the row order breaks ties (pandas' stable sort). A range-partitioned
    distributed sort."""
    keys = {"user_time": ["user_id", "DateTime"], "time": ["DateTime"], "original": []}[by]
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys], F.col(ROW_ORD))


def union_splits(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name (train, val and test after processing)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_sources(a: DataFrame, b: DataFrame, drop=(ROW_ORD,)) -> DataFrame:
    """Stack two labelled sources and drop duplicate rows."""
    u = a.drop(*drop).unionByName(b.drop(*drop), allowMissingColumns=True)
    return u.dropDuplicates()


def rows_only_once(a: DataFrame, b: DataFrame) -> DataFrame:
    """Concatenate, then drop every row that has a copy (symmetric
    difference for frames without inner duplicates). Missing columns are
    null on the side that lacks them."""
    u = a.unionByName(b, allowMissingColumns=True)
    cols = u.columns
    return (u.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") == 1).drop("_n"))


def dropped_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of ``before`` that are not in ``after`` (multiset difference)."""
    return before.exceptAll(after.select(*before.columns))
