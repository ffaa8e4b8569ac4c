"""Mergeable distinct counts (inventory rows 52-62 at scale).

The exact counts of ``profile`` shuffle one row per (level, user). A sketch
is a few kilobytes whatever it counts, so one scan leaves one row per day and
level; days, weeks or the whole table are then unions of these small rows,
and a new day adds its own rows only.

``hll_sketch_agg`` of 2^``lg`` registers has a relative standard error of
1.04 / sqrt(2^lg); ``error_bound`` is four of them (1.6 % each at 12).

Defined results: null values are not counted; null levels are left out; a
null time is a day of its own; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG = 12


def error_bound(lg: int = LG) -> float:
    """Relative error that an estimate stays within (four standard errors)."""
    return 4 * 1.04 / math.sqrt(1 << lg)


def _sketch(df: DataFrame, column: str, lg: int) -> Column:
    kept = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)
    value = F.col(column) if isinstance(df.schema[column].dataType, kept) else F.col(column).cast("string")
    return F.hll_sketch_agg(value, lg)


def level_sketches(df: DataFrame, features, counted: str = "user_id", ts: str = "DateTime", lg: int = LG) -> DataFrame:
    """(day, feature, level, sketch): the distinct ``counted`` per level of
    each feature and day, all features from one scan."""
    names = list(dict.fromkeys(features))
    d = df.select(F.to_date(ts).alias("day"), F.col(counted).alias("_counted"), *names)
    day = F.col("day")
    sets = d.groupingSets([[day, F.col(f)] for f in names], day, *[F.col(f) for f in names])
    g = sets.agg(*[F.grouping(f).alias(f"_g_{f}") for f in names], _sketch(d, "_counted", lg).alias("sketch"))
    feature = F.coalesce(*[F.when(F.col(f"_g_{f}") == 0, F.lit(f)) for f in names])
    level = F.coalesce(*[F.when(F.col(f"_g_{f}") == 0, F.col(f).cast("string")) for f in names])
    return g.select("day", feature.alias("feature"), level.alias("level"), "sketch").where(F.col("level").isNotNull())


def column_sketches(df: DataFrame, columns, ts: str = "DateTime", lg: int = LG) -> DataFrame:
    """(day, column_name, sketch): the distinct values of every column and
    day from one scan; partial sketches meet in one row a day."""
    names = list(columns)
    g = df.groupBy(F.to_date(ts).alias("day")).agg(*[_sketch(df, c, lg).alias(f"_s{i}") for i, c in enumerate(names)])
    pairs = ", ".join(f"'{c}', _s{i}" for i, c in enumerate(names))
    return g.selectExpr("day", f"stack({len(names)}, {pairs}) AS (column_name, sketch)")


def merged(sketches: DataFrame, *keys) -> DataFrame:
    """One sketch per ``keys``: the union over all else (days, levels)."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct(sketches: DataFrame, name: str = "n_distinct") -> DataFrame:
    """The sketches' estimates in place of the sketches."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def within(estimate: str, exact: str, lg: int = LG) -> Column:
    """Whether an estimate keeps to the error bound (at least one is allowed)."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), F.lit(error_bound(lg)) * F.col(exact))
