"""Projections, filters and cleaning (inventory rows 11-32)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.schema import COLUMNS_TO_DROP, ROW_ORD, TARGET


def data_columns(df: DataFrame) -> list[str]:
    """Columns that carry data (everything but the row order)."""
    return [c for c in df.columns if c != ROW_ORD]


def known_flags(df: DataFrame) -> DataFrame:
    """Two "is known" flags from null tests of the sparse columns."""
    return (df.withColumn("secondary_product_category_known", F.col("product_category_2").isNotNull())
              .withColumn("city_development_index_known", F.col("city_development_index").isNotNull()))


def drop_columns(df: DataFrame, cols=tuple(COLUMNS_TO_DROP)) -> DataFrame:
    return df.drop(*cols)


def null_sentinel(df: DataFrame, column: str = "age_level", sentinel=0) -> DataFrame:
    """A sentinel value (age level 0 = unknown) becomes null."""
    return df.withColumn(column, F.nullif(F.col(column), F.lit(sentinel)))


def dropna_subset(df: DataFrame, subset=("session_id",)) -> DataFrame:
    return df.dropna(how="any", subset=list(subset))


def drop_duplicates(df: DataFrame, subset=None) -> DataFrame:
    """Drop full duplicates (nulls compare equal), keeping the first row.

    One hash aggregate: partial aggregation combines copies map-side, so a
    value repeated a billion times shrinks before the shuffle.
    """
    keys = list(subset) if subset else data_columns(df)
    if ROW_ORD not in df.columns:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys and c != ROW_ORD]
    aggs = [F.min(ROW_ORD).alias(ROW_ORD)]
    if rest:
        # other columns come from the first row of each group
        first = F.min(F.struct(F.col(ROW_ORD), *[F.col(c) for c in rest])).alias("_first")
        out = df.groupBy(*keys).agg(first)
        return out.select(*keys, *[F.col("_first")[c].alias(c) for c in rest],
                          F.col("_first")[ROW_ORD].alias(ROW_ORD)).select(*df.columns)
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)


def dropna_any(df: DataFrame, subset=None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else data_columns(df))


def clean_train(df: DataFrame) -> DataFrame:
    """Flags, drop sparse columns, sentinel, dropna(session_id), dedupe, dropna."""
    df = drop_columns(known_flags(df))
    df = null_sentinel(df)
    df = dropna_subset(df, ["session_id"])
    df = drop_duplicates(df)
    return dropna_any(df)


def clean_inference(df: DataFrame) -> DataFrame:
    """Flags and drops only; every row is kept."""
    return drop_columns(known_flags(df))


def cleaning_report(df: DataFrame) -> DataFrame:
    """Rows dropped at each training-cleaning step, in one row.

    Unlike the reference, duplicates are counted before they are removed.
    Two aggregations: one over distinct rows (with their copy counts), one
    global sum of that small result.
    """
    df = null_sentinel(drop_columns(known_flags(df)))
    cols = data_columns(df)
    grouped = (df.withColumn("_nullsid", F.col("session_id").isNull())
                 .groupBy(*cols, "_nullsid").agg(F.count(F.lit(1)).alias("_n")))
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return grouped.agg(
        F.sum("_n").alias("rows_in"),
        F.sum(F.when(F.col("_nullsid"), F.col("_n")).otherwise(0)).alias("dropped_null_session_id"),
        F.sum(F.when(~F.col("_nullsid"), F.col("_n") - 1).otherwise(0)).alias("dropped_duplicates"),
        F.sum(F.when(~F.col("_nullsid") & any_null, 1).otherwise(0)).alias("dropped_na"),
        F.sum(F.when(~F.col("_nullsid") & ~any_null, 1).otherwise(0)).alias("rows_out"),
    )


def dropna_all_subset(df: DataFrame, all_subset, any_subset=None) -> DataFrame:
    """Drop rows where every column of ``all_subset`` is null, then rows with
    a null in any column of ``any_subset`` (the low-missing columns)."""
    out = df.dropna(how="all", subset=list(all_subset))
    if any_subset:
        out = out.dropna(how="any", subset=list(any_subset))
    return out


def limit_rows(df: DataFrame, n: int | None = None, skip: int = 0) -> DataFrame:
    """First ``n`` rows in input order, after skipping ``skip`` rows."""
    out = df.orderBy(ROW_ORD)
    if skip:
        out = out.offset(skip)
    if n is not None:
        out = out.limit(n)
    return out


def rename_column(df: DataFrame, old: str = "product_category_1",
                  new: str = "product_category") -> DataFrame:
    if old in df.columns and new not in df.columns:
        return df.withColumnRenamed(old, new)
    return df


def cast_float_to_int(df: DataFrame, null_free_only: bool = False) -> DataFrame:
    """Every float / double column to 64-bit int (truncation, as ``astype(int)``).

    ``null_free_only`` keeps columns that hold nulls (one extra aggregate).
    """
    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if null_free_only and floats:
        row = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in floats]).first()
        floats = [c for c in floats if row[c] == 0]
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in floats else F.col(c)
                       for c in df.columns])


def filter_user(df: DataFrame, user_id, columns=None) -> DataFrame:
    out = df.filter(F.col("user_id") == F.lit(user_id))
    return out.select(*columns) if columns else out


def filter_click(df: DataFrame, clicked: bool = True) -> DataFrame:
    return df.filter(F.col(TARGET) == (1 if clicked else 0))


def time_range_split(df: DataFrame, val_start: str, test_start: str,
                     ts: str = "DateTime") -> DataFrame:
    """``split`` = train before ``val_start``, val before ``test_start``, else test.
    Rows without a time get no split and are dropped, as in the reference."""
    t = F.col(ts)
    label = (F.when(t < F.lit(val_start).cast(df.schema[ts].dataType), "train")
              .when(t < F.lit(test_start).cast(df.schema[ts].dataType), "val")
              .when(t.isNotNull(), "test"))
    return df.withColumn("split", label).filter(F.col("split").isNotNull())


def time_range_part(df: DataFrame, lo: str | None, hi: str | None,
                    ts: str = "DateTime") -> DataFrame:
    """One part of a time split as a plain range filter, pushed to the scan."""
    t, typ = F.col(ts), df.schema[ts].dataType
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (t >= F.lit(lo).cast(typ))
    if hi is not None:
        cond = cond & (t < F.lit(hi).cast(typ))
    return df.filter(cond)


def split_xy(df: DataFrame, target: str = TARGET):
    """(features, labels), both keyed by the row order."""
    return df.drop(target), df.select(ROW_ORD, target)


def combine_xy(x: DataFrame, y: DataFrame) -> DataFrame:
    return x.join(y, on=ROW_ORD, how="inner")


def combine_categories(df: DataFrame, c1: str = "product_category_1",
                       c2: str = "product_category_2",
                       out: str = "product_cat_comb") -> DataFrame:
    """``"{c1}_{c2}"`` with null read as 0; ``"0_0"`` becomes null."""
    key = F.concat_ws("_", F.coalesce(F.col(c1).cast("bigint"), F.lit(0)).cast("string"),
                      F.coalesce(F.col(c2).cast("bigint"), F.lit(0)).cast("string"))
    return df.withColumn(out, F.nullif(key, F.lit("0_0")))


def align_schema(df: DataFrame, target_columns, fill=0) -> DataFrame:
    """Add missing columns as ``fill``, drop extra ones, use the target order."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in target_columns])


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per column name of either side: present left / right, and
    the row counts of both sides (do the lengths match?)."""
    spark = left.sparkSession
    names = list(dict.fromkeys(list(left.columns) + list(right.columns)))
    lset, rset = set(left.columns), set(right.columns)
    dup_l = {c for c in left.columns if left.columns.count(c) > 1}
    meta = spark.createDataFrame(
        [(c, c in lset, c in rset, c in dup_l) for c in names],
        "column_name string, in_left boolean, in_right boolean, duplicated boolean")
    counts = left.agg(F.count(F.lit(1)).alias("left_rows")).crossJoin(
        right.agg(F.count(F.lit(1)).alias("right_rows")))
    return meta.crossJoin(counts).withColumn(
        "lengths_match", F.col("left_rows") == F.col("right_rows"))
