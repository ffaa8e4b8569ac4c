"""Aggregations and profiles (inventory rows 52-73).

Everything is a ``groupBy`` (partial aggregation before the shuffle) or a
global aggregate; wide "one value per column" results are turned into long
form with ``stack`` so the number of output columns does not grow with the
input's schema.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.functions.scalars import behavior_label, value_sort_key
from sessionlens.operators.ordering import exact_quantiles
from sessionlens.schema import ROW_ORD, TARGET
from sessionlens.session import cut_lineage


def _stack(df: DataFrame, names, value_exprs, key="column_name", value="value") -> DataFrame:
    pairs = ", ".join(f"'{n}', {e}" for n, e in zip(names, value_exprs))
    return df.selectExpr(f"stack({len(names)}, {pairs}) AS ({key}, {value})")


def _data_cols(df: DataFrame):
    return [c for c in df.columns if c != ROW_ORD]


# -- users ---------------------------------------------------------------------

def user_stats(df: DataFrame) -> DataFrame:
    """Distinct sessions and clicks per user."""
    return df.groupBy("user_id").agg(
        F.count_distinct("session_id").alias("sessions"),
        F.sum(TARGET).cast("long").alias("clicks"))


def behavior_groups(df: DataFrame) -> DataFrame:
    """User -> ``"{n}_sessions_{k}_clicks"`` label."""
    s = user_stats(df)
    return s.select("user_id", behavior_label("sessions", "clicks").alias("label"))


def behavior_group_sizes(df: DataFrame) -> DataFrame:
    """Users per behaviour label (a count, never a collected user list)."""
    return behavior_groups(df).groupBy("label").agg(F.count(F.lit(1)).alias("n_users"))


# -- missing data -----------------------------------------------------------------

def missing_counts(df: DataFrame, columns=None) -> DataFrame:
    """Null count and percent per column, long form."""
    cols = list(columns or _data_cols(df))
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.sum(F.col(c).isNull().cast("long")).alias(f"_m_{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', `_m_{i}`" for i, c in enumerate(cols))
    long = agg.selectExpr("_rows", f"stack({len(cols)}, {pairs}) AS (column_name, n_missing)")
    return long.select("column_name", F.col("n_missing").cast("long").alias("n_missing"),
                       (F.col("n_missing") * 100.0 / F.col("_rows")).alias("pct_missing"))


def missing_by_user(df: DataFrame, features) -> DataFrame:
    """Null rate per user and feature (wide: one column per feature)."""
    return df.groupBy("user_id").agg(*[
        F.avg(F.col(c).isNull().cast("int")).alias(c) for c in features])


def categorize(rate: Column) -> Column:
    """Missing rate -> complete / partial / absent / other."""
    return (F.when(rate == 0, "complete").when((rate > 0) & (rate < 1), "partial")
             .when(rate == 1, "absent").otherwise("other"))


def missing_category(df: DataFrame, features) -> DataFrame:
    m = missing_by_user(df, features)
    return m.select("user_id", *[categorize(F.col(c)).alias(c) for c in features])


# The completeness classes, in report order.
CATEGORY_ORDER = ["complete", "partial", "absent"]


def category_counts(df: DataFrame, features) -> DataFrame:
    """Users in each completeness class per feature; 0 when none."""
    cats = missing_category(df, features)
    long = _stack(cats, features, [f"`{c}`" for c in features], "feature", "category")
    counts = long.groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n_users"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(f, c) for f in features for c in CATEGORY_ORDER],
                                 "feature string, category string")
    return (grid.join(counts, ["feature", "category"], "left")
                .select("feature", "category", F.coalesce("n_users", F.lit(0)).cast("long").alias("n_users")))


def value_counts_long(df: DataFrame, columns) -> DataFrame:
    """(column_name, v, k, n): rows per value of every column, nulls
    included (v null), from one scan and one partially-aggregated shuffle.
    ``v`` is the value as text, ``k`` its numeric order key (null for
    text). Checkpointed: the column reports below read it several times."""
    cols = list(columns)
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"),
                 value_sort_key(df, c).alias("k")) for c in cols])).alias("cell")
    g = df.select(cells).select("cell.*").groupBy("column_name", "v", "k").agg(F.count(F.lit(1)).alias("n"))
    return cut_lineage(g)


def column_levels(df: DataFrame, columns=None, show: int = 10) -> DataFrame:
    """Per column: distinct count, null count and the levels (all if at
    most ``show``, else the first ``show - 1``), smallest first.

    One scan builds the value counts; each column's levels are then a
    top-``show`` (per-task top-k, merged) over that small table.
    """
    cols = list(columns or _data_cols(df))
    g = value_counts_long(df, cols)
    nn = g.where(F.col("v").isNotNull())
    stats = g.groupBy("column_name").agg(
        F.count(F.when(F.col("v").isNotNull(), 1)).alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("n_null"))
    tops = [nn.where(F.col("column_name") == c).orderBy(F.col("k").asc_nulls_last(), "v").limit(show)
              .select("column_name", "k", "v") for c in cols]
    lv = (reduce(DataFrame.unionByName, tops).groupBy("column_name")
          .agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("_lv")))
    j = stats.join(lv, "column_name", "left")
    picked = F.when(F.col("n_distinct") <= show, F.col("_lv")).otherwise(F.slice("_lv", 1, show - 1))
    return j.select("column_name", "n_distinct",
                    F.array_join(F.transform(picked, lambda x: x["v"]), ",").alias("levels"), "n_null")


def describe_all(df: DataFrame, columns=None) -> DataFrame:
    """count, unique, top, freq, mean, std, min, quartiles, max per column
    (long form; numeric statistics are null for string columns). All from
    the one-scan value counts: quartiles are exact, from ranks over
    range-partitioned values; the standard deviation is a second pass over
    the counts."""
    cols = list(columns or _data_cols(df))
    numeric = {f.name for f in df.schema.fields
               if f.dataType.typeName() in ("long", "integer", "double", "float", "short", "byte")}
    g = value_counts_long(df, cols).where(F.col("v").isNotNull())
    g = g.withColumn("x", F.when(F.col("column_name").isin(list(numeric) or [""]), F.col("k")))
    first = g.groupBy("column_name").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("k"), F.col("v"))).alias("_top"),
        (F.sum(F.col("x") * F.col("n")) / F.sum(F.when(F.col("x").isNotNull(), F.col("n")))).alias("mean"),
        F.min("x").alias("min"), F.max("x").alias("max"))
    quartiles = exact_quantiles(g.select("column_name", "x", "n"), "column_name", "x", "n", (0.25, 0.5, 0.75))
    spread = (g.join(first.select("column_name", "mean"), "column_name")
               .groupBy("column_name").agg(F.sqrt(F.sum(F.col("n") * (F.col("x") - F.col("mean")) ** 2)
                                                  / F.nullif(F.sum(F.when(F.col("x").isNotNull(), F.col("n"))) - 1, F.lit(0)))
                                           .alias("std")))
    out = first.join(spread, "column_name").join(quartiles, "column_name", "left")
    num = F.col("column_name").isin(list(numeric) or [""])
    return out.select(
        "column_name", "count", "unique",
        F.when(num, F.col("mean")).alias("mean"), F.when(num, F.col("std")).alias("std"),
        F.when(num, F.col("min")).alias("min"),
        *[F.when(num, F.col("quantiles")[i]).alias(n) for i, n in enumerate(("q25", "q50", "q75"))],
        F.when(num, F.col("max")).alias("max"),
        F.col("_top.v").alias("top"), (-F.col("_top.neg_n")).alias("freq"))


def value_counts(df: DataFrame, column: str, normalize: bool = True) -> DataFrame:
    """Count per level (nulls dropped) and its share of the non-null rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    if not normalize:
        return counts
    total = counts.agg(F.sum("count").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
                  .withColumn("share", F.col("count") / F.col("_total")).drop("_total"))


def log_frequency(df: DataFrame) -> DataFrame:
    """log10 of the number of users per total click count."""
    per_user = df.groupBy("user_id").agg(F.sum(TARGET).cast("long").alias("clicks"))
    return (per_user.groupBy("clicks").agg(F.count(F.lit(1)).alias("n_users"))
                    .withColumn("log10_users", F.log10(F.col("n_users").cast("double"))))


def _level_sets(df: DataFrame, features, *others, aggs) -> DataFrame:
    """(feature, level, *others, *aggs): groups of every feature with
    ``others`` as GROUPING SETS of one aggregate over one scan; null levels
    are left out."""
    names = list(dict.fromkeys(features))
    rest = [F.col(c) for c in others]
    marks = [F.grouping(f).alias(f"_g_{f}") for f in names]
    g = df.groupingSets([[F.col(f), *rest] for f in names], *[F.col(f) for f in names], *rest).agg(*marks, *aggs)
    mine = [F.col(f"_g_{f}") == 0 for f in names]
    feature = F.coalesce(*[F.when(m, F.lit(f)) for m, f in zip(mine, names)])
    level = F.coalesce(*[F.when(m, F.col(f).cast("string")) for m, f in zip(mine, names)])
    kept = [c for c in g.columns if c not in names and not c.startswith("_g_") and c not in others]
    return g.select(feature.alias("feature"), level.alias("level"), *others, *kept).where(F.col("level").isNotNull())


def users_per_level(df: DataFrame, features) -> DataFrame:
    """Distinct users per level of each feature, long form, from one scan."""
    return _level_sets(df, features, aggs=[F.count_distinct("user_id").alias("n_users")])


def user_outcomes(df: DataFrame) -> DataFrame:
    """Per user: sessions_num, click_rate, click_num, any_click (one
    aggregate; the reference's inner join of two group-bys is not needed)."""
    return (df.groupBy("user_id").agg(
                F.count("session_id").alias("sessions_num"),
                F.avg(TARGET).alias("click_rate"),
                F.sum(TARGET).cast("long").alias("click_num"))
              .withColumn("any_click", (F.col("click_rate") > 0).cast("int")))


def first_value_per_user(df: DataFrame, feature: str, order_col: str = ROW_ORD) -> DataFrame:
    """The first non-null value of ``feature`` per user in row order."""
    first = F.min(F.when(F.col(feature).isNotNull(), F.struct(F.col(order_col), F.col(feature))))
    return (df.groupBy("user_id").agg(first[feature].alias(feature))
              .where(F.col(feature).isNotNull()))


def feature_user_outcomes(df: DataFrame, feature: str, filter_levels=None) -> DataFrame:
    """First feature value per user joined (inner) to the user outcomes,
    optionally keeping only some levels; ``any_click`` is the clickers rate."""
    fv = first_value_per_user(df, feature)
    if filter_levels is not None:
        fv = fv.where(F.col(feature).isin(list(filter_levels)))
    return fv.join(user_outcomes(df), "user_id", "inner").withColumnRenamed("any_click", "clickers_rate")


# Outcome names of the group report.
OUTCOMES = ("click_rate", "click_num", "sessions_num")


def outcome_by_group(df: DataFrame, group_features, outcome_type: str = "click_rate",
                     min_sessions: int = 0) -> DataFrame:
    """Outcome and session count per group of 1-2 features, groups with at
    least ``min_sessions`` sessions (a HAVING filter)."""
    keys = list(group_features)
    d = df.dropna(subset=[TARGET] + keys)
    agg = {"click_rate": F.avg(TARGET), "click_num": F.sum(TARGET).cast("long"),
           "sessions_num": F.count(TARGET)}[outcome_type]
    return (d.groupBy(*keys).agg(agg.alias(outcome_type),
                                  F.count(TARGET).alias("sessions_number"))
             .where(F.col("sessions_number") >= min_sessions))


def outcome_pivot(df: DataFrame, f1: str, f2: str, outcome_type: str = "click_rate",
                  min_sessions: int = 0, values=None) -> DataFrame:
    """Rows = levels of ``f1``, columns = levels of ``f2``, cell = outcome,
    empty -> 0. ``values`` fixes the pivot columns (skips a distinct job)."""
    out = outcome_by_group(df, [f1, f2], outcome_type, min_sessions)
    p = out.groupBy(f1).pivot(f2, values).agg(F.first(outcome_type))
    return p.fillna(0)


def outcome_batch(df: DataFrame, features, outcomes=OUTCOMES, against: str = "campaign_id",
                  min_sessions: int = 0) -> DataFrame:
    """Row 64 for every (outcome, feature) against ``against``, as one long
    table from one scan: the features are grouping sets of one aggregate and
    the outcomes are three of its columns."""
    d = df.where(F.col(TARGET).isNotNull() & F.col(against).isNotNull()).select(*dict.fromkeys(features), against, TARGET)
    g = _level_sets(d, features, against, aggs=[
        F.avg(TARGET).alias("click_rate"), F.sum(TARGET).cast("double").alias("click_num"),
        F.count(TARGET).alias("sessions_number")]).where(F.col("sessions_number") >= min_sessions)
    vals = {"click_rate": "click_rate", "click_num": "click_num",
            "sessions_num": "CAST(sessions_number AS DOUBLE)"}
    stack = ", ".join(f"'{o}', {vals[o]}" for o in outcomes)
    return g.selectExpr(f"stack({len(outcomes)}, {stack}) AS (outcome, value)", "feature", "level",
                        against, "sessions_number")


def outcome_batch_top(batch: DataFrame, n: int = 10, against: str = "campaign_id") -> DataFrame:
    """The ``n`` best groups of every (outcome, feature), with ``rank`` from 1;
    ties by level, then ``against``. The limit on the rank cuts each task's
    groups to ``n`` rows before the shuffle."""
    best = Window.partitionBy("outcome", "feature").orderBy(F.desc("value"), F.asc("level"), F.asc(against))
    return batch.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("long"))


def outcome_batch_pivot(batch: DataFrame, against: str = "campaign_id", values=None) -> DataFrame:
    """Every (outcome, feature, level) as a row, the levels of ``against`` as
    columns, empty -> 0. ``values`` fixes the columns (skips a distinct job)."""
    p = batch.groupBy("outcome", "feature", "level").pivot(against, values).agg(F.first("value"))
    return p.fillna(0)


def top_groups(df: DataFrame, by: str, n: int = 10, tie_keys=()) -> DataFrame:
    """The ``n`` best groups by ``by`` (TakeOrderedAndProject: top-n per task)."""
    return df.orderBy(F.desc(by), *[F.asc(k) for k in tie_keys]).limit(n)


def group_quantiles(df: DataFrame, keys, probs=(0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """Exact (linear) quantiles of the group sizes of ``keys``."""
    sizes = df.dropna(subset=list(keys) + [TARGET]).groupBy(*keys).agg(F.count(TARGET).alias("n"))
    q = sizes.agg(F.percentile(F.col("n").cast("double"), F.array(*[F.lit(p) for p in probs])).alias("q"))
    return q.select(F.posexplode("q").alias("_i", "value")).select(
        F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("_i") + 1).alias("quantile"), "value")


def n_clickers_rate(df: DataFrame, n_clicks: int) -> DataFrame:
    """Per campaign: users exposed, and for N = 0..n the share of them with
    more than N clicks in total (null when there is none)."""
    d = df.dropna(subset=["user_id", "campaign_id", TARGET])
    per_user = d.groupBy("user_id").agg(F.sum(TARGET).alias("_clicks"))
    pairs = d.select("campaign_id", "user_id").distinct().join(per_user, "user_id")
    aggs = [F.count(F.lit(1)).alias("exposure")]
    for n in range(n_clicks + 1):
        aggs.append(F.count(F.when(F.col("_clicks") > n, 1)).alias(f"_c{n}"))
    g = pairs.groupBy("campaign_id").agg(*aggs)
    return g.select(F.col("campaign_id").cast("string").alias("campaign_id"), "exposure",
                    *[F.when(F.col(f"_c{n}") > 0, F.col(f"_c{n}") / F.col("exposure"))
                       .alias(f"rate_{n}") for n in range(n_clicks + 1)])


def column_max_norm(df: DataFrame, columns, scale: float = 100.0) -> DataFrame:
    """Each column (times ``scale``) divided by its maximum over all rows;
    the maxima are one row, joined by broadcast."""
    mx = df.agg(*[F.max(F.col(c) * scale).alias(f"_max_{c}") for c in columns])
    j = df.crossJoin(F.broadcast(mx))
    keep = [c for c in df.columns if c not in columns]
    return j.select(*keep, *[(F.col(c) * scale / F.col(f"_max_{c}")).alias(c) for c in columns])


def category_by_product(df: DataFrame, category: str = "product_category_1") -> DataFrame:
    """Distinct categories per product: is product -> category functional?"""
    return df.groupBy("product").agg(
        F.count_distinct(category).alias("n_categories"),
        F.array_join(F.array_sort(F.collect_set(F.col(category).cast("string"))), ",").alias("categories"))


def _any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def cleaning_loss(before: DataFrame, after: DataFrame, columns=None) -> DataFrame:
    """Percent of rows lost, and percent of non-null values lost per column."""
    cols = list(columns or _data_cols(after))
    b = before.agg(F.count(F.lit(1)).alias("_rb"), *[F.count(c).alias(f"_b_{i}") for i, c in enumerate(cols)])
    a = after.agg(F.count(F.lit(1)).alias("_ra"), *[F.count(c).alias(f"_a_{i}") for i, c in enumerate(cols)])
    j = b.crossJoin(a)
    names = ["__rows__"] + cols
    exprs = ["try_divide(CAST(_rb - _ra AS DOUBLE) * 100, _rb)"] + [
        f"try_divide(CAST(`_b_{i}` - `_a_{i}` AS DOUBLE) * 100, `_b_{i}`)" for i in range(len(cols))]
    return _stack(j, names, exprs, "column_name", "pct_lost")


def missing_rows_ctr(df: DataFrame, columns=None) -> DataFrame:
    """Rows, clicks and CTR in rows that dropna would drop vs keep."""
    cols = [c for c in (columns or _data_cols(df)) if c != TARGET]
    return (df.withColumn("has_missing", _any_null(cols))
              .groupBy("has_missing").agg(F.count(F.lit(1)).alias("rows"),
                                          F.sum(TARGET).cast("long").alias("clicks"),
                                          F.avg(TARGET).alias("ctr")))


def duplicate_report(df: DataFrame, subset=None) -> DataFrame:
    """Groups of duplicated rows (by ``subset`` or all data columns) with
    their copy count and surplus (copies beyond the first)."""
    keys = list(subset or _data_cols(df))
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
              .where(F.col("copies") > 1).withColumn("surplus", F.col("copies") - 1))


