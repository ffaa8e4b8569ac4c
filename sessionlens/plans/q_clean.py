"""Queries for cleaning (rows 11-32) and scalar functions (rows 133-140)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlens.functions import scalars as S
from sessionlens.operators import cleaning
from sessionlens.plans.registry import register, wide

EXCL = "EXCLUDE (product_category_2, city_development_index)"
FLAGS = ("product_category_2 IS NOT NULL AS secondary_product_category_known, "
         "city_development_index IS NOT NULL AS city_development_index_known")
INFER_SQL = f"SELECT * {EXCL}, {FLAGS} FROM wide"
SENT_SQL = f"SELECT * REPLACE (NULLIF(age_level, 0) AS age_level) FROM ({INFER_SQL})"
TRAIN_COLS = ["session_id", "DateTime", "user_id", "product", "campaign_id", "webpage_id",
              "product_category_1", "user_group_id", "gender", "age_level", "user_depth", "var_1",
              "is_click", "score", "secondary_product_category_known", "city_development_index_known"]


def _q(c):
    return f'"{c}"'


def _not_null_all(cols):
    return " AND ".join(f"{_q(c)} IS NOT NULL" for c in cols)


@register("known_flags", sql=f"SELECT row_ord, {FLAGS} FROM wide")
def q_known_flags(spark, sf_dir):
    return cleaning.known_flags(wide(spark, sf_dir)).select(
        "row_ord", "secondary_product_category_known", "city_development_index_known")


@register("drop_columns", sql=f"SELECT * {EXCL} FROM wide")
def q_drop_columns(spark, sf_dir):
    return cleaning.drop_columns(wide(spark, sf_dir))


@register("null_sentinel", sql="SELECT row_ord, NULLIF(age_level, 0) AS age_level FROM wide")
def q_null_sentinel(spark, sf_dir):
    return cleaning.null_sentinel(wide(spark, sf_dir)).select("row_ord", "age_level")


@register("dropna_subset", sql="SELECT * FROM wide WHERE session_id IS NOT NULL")
def q_dropna_subset(spark, sf_dir):
    return cleaning.dropna_subset(wide(spark, sf_dir), ["session_id"])


_DUP_SUBSET = ["user_id", "DateTime", "product", "campaign_id", "webpage_id"]


@register("drop_duplicates", sql=f"""SELECT * FROM wide WHERE row_ord IN (
  SELECT min(row_ord) FROM wide GROUP BY {", ".join(_q(c) for c in _DUP_SUBSET)})""")
def q_drop_duplicates(spark, sf_dir):
    return cleaning.drop_duplicates(wide(spark, sf_dir), _DUP_SUBSET)


@register("dropna_any", sql=f"SELECT * FROM ({INFER_SQL}) WHERE {_not_null_all(TRAIN_COLS)}")
def q_dropna_any(spark, sf_dir):
    return cleaning.dropna_any(cleaning.clean_inference(wide(spark, sf_dir)))


@register("clean_train", sql=f"""SELECT * FROM ({SENT_SQL}) WHERE session_id IS NOT NULL
  AND {_not_null_all(TRAIN_COLS)} AND row_ord IN (SELECT min(row_ord) FROM ({SENT_SQL})
  WHERE session_id IS NOT NULL GROUP BY ALL EXCLUDE (row_ord))""".replace(
    "GROUP BY ALL EXCLUDE (row_ord)", "GROUP BY " + ", ".join(_q(c) for c in TRAIN_COLS)))
def q_clean_train(spark, sf_dir):
    return cleaning.clean_train(wide(spark, sf_dir))


@register("clean_inference", sql=INFER_SQL)
def q_clean_inference(spark, sf_dir):
    return cleaning.clean_inference(wide(spark, sf_dir))


@register("cleaning_report", sql=f"""
  , s AS ({SENT_SQL}),
  g AS (SELECT {", ".join(_q(c) for c in TRAIN_COLS)}, count(*) AS n FROM s GROUP BY ALL)
  SELECT (SELECT count(*) FROM s) AS rows_in,
         (SELECT count(*) FROM s WHERE session_id IS NULL) AS dropped_null_session_id,
         (SELECT CAST(sum(n - 1) AS BIGINT) FROM g WHERE session_id IS NOT NULL) AS dropped_duplicates,
         (SELECT count(*) FROM g WHERE session_id IS NOT NULL AND NOT ({_not_null_all(TRAIN_COLS)})) AS dropped_na,
         (SELECT count(*) FROM g WHERE session_id IS NOT NULL AND {_not_null_all(TRAIN_COLS)}) AS rows_out""")
def q_cleaning_report(spark, sf_dir):
    return cleaning.cleaning_report(wide(spark, sf_dir))


@register("dropna_all_subset", sql="""SELECT * FROM wide WHERE
  (product_category_2 IS NOT NULL OR city_development_index IS NOT NULL) AND gender IS NOT NULL""")
def q_dropna_all_subset(spark, sf_dir):
    return cleaning.dropna_all_subset(wide(spark, sf_dir),
                                      ["product_category_2", "city_development_index"], ["gender"])


@register("limit_rows", sql="SELECT * FROM wide ORDER BY row_ord LIMIT 1500")
def q_limit_rows(spark, sf_dir):
    # the smoke switch of the reference: the first 1500 rows is the feature
    return cleaning.limit_rows(wide(spark, sf_dir), 1500)


@register("rename_column", sql="SELECT * RENAME (product_category_1 AS product_category) FROM wide")
def q_rename_column(spark, sf_dir):
    return cleaning.rename_column(wide(spark, sf_dir))


@register("cast_float_to_int", sql="SELECT * REPLACE (CAST(trunc(score) AS INTEGER) AS score) FROM wide")
def q_cast_float_to_int(spark, sf_dir):
    return cleaning.cast_float_to_int(wide(spark, sf_dir))


@register("filter_user", sql='SELECT row_ord, "DateTime", product, is_click FROM wide WHERE user_id = 7')
def q_filter_user(spark, sf_dir):
    return cleaning.filter_user(wide(spark, sf_dir), 7, ["row_ord", "DateTime", "product", "is_click"])


@register("filter_click", sql="SELECT * FROM wide WHERE is_click = 1")
def q_filter_click(spark, sf_dir):
    return cleaning.filter_click(wide(spark, sf_dir), True)


VAL_START, TEST_START = "2024-01-20 00:00:00", "2024-01-25 00:00:00"
SPLIT_CASE = (f"""CASE WHEN "DateTime" < TIMESTAMP '{VAL_START}' THEN 'train'
  WHEN "DateTime" < TIMESTAMP '{TEST_START}' THEN 'val' WHEN "DateTime" IS NOT NULL THEN 'test' END""")


@register("time_range_split", sql=f'SELECT row_ord, "DateTime", {SPLIT_CASE} AS split FROM wide '
          'WHERE "DateTime" IS NOT NULL')
def q_time_range_split(spark, sf_dir):
    return cleaning.time_range_split(wide(spark, sf_dir), VAL_START, TEST_START).select(
        "row_ord", "DateTime", "split")


@register("split_xy", sql="SELECT * FROM wide")
def q_split_xy(spark, sf_dir):
    x, y = cleaning.split_xy(wide(spark, sf_dir))
    return cleaning.combine_xy(x, y)


_TARGET_SCHEMA = ["row_ord", "product", "product_category", "campaign_id", "webpage_id",
                  "is_click", "historical_click"]


@register("align_schema", sql="""SELECT row_ord, product, 0 AS product_category, campaign_id, webpage_id,
  is_click, 0 AS historical_click FROM wide""")
def q_align_schema(spark, sf_dir):
    return cleaning.align_schema(wide(spark, sf_dir), _TARGET_SCHEMA)


_LEFT_COLS = ["row_ord"] + TRAIN_COLS


@register("schema_diff", sql=f"""SELECT c.column_name, c.in_left, c.in_right, c.duplicated,
  (SELECT count(*) FROM ({SENT_SQL}) WHERE {_not_null_all(TRAIN_COLS)}) AS left_rows,
  (SELECT count(*) FROM wide) AS right_rows,
  (SELECT count(*) FROM ({SENT_SQL}) WHERE {_not_null_all(TRAIN_COLS)}) = (SELECT count(*) FROM wide)
    AS lengths_match
  FROM (VALUES {", ".join(f"('{c}', true, {str(c in ['row_ord', 'session_id', 'DateTime', 'user_id', 'product', 'campaign_id', 'webpage_id', 'product_category_1', 'user_group_id', 'gender', 'age_level', 'user_depth', 'var_1', 'is_click', 'score']).lower()}, false)" for c in _LEFT_COLS)},
     ('product_category_2', false, true, false), ('city_development_index', false, true, false))
     c(column_name, in_left, in_right, duplicated)""")
def q_schema_diff(spark, sf_dir):
    return cleaning.schema_diff(cleaning.clean_train(wide(spark, sf_dir)), wide(spark, sf_dir))


# -- scalar functions --------------------------------------------------------------

@register("fn_date_parts", sql="""SELECT row_ord, CAST("DateTime" AS DATE) AS session_date,
  CAST(hour("DateTime") AS INTEGER) AS hour, CAST(minute("DateTime") AS INTEGER) AS minute,
  CAST(isodow("DateTime") - 1 AS INTEGER) AS day_of_week FROM wide""")
def q_fn_date_parts(spark, sf_dir):
    return wide(spark, sf_dir).select("row_ord", S.session_date().alias("session_date"),
                                      S.hour().alias("hour"), S.minute().alias("minute"),
                                      S.day_of_week().alias("day_of_week"))


@register("fn_cyclic_hour", sql="""SELECT row_ord, sin(hour("DateTime") * (2 * pi() / 24)) AS hour_sin,
  cos(hour("DateTime") * (2 * pi() / 24)) AS hour_cos FROM wide""")
def q_fn_cyclic_hour(spark, sf_dir):
    s, c = S.cyclic_hour()
    return wide(spark, sf_dir).select("row_ord", s.alias("hour_sin"), c.alias("hour_cos"))


@register("fn_epoch", sql='SELECT row_ord, epoch_us("DateTime") / 1000000.0 AS epoch FROM wide')
def q_fn_epoch(spark, sf_dir):
    return wide(spark, sf_dir).select("row_ord", S.epoch_seconds().alias("epoch"))


@register("fn_clip", sql="""SELECT row_ord,
  CASE WHEN product_category_2 IS NULL THEN NULL ELSE LEAST(product_category_2, 2) END AS pc2_clipped,
  LEAST(campaign_id, 4) AS campaign_clipped FROM wide""")
def q_fn_clip(spark, sf_dir):
    return wide(spark, sf_dir).select("row_ord", S.clip_upper("product_category_2", 2).alias("pc2_clipped"),
                                      S.clip_upper("campaign_id", 4).alias("campaign_clipped"))


@register("fn_ceil_round", sql="""SELECT row_ord, CAST(ceil(score * 3) AS BIGINT) AS score_ceil,
  round_even(CAST(campaign_id AS DOUBLE) / 4.0, 0) AS campaign_bround FROM wide""")
def q_fn_ceil_round(spark, sf_dir):
    return wide(spark, sf_dir).select(
        "row_ord", S.ceil(F.col("score") * 3).alias("score_ceil"),
        S.round_half_even(F.col("campaign_id") / F.lit(4.0)).cast("double").alias("campaign_bround"))


@register("fn_select_case", sql="""SELECT row_ord, CASE WHEN hour("DateTime") >= 8 AND hour("DateTime") < 13 THEN 'Morning'
      WHEN hour("DateTime") >= 13 AND hour("DateTime") < 18 THEN 'Afternoon'
      WHEN hour("DateTime") >= 18 AND hour("DateTime") < 21 THEN 'Evening'
      WHEN hour("DateTime") >= 21 OR hour("DateTime") < 1 THEN 'Night'
      WHEN hour("DateTime") >= 1 AND hour("DateTime") < 8 THEN 'Early Morning'
      ELSE 'Unknown' END AS time_of_day FROM wide""")
def q_fn_select_case(spark, sf_dir):
    return wide(spark, sf_dir).select("row_ord", S.time_of_day().alias("time_of_day"))


@register("fn_format_key", sql="""SELECT row_ord, CAST(user_id AS VARCHAR) || '_' || CAST(campaign_id AS VARCHAR)
  AS user_campaign_key FROM wide""")
def q_fn_format_key(spark, sf_dir):
    return wide(spark, sf_dir).select("row_ord", S.format_key("user_id", "campaign_id").alias("user_campaign_key"))


@register("fn_null_ops", sql="""SELECT row_ord, gender IS NULL AS gender_isna, gender IS NOT NULL AS gender_notna,
  COALESCE(gender, 'Unknown') AS gender_filled, NULLIF(age_level, 0) AS age_level_or_null FROM wide""")
def q_fn_null_ops(spark, sf_dir):
    return wide(spark, sf_dir).select(
        "row_ord", S.is_missing("gender").alias("gender_isna"), S.is_present("gender").alias("gender_notna"),
        S.fill_null("gender", "Unknown").alias("gender_filled"),
        S.null_if("age_level", 0).alias("age_level_or_null"))
