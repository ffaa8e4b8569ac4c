"""Queries for imputation (rows 33-40, 74).

The fixture has no missing ids or times, so the queries that need them
derive gaps from the data itself: an id or time is treated as missing in
the rows where ``gender`` (or ``city_development_index``) is missing. All
rows are kept.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlens.operators import cleaning, impute
from sessionlens.plans.registry import register, wide

INFER_SQL = ("SELECT * EXCLUDE (product_category_2, city_development_index), "
             "product_category_2 IS NOT NULL AS secondary_product_category_known, "
             "city_development_index IS NOT NULL AS city_development_index_known FROM wide")
BASE_SQL = f"SELECT * REPLACE (NULLIF(age_level, 0) AS age_level) FROM ({INFER_SQL})"
IMPUTE_COLS = ["DateTime", "product", "campaign_id", "webpage_id", "product_category_1", "user_group_id",
               "gender", "age_level", "user_depth", "var_1", "score", "secondary_product_category_known",
               "city_development_index_known"]


def _q(c):
    return f'"{c}"'


def _mode_sql(c, src="base"):
    return (f"(SELECT v FROM (SELECT {_q(c)} AS v, count(*) AS n FROM {src} WHERE {_q(c)} IS NOT NULL "
            f"GROUP BY {_q(c)} ORDER BY n DESC, v LIMIT 1))")


def base(spark, sf_dir):
    return cleaning.null_sentinel(cleaning.clean_inference(wide(spark, sf_dir)))


def with_missing_ids(df):
    """Ids missing where gender / city index are missing (derived gaps)."""
    return (df.withColumn("user_id", F.when(F.col("gender").isNotNull(), F.col("user_id")))
              .withColumn("session_id", F.when(F.col("city_development_index_known"), F.col("session_id"))))


MISSING_IDS_SQL = (f"SELECT * REPLACE (CASE WHEN gender IS NOT NULL THEN user_id END AS user_id, "
                   f"CASE WHEN city_development_index_known THEN session_id END AS session_id) FROM ({BASE_SQL})")


@register("impute_mode", sql=f", base AS ({BASE_SQL}) SELECT row_ord, session_id, user_id, is_click, "
          + ", ".join(f"COALESCE({_q(c)}, {_mode_sql(c)}) AS {_q(c)}" for c in IMPUTE_COLS) + " FROM base")
def q_impute_mode(spark, sf_dir):
    b = base(spark, sf_dir)
    return impute.ModeImputer().fit(b).transform(b)


def _new_ids_sql(col):
    return (f", m AS ({MISSING_IDS_SQL}) SELECT row_ord, COALESCE({col}, (SELECT max({col}) FROM m) + "
            f"row_number() OVER (PARTITION BY {col} IS NULL ORDER BY row_ord)) AS {col} FROM m")


@register("impute_user_id", sql=_new_ids_sql("user_id"))
def q_impute_user_id(spark, sf_dir):
    return impute.impute_user_id(with_missing_ids(base(spark, sf_dir))).select("row_ord", "user_id")


@register("impute_session_id", sql=_new_ids_sql("session_id"))
def q_impute_session_id(spark, sf_dir):
    return impute.impute_session_id(with_missing_ids(base(spark, sf_dir))).select("row_ord", "session_id")


_MONITORED = ["user_id", "session_id"] + IMPUTE_COLS


@register("imputed_count", sql=f""", m AS ({MISSING_IDS_SQL})
  SELECT nb AS nulls_before, CAST(0 AS BIGINT) AS nulls_after, nb AS imputed_count FROM (
    SELECT CAST({" + ".join(f"count(*) - count({_q(c)})" for c in _MONITORED)} AS BIGINT) AS nb FROM m)""")
def q_imputed_count(spark, sf_dir):
    before = with_missing_ids(base(spark, sf_dir))
    after = impute.impute_session_id(impute.impute_user_id(before))
    after = impute.ModeImputer().fit(before).transform(after)
    return impute.imputed_count(before, after, _MONITORED)


GAPPY_TIME_SQL = 'SELECT row_ord, CASE WHEN gender IS NOT NULL THEN "DateTime" END AS "DateTime" FROM wide'


def gappy_time(spark, sf_dir):
    w = wide(spark, sf_dir)
    return w.select("row_ord", F.when(F.col("gender").isNotNull(), F.col("DateTime")).alias("DateTime"))


@register("ffill_bfill", sql=f""", g AS ({GAPPY_TIME_SQL}),
  f AS (SELECT row_ord, last_value("DateTime" IGNORE NULLS) OVER (ORDER BY row_ord
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "DateTime" FROM g)
  SELECT row_ord, COALESCE("DateTime", first_value("DateTime" IGNORE NULLS) OVER (ORDER BY row_ord
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS "DateTime" FROM f""")
def q_ffill_bfill(spark, sf_dir):
    return impute.ffill_bfill(gappy_time(spark, sf_dir), "DateTime")


@register("fill_constant", sql="""SELECT * REPLACE (COALESCE(product_category_2, 0) AS product_category_2,
  COALESCE(city_development_index, 0) AS city_development_index) FROM wide""")
def q_fill_constant(spark, sf_dir):
    return impute.fill_constant(wide(spark, sf_dir), ["product_category_2", "city_development_index"], 0)


_MODE_FILLED = ["session_id", "DateTime", "user_id", "product", "campaign_id", "webpage_id", "product_category_1",
                "product_category_2", "user_group_id", "gender", "age_level", "user_depth", "var_1", "is_click", "score"]


@register("fill_median_mode", sql=f"""SELECT * REPLACE (
  COALESCE(CAST(city_development_index AS DOUBLE), (SELECT median(CAST(city_development_index AS DOUBLE)) FROM wide))
    AS city_development_index,
  {", ".join(f"COALESCE({_q(c)}, {_mode_sql(c, 'wide')}) AS {_q(c)}" for c in _MODE_FILLED)}) FROM wide""")
def q_fill_median_mode(spark, sf_dir):
    return impute.fill_median_mode(wide(spark, sf_dir), ["city_development_index"], _MODE_FILLED)


_WITHIN = ["gender", "city_development_index"]
_ALL = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


@register("impute_within_user", sql="SELECT row_ord, " + ", ".join(
    f"COALESCE({c}, first_value({c} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY row_ord {_ALL})) AS {c}"
    for c in _WITHIN) + " FROM wide")
def q_impute_within_user(spark, sf_dir):
    return impute.impute_within_user(wide(spark, sf_dir), _WITHIN).select("row_ord", *_WITHIN)


@register("impute_within_user_counts", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST(count(*) FILTER (WHERE nn > 0 AND nn < n) AS BIGINT) AS n_imputed
        FROM (SELECT user_id, count({c}) AS nn, count(*) AS n FROM wide GROUP BY user_id)""" for c in _WITHIN))
def q_impute_within_user_counts(spark, sf_dir):
    return impute.imputed_users(wide(spark, sf_dir), _WITHIN)


@register("missing_after_impute", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, (SELECT (count(*) - count({c})) * 100.0 / count(*) FROM wide) AS pct_missing_before,
        (SELECT count(*) FILTER (WHERE v IS NULL) * 100.0 / count(*) FROM (SELECT COALESCE({c},
          first_value({c} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY row_ord {_ALL})) AS v FROM wide))
          AS pct_missing_after""" for c in _WITHIN))
def q_missing_after_impute(spark, sf_dir):
    w = wide(spark, sf_dir)
    return impute.missing_share_after_impute(w, impute.impute_within_user(w, _WITHIN), _WITHIN)
