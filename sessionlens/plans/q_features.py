"""Queries for the feature rows (75-111)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlens.operators import cleaning, features
from sessionlens.plans.registry import register, wide

# Feature input: the inference-cleaned wide view (flags added, sparse
# columns dropped), product_category_1 read as product_category.
BASE_SQL = """
base AS (
  SELECT row_ord, session_id, "DateTime", user_id, product, campaign_id, webpage_id,
         product_category_1 AS product_category, user_group_id, gender, age_level,
         user_depth, var_1, is_click, score,
         product_category_2 IS NOT NULL AS secondary_product_category_known,
         city_development_index IS NOT NULL AS city_development_index_known,
         CAST("DateTime" AS DATE) AS d
  FROM wide),
r AS (
  SELECT *,
    count(*) OVER (PARTITION BY user_id, d) AS n_ud,
    count(webpage_id) OVER (PARTITION BY user_id, d) AS web_ud,
    count(*) OVER (PARTITION BY user_id, "DateTime") AS n_ut,
    count(DISTINCT product) OVER (PARTITION BY user_id, "DateTime") AS nu_prod_ut,
    count(DISTINCT webpage_id) OVER (PARTITION BY user_id, "DateTime") AS nu_web_ut,
    count(DISTINCT secondary_product_category_known) OVER (PARTITION BY user_id, "DateTime") AS nu_spck_ut,
    count(DISTINCT city_development_index_known) OVER (PARTITION BY user_id, "DateTime") AS nu_cdik_ut,
    count(DISTINCT var_1) OVER (PARTITION BY user_id, "DateTime") AS nu_var_ut,
    CASE WHEN product IS NULL THEN 0 WHEN row_number() OVER (PARTITION BY user_id, product
         ORDER BY "DateTime" NULLS LAST, row_ord) > 1 THEN 1 ELSE 0 END AS has_viewed_product_before,
    CASE WHEN product_category IS NULL THEN 0 WHEN row_number() OVER (PARTITION BY user_id, product_category
         ORDER BY "DateTime" NULLS LAST, row_ord) > 1 THEN 1 ELSE 0 END AS has_viewed_category_before,
    CASE WHEN campaign_id IS NULL THEN 0 WHEN row_number() OVER (PARTITION BY user_id, campaign_id
         ORDER BY "DateTime" NULLS LAST, row_ord) > 1 THEN 1 ELSE 0 END AS has_viewed_campaign_before,
    COALESCE(CAST(lag(product) OVER (PARTITION BY user_id ORDER BY "DateTime" NULLS LAST, row_ord)
         = product AS INTEGER), 0) AS prev_session_same_product,
    CASE WHEN epoch_us("DateTime") - lag(epoch_us("DateTime")) OVER (PARTITION BY user_id ORDER BY row_ord)
         < 300000000 THEN 1 ELSE 0 END AS short_gap,
    count(DISTINCT product) OVER (PARTITION BY user_id) AS nu_prod,
    count(DISTINCT product_category) OVER (PARTITION BY user_id) AS nu_cat,
    count(DISTINCT campaign_id) OVER (PARTITION BY user_id) AS nu_camp,
    count(DISTINCT webpage_id) OVER (PARTITION BY user_id) AS nu_web,
    sum(CASE WHEN (hour("DateTime") > 1 AND hour("DateTime") < 6)
              OR (hour("DateTime") = 6 AND minute("DateTime") <= 30) THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id) AS early,
    count(DISTINCT city_development_index_known) OVER (PARTITION BY user_id) AS nu_cdik,
    count(DISTINCT secondary_product_category_known) OVER (PARTITION BY user_id) AS nu_spck,
    count(DISTINCT var_1) OVER (PARTITION BY user_id) AS nu_var,
    count(DISTINCT d) OVER (PARTITION BY user_id) AS days,
    row_number() OVER (PARTITION BY user_id, d ORDER BY row_ord) AS seq_ud
  FROM base),
r2 AS (
  SELECT *,
    quantile_cont(n_ud, 0.95) OVER (PARTITION BY d) AS thr95,
    sum(short_gap) OVER (PARTITION BY user_id) AS gaps
  FROM r),
ud AS (
  SELECT user_id, d, count(DISTINCT product) AS np, count(DISTINCT campaign_id) AS nc,
         count(DISTINCT webpage_id) AS nw, count(DISTINCT hour("DateTime")) AS nh
  FROM base GROUP BY user_id, d),
uu AS (
  SELECT user_id, ceil(avg(np)) AS div_prod, ceil(avg(nc)) AS div_camp, ceil(avg(nw)) AS div_web,
         max(nh) AS max_hours
  FROM ud WHERE d IS NOT NULL GROUP BY user_id),
ident AS (
  SELECT user_id, max(n) AS max_ident FROM (
    SELECT user_id, product, campaign_id, webpage_id, count(*) AS n FROM base
    WHERE product IS NOT NULL AND campaign_id IS NOT NULL AND webpage_id IS NOT NULL
    GROUP BY user_id, product, campaign_id, webpage_id) GROUP BY user_id),
umax AS (
  SELECT user_id, max(n) AS max_ut FROM (
    SELECT user_id, "DateTime", count(*) AS n FROM base WHERE "DateTime" IS NOT NULL
    GROUP BY user_id, "DateTime") GROUP BY user_id),
thr99 AS (SELECT quantile_cont(max_ut, 0.99) AS t FROM umax),
tod AS (
  SELECT user_id, arg_min(lbl, struct_pack(k := -n, l := lbl)) AS most_common_time_of_day FROM (
    SELECT user_id, {tod} AS lbl, count(*) AS n FROM base GROUP BY ALL) GROUP BY user_id),
feats AS (
  SELECT r2.row_ord, r2.is_click,
    product, product_category, campaign_id, webpage_id, user_group_id, gender, var_1, user_depth,
    age_level, secondary_product_category_known, city_development_index_known,
    LEAST(n_ud, 10) AS daily_sessions_count,
    has_viewed_product_before, has_viewed_category_before, has_viewed_campaign_before,
    LEAST(web_ud, 10) AS daily_webpage_count,
    prev_session_same_product,
    {tod} AS session_time_of_day,
    LEAST(umax.max_ut - 1, 10) AS duplicate_timestamp_session_count,
    LEAST(nu_prod_ut, 5) AS product_diversity_same_timestamp,
    LEAST(nu_web_ut, 5) AS webpage_diversity_same_timestamp,
    CASE WHEN nu_spck_ut > 1 THEN 1 ELSE 0 END AS session_mixed_secondary_product_category_known,
    CASE WHEN nu_cdik_ut > 1 THEN 1 ELSE 0 END AS session_mixed_city_development_index_known,
    CASE WHEN nu_var_ut > 1 THEN 1 ELSE 0 END AS session_mixed_var1,
    CASE WHEN n_ud >= thr95 THEN 1 ELSE 0 END AS is_high_volume_user,
    LEAST(nu_prod, 4) AS distinct_products_count,
    LEAST(nu_cat, 4) AS distinct_categories_count,
    LEAST(nu_camp, 4) AS distinct_campaigns_count,
    LEAST(nu_web, 4) AS distinct_webpages_count,
    isodow("DateTime") - 1 AS session_day_of_week,
    days AS total_active_days,
    LEAST(COALESCE(gaps, 0), 5) AS sessions_with_min_gap_count,
    CASE WHEN umax.max_ut >= thr99.t THEN 1 ELSE 0 END AS excess_duplicate_timestamps,
    LEAST(early, 4) AS early_morning_sessions_count,
    LEAST(div_prod, 5) AS user_product_diversity,
    LEAST(div_camp, 5) AS user_campaign_diversity,
    LEAST(div_web, 5) AS user_webpage_diversity,
    LEAST(n_ut, 6) AS same_timestamp_session_count,
    COALESCE(max_hours, 0) AS max_daily_user_activity_spread,
    COALESCE(LEAST(umax.max_ut, 6), 0) AS max_same_timestamp_session_count,
    COALESCE(LEAST(max_ident, 6), 0) AS many_identical_sessions,
    CASE WHEN nu_cdik > 1 THEN 1 ELSE 0 END AS mixed_city_development_index_known,
    CASE WHEN nu_spck > 1 THEN 1 ELSE 0 END AS mixed_product_category_2_known,
    CASE WHEN nu_var = 1 THEN 1 ELSE 0 END AS user_uniform_var1,
    LEAST(seq_ud, 7) AS daily_session_sequence,
    tod.most_common_time_of_day
  FROM r2 LEFT JOIN uu USING (user_id) LEFT JOIN ident USING (user_id)
       LEFT JOIN umax USING (user_id) LEFT JOIN tod USING (user_id) CROSS JOIN thr99)
""".replace("{tod}", """CASE WHEN hour("DateTime") >= 8 AND hour("DateTime") < 13 THEN 'Morning'
      WHEN hour("DateTime") >= 13 AND hour("DateTime") < 18 THEN 'Afternoon'
      WHEN hour("DateTime") >= 18 AND hour("DateTime") < 21 THEN 'Evening'
      WHEN hour("DateTime") >= 21 OR hour("DateTime") < 1 THEN 'Night'
      WHEN hour("DateTime") >= 1 AND hour("DateTime") < 8 THEN 'Early Morning'
      ELSE 'Unknown' END""")


def _cast_sql(name: str) -> str:
    f = features.BY_NAME.get(name)
    typ = "VARCHAR" if (f and f.categorical) or name == "most_common_time_of_day" else "INTEGER"
    return f"CAST({name} AS {typ}) AS {name}"


def feature_sql(names, with_target: bool = False) -> str:
    cols = ["row_ord"] + [_cast_sql(n) for n in names]
    if with_target:
        cols.append("is_click")
    return f", {BASE_SQL}\nSELECT {', '.join(cols)} FROM feats"


def feature_input(spark, sf_dir):
    return cleaning.clean_inference(wide(spark, sf_dir))


def _register_feature(name: str):
    sql = feature_sql([name])
    key = name

    def build(spark, sf_dir):
        d = feature_input(spark, sf_dir)
        if name == "most_common_time_of_day":
            return features.most_common_time_of_day(features._prep(d))
        return features.compute_features(d, [name]).drop("is_click")

    # the body starts with ", base AS (...)", continuing the WITH list that
    # ``register`` opens with the two session views
    register(key, sql=sql)(build)


_ENGINEERED = [f.name for f in features.FEATURES[11:]]
for _n in _ENGINEERED + ["has_viewed_product_before", "daily_session_sequence",
                         "most_common_time_of_day"]:
    _register_feature(_n)


@register("original_features", sql=feature_sql(features.ORIGINAL_FEATURES))
def q_original_features(spark, sf_dir):
    return features.compute_features(feature_input(spark, sf_dir),
                                     features.ORIGINAL_FEATURES).drop("is_click")


@register("prepare_features", sql=feature_sql(features.FEATURE_NAMES, with_target=True))
def q_prepare_features(spark, sf_dir):
    return features.prepare_features(feature_input(spark, sf_dir))


_NUM, _CAT = features.threshold_features()


@register("threshold_features", sql=feature_sql(_NUM + _CAT))
def q_threshold_features(spark, sf_dir):
    return features.compute_features(feature_input(spark, sf_dir), _NUM + _CAT).drop("is_click")


@register("cast_features", sql=feature_sql(features.FEATURE_NAMES, with_target=True))
def q_cast_features(spark, sf_dir):
    # the registry cast (string / int, target int) is the last step of 110
    df = features.prepare_features(feature_input(spark, sf_dir))
    return df.select(*[F.col(c) for c in df.columns])
