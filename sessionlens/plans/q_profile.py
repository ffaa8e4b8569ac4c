"""Queries for aggregations, profiles and outcomes (rows 30, 52-73, 128)."""

from __future__ import annotations

from sessionlens.operators import cleaning, profile, sketches
from sessionlens.plans.registry import narrow, register, wide

DEMOGRAPHICS = ["gender", "age_level", "user_group_id", "user_depth", "city_development_index"]

# -- minimum slice: combined category -> CTR by (category, campaign) -> top 10 ----

COMB_SQL = """
comb AS (
  SELECT *, NULLIF(CAST(COALESCE(product_category_1, 0) AS VARCHAR) || '_' ||
                   CAST(COALESCE(product_category_2, 0) AS VARCHAR), '0_0') AS product_cat_comb
  FROM wide),
grp AS (
  SELECT product_cat_comb, campaign_id, avg(is_click) AS click_rate,
         count(is_click) AS sessions_number
  FROM comb WHERE is_click IS NOT NULL AND product_cat_comb IS NOT NULL AND campaign_id IS NOT NULL
  GROUP BY product_cat_comb, campaign_id HAVING count(is_click) >= 50)
"""


def _comb(spark, sf_dir):
    return cleaning.combine_categories(wide(spark, sf_dir))


@register("combine_categories", sql=f", {COMB_SQL} SELECT row_ord, product_cat_comb FROM comb")
def q_combine_categories(spark, sf_dir):
    return _comb(spark, sf_dir).select("row_ord", "product_cat_comb")


@register("outcome_by_group", sql=f", {COMB_SQL} SELECT * FROM grp")
def q_outcome_by_group(spark, sf_dir):
    return profile.outcome_by_group(_comb(spark, sf_dir), ["product_cat_comb", "campaign_id"],
                                    "click_rate", min_sessions=50)


@register("top10_pairs", sql=f", {COMB_SQL} SELECT * FROM grp "
          "ORDER BY click_rate DESC, product_cat_comb, campaign_id LIMIT 10")
def q_top10_pairs(spark, sf_dir):
    g = profile.outcome_by_group(_comb(spark, sf_dir), ["product_cat_comb", "campaign_id"],
                                 "click_rate", min_sessions=50)
    return profile.top_groups(g, "click_rate", 10, ("product_cat_comb", "campaign_id"))


# -- users and behaviour groups ----------------------------------------------------

@register("user_stats", sql="""SELECT user_id, count(DISTINCT session_id) AS sessions,
  CAST(sum(is_click) AS BIGINT) AS clicks FROM narrow GROUP BY user_id""")
def q_user_stats(spark, sf_dir):
    return profile.user_stats(narrow(spark, sf_dir))


@register("behavior_groups", sql="""SELECT label, count(*) AS n_users FROM (
  SELECT user_id, CAST(count(DISTINCT session_id) AS VARCHAR) || '_sessions_' ||
         CAST(sum(is_click) AS VARCHAR) || '_clicks' AS label FROM narrow GROUP BY user_id)
  GROUP BY label""")
def q_behavior_groups(spark, sf_dir):
    return profile.behavior_group_sizes(narrow(spark, sf_dir))


# -- missing data ---------------------------------------------------------------------

_ALL_COLS = ["session_id", "DateTime", "user_id", "product", "campaign_id", "webpage_id",
             "product_category_1", "product_category_2", "user_group_id", "gender", "age_level",
             "user_depth", "city_development_index", "var_1", "is_click", "score"]


def _q(c):
    return f'"{c}"'


@register("missing_counts", sql="SELECT column_name, n_missing, n_missing * 100.0 / n AS pct_missing FROM ("
          + " UNION ALL ".join(
              f"SELECT '{c}' AS column_name, CAST(count(*) - count({_q(c)}) AS BIGINT) AS n_missing, "
              f"count(*) AS n FROM wide" for c in _ALL_COLS) + ")")
def q_missing_counts(spark, sf_dir):
    return profile.missing_counts(wide(spark, sf_dir).drop("row_ord"))


@register("missing_by_user", sql="SELECT user_id, " + ", ".join(
    f"avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {c}" for c in DEMOGRAPHICS)
    + " FROM wide GROUP BY user_id")
def q_missing_by_user(spark, sf_dir):
    return profile.missing_by_user(wide(spark, sf_dir), DEMOGRAPHICS)


def _cat_sql(expr):
    return (f"CASE WHEN {expr} = 0 THEN 'complete' WHEN {expr} > 0 AND {expr} < 1 THEN 'partial' "
            f"WHEN {expr} = 1 THEN 'absent' ELSE 'other' END")


_RATES = ("SELECT user_id, " + ", ".join(
    f"avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {c}" for c in DEMOGRAPHICS)
    + " FROM wide GROUP BY user_id")


@register("missing_category", sql=f"SELECT user_id, "
          + ", ".join(f"{_cat_sql(c)} AS {c}" for c in DEMOGRAPHICS) + f" FROM ({_RATES})")
def q_missing_category(spark, sf_dir):
    return profile.missing_category(wide(spark, sf_dir), DEMOGRAPHICS)


@register("category_counts", sql=f"""
  , cats AS (SELECT user_id, {", ".join(f"{_cat_sql(c)} AS {c}" for c in DEMOGRAPHICS)} FROM ({_RATES})),
  long AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS category FROM cats" for c in DEMOGRAPHICS)}),
  grid AS (SELECT f.feature, c.category FROM
           (VALUES {", ".join(f"('{c}')" for c in DEMOGRAPHICS)}) f(feature),
           (VALUES ('complete'), ('partial'), ('absent')) c(category))
  SELECT g.feature, g.category, CAST(count(l.feature) AS BIGINT) AS n_users
  FROM grid g LEFT JOIN long l ON g.feature = l.feature AND g.category = l.category
  GROUP BY g.feature, g.category""")
def q_category_counts(spark, sf_dir):
    return profile.category_counts(wide(spark, sf_dir), DEMOGRAPHICS)


_LEVEL_COLS = ["session_id", "DateTime", "user_id", "product", "campaign_id", "webpage_id", "product_category_1",
               "product_category_2", "user_group_id", "gender", "age_level", "user_depth", "city_development_index",
               "var_1", "is_click", "score"]


@register("column_levels", sql=" UNION ALL ".join(f"""
  SELECT '{c}' AS column_name, (SELECT count(DISTINCT "{c}") FROM wide) AS n_distinct,
    (SELECT array_to_string(list_transform(CASE WHEN count(*) <= 10 THEN list_sort(list(v))
            ELSE list_sort(list(v))[1:9] END, lambda x: CAST(x AS VARCHAR)), ',')
     FROM (SELECT DISTINCT "{c}" AS v FROM wide WHERE "{c}" IS NOT NULL)) AS levels,
    (SELECT count(*) - count("{c}") FROM wide) AS n_null""" for c in _LEVEL_COLS))
def q_column_levels(spark, sf_dir):
    return profile.column_levels(wide(spark, sf_dir), _LEVEL_COLS)


_NUMERIC_DESC = [c for c in _LEVEL_COLS if c not in ("DateTime", "product", "gender")]
_STRING_DESC = ["DateTime", "product", "gender"]


def _describe_sql(c, numeric):
    top = (f"(SELECT CAST(v AS VARCHAR) FROM (SELECT \"{c}\" AS v, count(*) AS n FROM wide WHERE \"{c}\" IS NOT NULL "
           f"GROUP BY \"{c}\" ORDER BY n DESC, v LIMIT 1))")
    freq = (f"(SELECT n FROM (SELECT \"{c}\" AS v, count(*) AS n FROM wide WHERE \"{c}\" IS NOT NULL "
            f"GROUP BY \"{c}\" ORDER BY n DESC, v LIMIT 1))")
    if numeric:
        x = f"CAST({c} AS DOUBLE)"
        stats = (f"avg({x}) AS mean, stddev_samp({x}) AS std, min({x}) AS min, "
                 f"quantile_cont({x}, 0.25) AS q25, quantile_cont({x}, 0.5) AS q50, "
                 f"quantile_cont({x}, 0.75) AS q75, max({x}) AS max")
    else:
        stats = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    return (f"SELECT '{c}' AS column_name, count(\"{c}\") AS count, count(DISTINCT \"{c}\") AS \"unique\", {stats}, "
            f"{top} AS top, {freq} AS freq FROM wide")


@register("describe_all", sql=" UNION ALL ".join(
    [_describe_sql(c, True) for c in _NUMERIC_DESC] + [_describe_sql(c, False) for c in _STRING_DESC]))
def q_describe_all(spark, sf_dir):
    return profile.describe_all(wide(spark, sf_dir), _NUMERIC_DESC + _STRING_DESC)


@register("value_counts", sql="""SELECT product, count(*) AS count,
  count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
  FROM wide WHERE product IS NOT NULL GROUP BY product""")
def q_value_counts(spark, sf_dir):
    return profile.value_counts(wide(spark, sf_dir), "product")


@register("log_frequency", sql="""SELECT clicks, count(*) AS n_users, log10(count(*)) AS log10_users
  FROM (SELECT user_id, CAST(sum(is_click) AS BIGINT) AS clicks FROM narrow GROUP BY user_id)
  GROUP BY clicks""")
def q_log_frequency(spark, sf_dir):
    return profile.log_frequency(narrow(spark, sf_dir))


_LEVEL_FEATURES = ["product", "campaign_id", "gender", "age_level"]


@register("users_per_level", sql=" UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS level, count(DISTINCT user_id) AS n_users "
    f"FROM narrow WHERE {f} IS NOT NULL GROUP BY {f}" for f in _LEVEL_FEATURES))
def q_users_per_level(spark, sf_dir):
    return profile.users_per_level(narrow(spark, sf_dir), _LEVEL_FEATURES)


@register("users_per_level_sketch", sql=" UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS level, count(DISTINCT user_id) AS n_users, true AS within "
    f"FROM narrow WHERE {f} IS NOT NULL GROUP BY {f}" for f in _LEVEL_FEATURES))
def q_users_per_level_sketch(spark, sf_dir):
    """Exact users per level, and whether the union of the days' sketches
    keeps to its error bound."""
    d = narrow(spark, sf_dir)
    estimated = sketches.distinct(
        sketches.merged(sketches.level_sketches(d, _LEVEL_FEATURES), "feature", "level"), "estimate")
    exact = profile.users_per_level(d, _LEVEL_FEATURES)
    return exact.join(estimated, ["feature", "level"], "left").select(
        "feature", "level", "n_users", sketches.within("estimate", "n_users").alias("within"))


@register("column_levels_sketch", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT \"{c}\") AS n_distinct, true AS within FROM wide" for c in _LEVEL_COLS))
def q_column_levels_sketch(spark, sf_dir):
    """Exact distinct values per column, and whether the union of the days'
    sketches keeps to its error bound."""
    d = wide(spark, sf_dir)
    estimated = sketches.distinct(sketches.merged(sketches.column_sketches(d, _LEVEL_COLS), "column_name"), "estimate")
    exact = profile.column_levels(d, _LEVEL_COLS).select("column_name", "n_distinct")
    return exact.join(estimated, "column_name", "left").select(
        "column_name", "n_distinct", sketches.within("estimate", "n_distinct").alias("within"))


_USER_OUT = """SELECT user_id, count(session_id) AS sessions_num, avg(is_click) AS click_rate,
  CAST(sum(is_click) AS BIGINT) AS click_num, CASE WHEN avg(is_click) > 0 THEN 1 ELSE 0 END AS any_click
  FROM narrow GROUP BY user_id"""


@register("user_outcomes", sql=_USER_OUT)
def q_user_outcomes(spark, sf_dir):
    return profile.user_outcomes(narrow(spark, sf_dir))


@register("user_outcome_join", sql="""SELECT user_id, count(session_id) AS sessions_num,
  avg(is_click) AS click_rate FROM narrow GROUP BY user_id""")
def q_user_outcome_join(spark, sf_dir):
    return profile.user_outcomes(narrow(spark, sf_dir)).select("user_id", "sessions_num", "click_rate")


@register("feature_user_join", sql=f"""
  , fv AS (SELECT user_id, arg_min(gender, row_ord) AS gender FROM narrow WHERE gender IS NOT NULL
           GROUP BY user_id),
  uo AS ({_USER_OUT})
  SELECT fv.user_id, fv.gender, uo.sessions_num, uo.click_rate, uo.click_num, uo.any_click AS clickers_rate
  FROM fv JOIN uo ON fv.user_id = uo.user_id""")
def q_feature_user_join(spark, sf_dir):
    return profile.feature_user_outcomes(narrow(spark, sf_dir), "gender")


@register("outcome_pivot", sql=f""", {COMB_SQL.replace("HAVING count(is_click) >= 50", "")}
  SELECT product_cat_comb, {", ".join(f'COALESCE(first(click_rate) FILTER (WHERE campaign_id = {i}), 0) AS "{i}"' for i in range(10))}
  FROM grp GROUP BY product_cat_comb""")
def q_outcome_pivot(spark, sf_dir):
    return profile.outcome_pivot(_comb(spark, sf_dir), "product_cat_comb", "campaign_id")


_BATCH_FEATURES = ["product_category_1", "product_category_2", "product_cat_comb"]


_COMB_ONLY = f", {COMB_SQL.split('grp AS')[0].rstrip().rstrip(',')} "
_BATCH_SQL = " UNION ALL ".join(
    f"""SELECT '{o}' AS outcome, '{f}' AS feature, CAST({f} AS VARCHAR) AS level, campaign_id,
        CAST({ {'click_rate': 'avg(is_click)', 'click_num': 'sum(is_click)', 'sessions_num': 'count(is_click)'}[o] } AS DOUBLE) AS value,
        count(is_click) AS sessions_number
      FROM comb WHERE is_click IS NOT NULL AND {f} IS NOT NULL AND campaign_id IS NOT NULL
      GROUP BY {f}, campaign_id HAVING count(is_click) >= 20"""
    for f in _BATCH_FEATURES for o in ("click_rate", "click_num", "sessions_num"))


def _batch(spark, sf_dir):
    return profile.outcome_batch(_comb(spark, sf_dir), _BATCH_FEATURES, min_sessions=20)


@register("outcome_batch", sql=_COMB_ONLY + _BATCH_SQL)
def q_outcome_batch(spark, sf_dir):
    return _batch(spark, sf_dir)


@register("outcome_batch_top", sql=_COMB_ONLY + f""", batch AS ({_BATCH_SQL})
  SELECT *, row_number() OVER (PARTITION BY outcome, feature ORDER BY value DESC, level, campaign_id) AS rank
  FROM batch QUALIFY rank <= 10""")
def q_outcome_batch_top(spark, sf_dir):
    return profile.outcome_batch_top(_batch(spark, sf_dir))


@register("outcome_batch_pivot", sql=_COMB_ONLY + f""", batch AS ({_BATCH_SQL})
  SELECT outcome, feature, level,
    {", ".join(f'coalesce(max(value) FILTER (WHERE campaign_id = {i}), 0) AS "{i}"' for i in range(10))}
  FROM batch GROUP BY outcome, feature, level""")
def q_outcome_batch_pivot(spark, sf_dir):
    return profile.outcome_batch_pivot(_batch(spark, sf_dir), values=list(range(10)))


@register("group_quantiles", sql=f""", {COMB_SQL.split('grp AS')[0].rstrip().rstrip(',')}
  , sizes AS (SELECT count(is_click) AS n FROM comb WHERE product_cat_comb IS NOT NULL
              AND campaign_id IS NOT NULL AND is_click IS NOT NULL GROUP BY product_cat_comb, campaign_id)
  SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95]::DOUBLE[]) AS quantile,
         unnest(quantile_cont(CAST(n AS DOUBLE), [0.05, 0.25, 0.5, 0.75, 0.95])) AS value FROM sizes""")
def q_group_quantiles(spark, sf_dir):
    return profile.group_quantiles(_comb(spark, sf_dir), ["product_cat_comb", "campaign_id"])


N_CLICKS = 3
_NCLICK_SQL = f"""
  , pu AS (SELECT user_id, sum(is_click) AS clicks FROM narrow
           WHERE user_id IS NOT NULL AND campaign_id IS NOT NULL AND is_click IS NOT NULL GROUP BY user_id),
  pairs AS (SELECT DISTINCT campaign_id, user_id FROM narrow
           WHERE user_id IS NOT NULL AND campaign_id IS NOT NULL AND is_click IS NOT NULL),
  nc AS (SELECT CAST(campaign_id AS VARCHAR) AS campaign_id, count(*) AS exposure,
    {", ".join(f"CASE WHEN count(*) FILTER (WHERE clicks > {n}) > 0 THEN count(*) FILTER (WHERE clicks > {n}) / CAST(count(*) AS DOUBLE) END AS rate_{n}" for n in range(N_CLICKS + 1))}
    FROM pairs JOIN pu USING (user_id) GROUP BY campaign_id)"""


@register("n_clickers_rate", sql=_NCLICK_SQL + " SELECT * FROM nc")
def q_n_clickers_rate(spark, sf_dir):
    return profile.n_clickers_rate(narrow(spark, sf_dir), N_CLICKS)


_RATE_COLS = [f"rate_{n}" for n in range(N_CLICKS + 1)]


@register("column_max_norm", sql=_NCLICK_SQL + " SELECT campaign_id, exposure, "
          + ", ".join(f"{c} * 100.0 / max({c} * 100.0) OVER () AS {c}" for c in _RATE_COLS) + " FROM nc")
def q_column_max_norm(spark, sf_dir):
    return profile.column_max_norm(profile.n_clickers_rate(narrow(spark, sf_dir), N_CLICKS), _RATE_COLS)


@register("category_by_product", sql="""SELECT product, count(DISTINCT product_category_1) AS n_categories,
  array_to_string(list_sort(list(DISTINCT CAST(product_category_1 AS VARCHAR))), ',') AS categories
  FROM wide GROUP BY product""")
def q_category_by_product(spark, sf_dir):
    return profile.category_by_product(wide(spark, sf_dir))


_CLEAN_COLS = ["session_id", "DateTime", "user_id", "product", "campaign_id", "webpage_id",
               "product_category_1", "user_group_id", "gender", "age_level", "user_depth", "var_1",
               "is_click", "score"]


@register("cleaning_loss", sql=f"""
  , b AS (SELECT * EXCLUDE (product_category_2, city_development_index) FROM wide),
  a AS (SELECT * FROM b WHERE {" AND ".join(f'{_q(c)} IS NOT NULL' for c in _CLEAN_COLS)})
  SELECT '__rows__' AS column_name, ((SELECT count(*) FROM b) - (SELECT count(*) FROM a)) * 100.0
         / (SELECT count(*) FROM b) AS pct_lost
  UNION ALL """ + " UNION ALL ".join(
    f"SELECT '{c}', ((SELECT count({_q(c)}) FROM b) - (SELECT count({_q(c)}) FROM a)) * 100.0 "
    f"/ (SELECT count({_q(c)}) FROM b)" for c in _CLEAN_COLS))
def q_cleaning_loss(spark, sf_dir):
    before = cleaning.drop_columns(wide(spark, sf_dir))
    return profile.cleaning_loss(before, cleaning.dropna_any(before), _CLEAN_COLS)


@register("missing_rows_ctr", sql=f"""SELECT ({" OR ".join(f'{_q(c)} IS NULL' for c in _CLEAN_COLS if c != 'is_click')}) AS has_missing,
  count(*) AS rows, CAST(sum(is_click) AS BIGINT) AS clicks, avg(is_click) AS ctr
  FROM (SELECT * EXCLUDE (product_category_2, city_development_index) FROM wide) GROUP BY 1""")
def q_missing_rows_ctr(spark, sf_dir):
    return profile.missing_rows_ctr(cleaning.drop_columns(wide(spark, sf_dir)), _CLEAN_COLS)


_DUP_KEYS = ["user_id", "DateTime", "product", "campaign_id"]


@register("duplicate_report", sql=f"""SELECT {", ".join(_q(c) for c in _DUP_KEYS)}, count(*) AS copies,
  count(*) - 1 AS surplus FROM wide GROUP BY ALL HAVING count(*) > 1""")
def q_duplicate_report(spark, sf_dir):
    return profile.duplicate_report(wide(spark, sf_dir), _DUP_KEYS)

