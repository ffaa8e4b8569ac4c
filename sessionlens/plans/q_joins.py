"""Queries for joins and as-of joins (rows 41-51) and history (112-119)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlens.operators import history, joins
from sessionlens.plans.q_impute import GAPPY_TIME_SQL, gappy_time
from sessionlens.plans.registry import narrow, register, wide

ORDER = 'ORDER BY "DateTime" NULLS LAST, row_ord'


@register("user_counts_join", sql="""SELECT row_ord,
  CAST(sum(is_click) OVER (PARTITION BY user_id) AS BIGINT) AS clicks_per_user,
  count(DISTINCT session_id) OVER (PARTITION BY user_id) AS sessions_per_user,
  CAST(sum(is_click) OVER (PARTITION BY session_id) AS BIGINT) AS clicks_per_session FROM narrow""")
def q_user_counts_join(spark, sf_dir):
    return joins.user_counts_join(narrow(spark, sf_dir)).select(
        "row_ord", "clicks_per_user", "sessions_per_user", "clicks_per_session")


_A_USERS = "SELECT DISTINCT user_id FROM narrow WHERE product = 'A'"


@register("semi_join_users", sql=f"SELECT * FROM narrow WHERE user_id IN ({_A_USERS})")
def q_semi_join_users(spark, sf_dir):
    n = narrow(spark, sf_dir)
    return joins.semi_join_users(n, joins.users_with_product(n))


@register("anti_join_users", sql=f"SELECT * FROM narrow WHERE user_id NOT IN ({_A_USERS})")
def q_anti_join_users(spark, sf_dir):
    n = narrow(spark, sf_dir)
    return joins.anti_join_users(n, joins.users_with_product(n))


@register("map_lookup", sql="SELECT row_ord, avg(is_click) OVER (PARTITION BY user_id) AS user_click_rate FROM narrow")
def q_map_lookup(spark, sf_dir):
    n = narrow(spark, sf_dir)
    rates = n.groupBy("user_id").agg(F.avg("is_click").alias("user_click_rate"))
    return joins.join_lookup(n, rates, "user_id").select("row_ord", "user_click_rate")


@register("outer_join_campaign", sql="""
  , d AS (SELECT * FROM narrow WHERE user_id IS NOT NULL AND campaign_id IS NOT NULL AND is_click IS NOT NULL),
  e AS (SELECT campaign_id, count(DISTINCT user_id) AS exposure FROM d GROUP BY campaign_id),
  c AS (SELECT campaign_id, count(DISTINCT user_id) AS clickers_num FROM d
        WHERE user_id IN (SELECT user_id FROM d GROUP BY user_id HAVING sum(is_click) > 0) GROUP BY campaign_id)
  SELECT COALESCE(e.campaign_id, c.campaign_id) AS campaign_id, exposure, clickers_num
  FROM e FULL OUTER JOIN c ON e.campaign_id = c.campaign_id""")
def q_outer_join_campaign(spark, sf_dir):
    return joins.outer_join_campaign(narrow(spark, sf_dir))


_HIST = (f'SELECT user_id, "DateTime", CAST(COALESCE(sum(is_click) OVER (PARTITION BY user_id {ORDER} '
         f'ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS historical_click FROM wide')


@register("history_merge", sql=f"""SELECT w.row_ord, w.user_id, w."DateTime", h.historical_click
  FROM wide w LEFT JOIN ({_HIST}) h ON w.user_id = h.user_id AND w."DateTime" = h."DateTime" """)
def q_history_merge(spark, sf_dir):
    w = wide(spark, sf_dir)
    return joins.history_merge(w, joins.historical_click_table(w)).select(
        "row_ord", "user_id", "DateTime", "historical_click")


@register("sessions_merge", sql=f"""SELECT w.row_ord, s.sessions FROM wide w LEFT JOIN (
  SELECT user_id, "DateTime", session_id, row_number() OVER (PARTITION BY user_id {ORDER}) - 1 AS sessions
  FROM wide) s ON w.user_id = s.user_id AND w."DateTime" = s."DateTime" AND w.session_id = s.session_id""")
def q_sessions_merge(spark, sf_dir):
    w = wide(spark, sf_dir)
    return joins.sessions_merge(w, joins.sessions_table(w)).select("row_ord", "sessions")


def _asof_sql(drop_last: bool):
    last = ""
    if drop_last:
        last = (' - COALESCE((SELECT arg_max(i.is_click, i.row_ord) FROM wide i '
                'WHERE i.user_id = e.user_id AND i."DateTime" = (SELECT max(j."DateTime") FROM wide j '
                'WHERE j.user_id = e.user_id AND j."DateTime" < e."DateTime")), 0)')
    return (f"""SELECT e.row_ord, CAST(COALESCE((SELECT sum(i.is_click) FROM wide i WHERE i.user_id = e.user_id
      AND i."DateTime" < e."DateTime"), 0){last} AS BIGINT) AS historical_click FROM wide e""")


@register("asof_clicks", sql=_asof_sql(False))
def q_asof_clicks(spark, sf_dir):
    w = wide(spark, sf_dir)
    return joins.asof_clicks(w, w).select("row_ord", "historical_click")


@register("asof_clicks_drop_last", sql=_asof_sql(True))
def q_asof_clicks_drop_last(spark, sf_dir):
    w = wide(spark, sf_dir)
    return joins.asof_clicks(w, w, drop_last=True).select("row_ord", "historical_click")


@register("asof_sessions", sql=f"""SELECT e.row_ord, CAST((SELECT count(*) FROM wide i WHERE i.user_id = e.user_id
  AND i."DateTime" < e."DateTime") + row_number() OVER (PARTITION BY e.user_id {ORDER.replace('"DateTime"', 'e."DateTime"').replace('row_ord', 'e.row_ord')}) - 1 AS BIGINT)
  AS sessions FROM wide e""")
def q_asof_sessions(spark, sf_dir):
    w = wide(spark, sf_dir)
    return joins.asof_sessions(w, w, with_rows=False)


# -- history ---------------------------------------------------------------------------

@register("historical_click", sql=f"""SELECT row_ord, CAST(COALESCE(sum(is_click) OVER (PARTITION BY user_id
  {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS historical_click FROM wide""")
def q_historical_click(spark, sf_dir):
    return history.historical_click(wide(spark, sf_dir), keep=["row_ord"])


@register("historical_sessions", sql=f"""SELECT row_ord, row_number() OVER (PARTITION BY user_id {ORDER}) - 1
  AS historical_sessions FROM wide""")
def q_historical_sessions(spark, sf_dir):
    return history.historical_sessions(wide(spark, sf_dir), keep=["row_ord"])


_PVB = f"""CASE WHEN product IS NULL THEN 0 WHEN row_number() OVER (PARTITION BY user_id, product {ORDER}) > 1
  THEN 1 ELSE 0 END"""


@register("product_viewed_before", sql=f"SELECT row_ord, {_PVB} AS product_viewed_before FROM wide")
def q_product_viewed_before(spark, sf_dir):
    return history.product_viewed_before(wide(spark, sf_dir)).select("row_ord", "product_viewed_before")


_GAP = f'(epoch_us("DateTime") - epoch_us(lag("DateTime") OVER (PARTITION BY user_id {ORDER}))) / 1e6'


@register("time_since_prev", sql=f"""SELECT row_ord, {_GAP} AS seconds_since_prev,
  {_GAP} / 3600.0 AS hours_since_prev FROM wide""")
def q_time_since_prev(spark, sf_dir):
    return history.time_since_prev(wide(spark, sf_dir), keep=["row_ord"])


@register("recent_session_ctr", sql=f"""
  , t AS (SELECT *, {_GAP} / 3600.0 AS h, count(*) OVER (PARTITION BY user_id) AS n FROM wide),
  f AS (SELECT *, CASE WHEN h <= 1.0 THEN 1 ELSE 0 END AS r FROM t WHERE n > 2 AND h IS NOT NULL)
  SELECT avg(is_click) FILTER (WHERE r = 1) AS ctr_with_recent, avg(is_click) FILTER (WHERE r = 0) AS ctr_without_recent,
    count(*) AS rows, (avg(is_click) FILTER (WHERE r = 1) - avg(is_click) FILTER (WHERE r = 0))
      / avg(is_click) FILTER (WHERE r = 0) AS relative_lift FROM f""")
def q_recent_session_ctr(spark, sf_dir):
    return history.recent_session_ctr(wide(spark, sf_dir))


@register("viewed_before_ctr", sql=f"""
  , v AS (SELECT is_click, {_PVB} AS p FROM wide)
  SELECT avg(is_click) AS overall_ctr, avg(is_click) FILTER (WHERE p = 1) AS ctr_viewed_before,
    avg(is_click) FILTER (WHERE p = 0) AS ctr_not_viewed_before,
    (avg(is_click) FILTER (WHERE p = 1) - avg(is_click)) / avg(is_click) AS relative_lift FROM v""")
def q_viewed_before_ctr(spark, sf_dir):
    return history.viewed_before_ctr(wide(spark, sf_dir))


@register("diff_prev_nonnull", sql=f"""
  , g AS ({GAPPY_TIME_SQL}),
  nn AS (SELECT row_ord, COALESCE(epoch_us("DateTime") / 1e6 - lag(epoch_us("DateTime") / 1e6) OVER (ORDER BY row_ord), 0)
         AS d FROM g WHERE "DateTime" IS NOT NULL)
  SELECT g.row_ord, g."DateTime", nn.d AS diff_prev_nonnull FROM g LEFT JOIN nn USING (row_ord)""")
def q_diff_prev_nonnull(spark, sf_dir):
    return history.diff_prev_nonnull(gappy_time(spark, sf_dir))


CONTEXT_M = 5


@register("null_context", sql=f"""
  , g AS (SELECT row_ord, epoch_us("DateTime") / 1e6 AS e FROM ({GAPPY_TIME_SQL})),
  c AS (SELECT row_ord, e, {", ".join(
      [f"lag(e, {k}) OVER (ORDER BY row_ord) AS ctx_{CONTEXT_M - k}" for k in range(CONTEXT_M, 0, -1)]
      + [f"e AS ctx_{CONTEXT_M}"]
      + [f"lead(e, {k}) OVER (ORDER BY row_ord) AS ctx_{CONTEXT_M + k}" for k in range(1, CONTEXT_M + 1)])} FROM g)
  SELECT row_ord, {", ".join(f"ctx_{i}" for i in range(2 * CONTEXT_M + 1))} FROM c WHERE e IS NULL""")
def q_null_context(spark, sf_dir):
    out = history.null_context(gappy_time(spark, sf_dir), m=CONTEXT_M)
    return out.select("row_ord", *[F.col("context")[i].alias(f"ctx_{i}") for i in range(2 * CONTEXT_M + 1)])
