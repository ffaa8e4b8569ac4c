"""Queries for splits and samples (rows 52-53 live in q_profile; 141-151 here)."""

from __future__ import annotations

from sessionlens.operators import splits
from sessionlens.plans.registry import narrow, register, wide

SEED = 42


def _md5(seed, col):
    return f"md5('{seed}|' || CAST({col} AS VARCHAR))"


def _labels_sql(src, distinct=True):
    s = "count(DISTINCT session_id)" if distinct else "count(session_id)"
    return (f"SELECT user_id, CAST({s} AS VARCHAR) || '_sessions_' || CAST(sum(is_click) AS VARCHAR) "
            f"|| '_clicks' AS label FROM {src} WHERE user_id IS NOT NULL GROUP BY user_id")


def _round_assign(n1, n2, pos="pos"):
    return f"CASE WHEN {pos} <= {n1} THEN 'train' WHEN {pos} <= {n1} + {n2} THEN 'val' ELSE 'test' END"


def _user_split_sql(src, name):
    return f"""
  {name}_lab AS ({_labels_sql(src)}),
  {name}_g AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY label) < 20 THEN 'rare' ELSE label END AS grp
       FROM {name}_lab),
  {name}_r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY {_md5(SEED, 'user_id')}, user_id) AS pos,
       count(*) OVER (PARTITION BY grp) AS n FROM {name}_g),
  {name}_u AS (SELECT user_id, {_round_assign('round_even(0.6 * n, 0)',
                                 'LEAST(round_even(0.2 * n, 0), n - round_even(0.6 * n, 0))')} AS split
       FROM {name}_r)"""


@register("split_by_user", sql=f", {_user_split_sql('narrow', 's')} "
          "SELECT row_ord, split FROM narrow JOIN s_u USING (user_id)")
def q_split_by_user(spark, sf_dir):
    return splits.split_by_user(narrow(spark, sf_dir)).select("row_ord", "split")


_LOPO_SQL = f"""
  , seen AS (SELECT DISTINCT user_id FROM narrow WHERE product = 'A'),
  rare_rows AS (SELECT * FROM narrow WHERE user_id IN (SELECT user_id FROM seen)),
  normal_rows AS (SELECT * FROM narrow WHERE user_id NOT IN (SELECT user_id FROM seen)),
  {_user_split_sql('rare_rows', 'ra')},
  {_user_split_sql('normal_rows', 'no')},
  lopo AS (
    SELECT * FROM (SELECT rare_rows.*, ra_u.split FROM rare_rows JOIN ra_u USING (user_id)
                   UNION ALL SELECT normal_rows.*, no_u.split FROM normal_rows JOIN no_u USING (user_id))
    WHERE NOT (split = 'train' AND product = 'A') OR product IS NULL)"""


def _lopo(spark, sf_dir):
    return splits.leave_one_product_out(narrow(spark, sf_dir))


@register("leave_one_product_out", sql=_LOPO_SQL + " SELECT row_ord, split FROM lopo")
def q_leave_one_product_out(spark, sf_dir):
    return _lopo(spark, sf_dir).select("row_ord", "split")


@register("split_stats", sql=_LOPO_SQL + """ SELECT split, count(*) AS rows,
  CAST(count(*) * 100.0 / (SELECT count(*) FROM lopo) AS DOUBLE) AS pct_rows, avg(is_click) AS ctr,
  count(DISTINCT user_id) AS users, count(*) / count(DISTINCT user_id) AS mean_sessions_per_user
  FROM lopo GROUP BY split""")
def q_split_stats(spark, sf_dir):
    return splits.split_stats(_lopo(spark, sf_dir))


@register("split_integrity", sql=_LOPO_SQL + """ SELECT
  (SELECT count(*) FROM lopo WHERE split = 'train' AND product = 'A') AS test_product_rows_in_train,
  (SELECT count(*) FROM (SELECT user_id FROM lopo GROUP BY user_id HAVING count(DISTINCT split) > 1))
    AS users_in_several_splits, true AS ratios_sum_to_one""")
def q_split_integrity(spark, sf_dir):
    return splits.split_integrity(_lopo(spark, sf_dir))


@register("split_common_rare", sql=f"""
  , lab AS ({_labels_sql('narrow', distinct=False)}),
  g AS (SELECT *, count(*) OVER (PARTITION BY label) >= 6 AS common FROM lab),
  g2 AS (SELECT *, CASE WHEN common THEN label ELSE '__rare__' END AS grp FROM g),
  r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY {_md5(SEED, 'user_id')}, user_id) AS pos,
        count(*) OVER (PARTITION BY grp) AS n FROM g2),
  u AS (SELECT user_id, CASE WHEN common THEN
          {_round_assign('round_even(0.6 * n, 0)', 'round_even(0.5 * (n - round_even(0.6 * n, 0)), 0)')}
        ELSE {_round_assign('floor(0.6 * n)', 'LEAST(floor(0.2 * n), n - floor(0.6 * n))')} END AS split FROM r)
  SELECT row_ord, split FROM narrow JOIN u USING (user_id)""")
def q_split_common_rare(spark, sf_dir):
    return splits.split_common_rare(narrow(spark, sf_dir)).select("row_ord", "split")


@register("split_user_stratified", sql=f"""
  , lab AS ({_labels_sql('narrow')}),
  g AS (SELECT * FROM lab WHERE label IN (SELECT label FROM lab GROUP BY label HAVING count(*) >= 2)),
  r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_md5(SEED, 'user_id')}, user_id) AS pos,
        count(*) OVER (PARTITION BY label) AS n FROM g),
  u AS (SELECT user_id, {_round_assign('round_even(0.6 * n, 0)', 'round_even(0.5 * (n - round_even(0.6 * n, 0)), 0)')}
        AS split FROM r)
  SELECT row_ord, split FROM narrow JOIN u USING (user_id)""")
def q_split_user_stratified(spark, sf_dir):
    return splits.split_user_stratified(narrow(spark, sf_dir)).select("row_ord", "split")


@register("split_stratified_rows", sql=f"""
  , r AS (SELECT row_ord, row_number() OVER (PARTITION BY is_click ORDER BY {_md5(SEED, 'row_ord')}, row_ord) AS pos,
          count(*) OVER (PARTITION BY is_click) AS n FROM wide)
  SELECT row_ord, {_round_assign('round_even(0.6 * n, 0)', 'LEAST(round_even(0.2 * n, 0), n - round_even(0.6 * n, 0))')}
    AS split FROM r""")
def q_split_stratified_rows(spark, sf_dir):
    return splits.split_stratified_rows(wide(spark, sf_dir)).select("row_ord", "split")


@register("holdout_split", sql=f"""
  , r AS (SELECT row_ord, row_number() OVER (ORDER BY {_md5(SEED, 'row_ord')}, row_ord) AS pos,
          count(*) OVER () AS n FROM wide)
  SELECT row_ord, CASE WHEN pos <= n - ceil(0.2 * n) THEN 'train' ELSE 'test' END AS split FROM r""")
def q_holdout_split(spark, sf_dir):
    return splits.holdout_split(wide(spark, sf_dir)).select("row_ord", "split")


K_SAMPLES, RATIO = 5, 2
_BAL_SQL = ", " + ", ".join(
    f"""s{i} AS (SELECT row_ord, is_click, {i} AS sample_id FROM wide WHERE is_click = 1
      UNION ALL SELECT row_ord, is_click, {i} FROM (SELECT *, row_number() OVER (ORDER BY {_md5(i, 'row_ord')}, row_ord)
        AS pos FROM wide WHERE is_click = 0) WHERE pos <= {RATIO} * (SELECT count(*) FROM wide WHERE is_click = 1))"""
    for i in range(K_SAMPLES)) + ", bal AS (" + " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(K_SAMPLES)) + ")"


@register("balanced_samples", sql=_BAL_SQL + " SELECT row_ord, is_click, sample_id FROM bal")
def q_balanced_samples(spark, sf_dir):
    return splits.balanced_samples(wide(spark, sf_dir), K_SAMPLES, RATIO).select("row_ord", "is_click", "sample_id")


@register("balance_report", sql=_BAL_SQL + " SELECT sample_id, is_click, count(*) AS rows FROM bal GROUP BY ALL")
def q_balance_report(spark, sf_dir):
    return splits.balance_report(splits.balanced_samples(wide(spark, sf_dir), K_SAMPLES, RATIO))


@register("kfold", sql=f"""
  , r AS (SELECT row_ord, row_number() OVER (ORDER BY {_md5(SEED, 'row_ord')}, row_ord) - 1 AS p,
          count(*) OVER () AS n FROM wide),
  q AS (SELECT *, n // 5 AS q, n % 5 AS rem FROM r)
  SELECT row_ord, CAST(CASE WHEN p < rem * (q + 1) THEN p // (q + 1) ELSE rem + (p - rem * (q + 1)) // q END
    AS INTEGER) AS fold FROM q""")
def q_kfold(spark, sf_dir):
    return splits.kfold(wide(spark, sf_dir), 5).select("row_ord", "fold")
