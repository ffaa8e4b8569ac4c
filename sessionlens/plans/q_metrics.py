"""Queries for metrics and statistics (rows 165-182).

Scored rows come from the session view: ``y_true`` = is_click,
``y_proba`` = score, ``y_pred`` = score >= 0.5.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlens.operators import cleaning, history, metrics, profile, splits, stats
from sessionlens.plans.registry import register, wide

SCORED_SQL = """
  , s AS (SELECT row_ord, is_click AS y_true, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS y_pred,
                 score AS y_proba FROM wide),
  cc AS (SELECT CAST(sum(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
                CAST(sum(CASE WHEN y_true = 0 AND y_pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
                CAST(sum(CASE WHEN y_true = 1 AND y_pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
                CAST(sum(CASE WHEN y_true = 0 AND y_pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM s),
  m AS (SELECT *,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS recall,
    CASE WHEN 2 * tp + fn + fp = 0 THEN 0.0 ELSE 2.0 * tp / (2.0 * tp + fn + fp) END AS f1,
    CASE WHEN 5 * tp + 4 * fn + fp = 0 THEN 0.0 ELSE 5.0 * tp / (5.0 * tp + 4.0 * fn + fp) END AS fbeta,
    CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0.0
         ELSE (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn)
              / sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)) END AS mcc,
    ((CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / CAST(tp + fn AS DOUBLE) END)
      + (CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / CAST(tn + fp AS DOUBLE) END))
      / ((CASE WHEN tp + fn > 0 THEN 1 ELSE 0 END) + (CASE WHEN tn + fp > 0 THEN 1 ELSE 0 END)) AS bacc
    FROM cc)"""


def scored(spark, sf_dir):
    return wide(spark, sf_dir).select(
        "row_ord", F.col("is_click").alias("y_true"),
        (F.col("score") >= 0.5).cast("int").alias("y_pred"), F.col("score").alias("y_proba"))


@register("confusion_matrix", sql=SCORED_SQL + " SELECT y_true, y_pred, count(*) AS count FROM s GROUP BY ALL")
def q_confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(scored(spark, sf_dir))


def _metric(name):
    sql_expr = "2 * bacc - 1" if name == "aba" else name

    @register(f"metric_{name}", sql=SCORED_SQL + f" SELECT {sql_expr} AS {name} FROM m")
    def q(spark, sf_dir):
        return metrics.label_metrics(scored(spark, sf_dir), beta=2.0).select(name)
    return q


for _name in ("precision", "recall", "f1", "fbeta", "mcc", "bacc", "aba"):
    _metric(_name)

_SC = """
  , sc AS (SELECT y_proba, CAST(sum(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
                  CAST(sum(CASE WHEN y_true = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg
           FROM s WHERE y_proba IS NOT NULL GROUP BY y_proba)"""


@register("metric_auc", sql=SCORED_SQL + _SC + """
  , c AS (SELECT *, COALESCE(sum(neg) OVER (ORDER BY y_proba ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
          AS below_neg FROM sc)
  SELECT sum(pos * (below_neg + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc FROM c""")
def q_metric_auc(spark, sf_dir):
    return metrics.roc_auc(scored(spark, sf_dir))


_PR = _SC + """
  , c AS (SELECT *, COALESCE(sum(pos) OVER w, 0) AS tp_prev, COALESCE(sum(neg) OVER w, 0) AS fp_prev,
                 sum(pos) OVER () AS P FROM sc
          WINDOW w AS (ORDER BY y_proba DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  p AS (SELECT tp_prev + pos AS tp, fp_prev + neg AS fp, tp_prev, fp_prev, P FROM c),
  q AS (SELECT tp / CAST(P AS DOUBLE) AS r, tp_prev / CAST(P AS DOUBLE) AS r0,
          CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS pr,
          CASE WHEN tp_prev + fp_prev = 0 THEN 1.0 ELSE tp_prev / CAST(tp_prev + fp_prev AS DOUBLE) END AS pr0
        FROM p)"""


@register("metric_auprc", sql=SCORED_SQL + _PR + " SELECT sum((r - r0) * (pr + pr0) / 2) AS auprc FROM q")
def q_metric_auprc(spark, sf_dir):
    return metrics.auprc(scored(spark, sf_dir))


@register("metric_avg_precision", sql=SCORED_SQL + _PR + """
  SELECT ap AS average_precision, base_rate, ap / base_rate AS ap_lift FROM
    (SELECT sum((r - r0) * pr) AS ap FROM q), (SELECT avg(CAST(y_true AS DOUBLE)) AS base_rate FROM s)""")
def q_metric_avg_precision(spark, sf_dir):
    return metrics.average_precision(scored(spark, sf_dir))


@register("classification_report", sql=SCORED_SQL + """
  SELECT 1 AS class, precision, recall, f1, tp + fn AS support FROM m
  UNION ALL
  SELECT 0, CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / CAST(tn + fn AS DOUBLE) END,
    CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / CAST(tn + fp AS DOUBLE) END,
    CASE WHEN 2 * tn + fp + fn = 0 THEN 0.0 ELSE 2.0 * tn / (2.0 * tn + fp + fn) END, tn + fp FROM m""")
def q_classification_report(spark, sf_dir):
    return metrics.classification_report(scored(spark, sf_dir))


@register("score_summary", sql=SCORED_SQL + """ SELECT min(y_proba) AS min_score, max(y_proba) AS max_score,
  avg(y_proba) AS mean_score FROM s""")
def q_score_summary(spark, sf_dir):
    return metrics.score_summary(scored(spark, sf_dir))


@register("cv_scores", sql=SCORED_SQL + """
  , r AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || CAST(row_ord AS VARCHAR)), row_ord) - 1 AS p,
          count(*) OVER () AS n FROM s),
  fo AS (SELECT *, CASE WHEN p < (n % 5) * (n // 5 + 1) THEN p // (n // 5 + 1)
                   ELSE n % 5 + (p - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold FROM r),
  pf AS (SELECT fold,
     sum(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN y_true = 0 AND y_pred = 1 THEN 1 ELSE 0 END) AS fp,
     sum(CASE WHEN y_true = 1 AND y_pred = 0 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN y_true = 0 AND y_pred = 0 THEN 1 ELSE 0 END) AS tn
     FROM fo GROUP BY fold),
  sc2 AS (SELECT CASE WHEN 2 * tp + fn + fp = 0 THEN 0.0 ELSE 2.0 * tp / (2.0 * tp + fn + fp) END AS f1,
                 CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy FROM pf)
  SELECT avg(f1) AS mean_f1, stddev_pop(f1) AS std_f1, avg(accuracy) AS mean_accuracy,
         stddev_pop(accuracy) AS std_accuracy, count(*) AS folds FROM sc2""")
def q_cv_scores(spark, sf_dir):
    s = splits.kfold(scored(spark, sf_dir), 5)
    return metrics.cv_scores(s)


_GRP = """
  , comb AS (SELECT *, NULLIF(CAST(COALESCE(product_category_1, 0) AS VARCHAR) || '_' ||
                   CAST(COALESCE(product_category_2, 0) AS VARCHAR), '0_0') AS product_cat_comb FROM wide),
  grp AS (SELECT product_cat_comb, campaign_id, avg(is_click) AS click_rate, count(is_click) AS sessions_number
          FROM comb WHERE is_click IS NOT NULL AND product_cat_comb IS NOT NULL AND campaign_id IS NOT NULL
          GROUP BY ALL)"""


@register("pearson_r", sql=_GRP + """
  , st AS (SELECT r, n, r * sqrt((n - 2) / (1 - r * r)) AS t_stat, CAST(n - 2 AS DOUBLE) AS d FROM (
    SELECT corr(CAST(sessions_number AS DOUBLE), click_rate) AS r, count(*) AS n FROM grp)),
  -- both tails of Student's t: Simpson's rule over u in [0, 1), the density taken at |t| + u / (1 - u)
  cell AS (SELECT r, n, t_stat, d, i, i / 20000.0::DOUBLE AS u FROM st, range(0, 20000) AS k(i)),
  dens AS (SELECT r, n, t_stat, CASE WHEN i = 0 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END *
      exp(lgamma((d + 1) / 2) - lgamma(d / 2) - (d + 1) / 2 * ln(1 + power(abs(t_stat) + u / (1 - u), 2) / d))
      / sqrt(d * pi()) / power(1 - u, 2) AS f FROM cell)
  SELECT r, n, t_stat, round(2 * sum(f) / 60000.0, 9) AS p FROM dens GROUP BY r, n, t_stat""")
def q_pearson_r(spark, sf_dir):
    g = profile.outcome_by_group(cleaning.combine_categories(wide(spark, sf_dir)),
                                 ["product_cat_comb", "campaign_id"], "click_rate", 0)
    return stats.pearson(g, "sessions_number", "click_rate").withColumn("p", F.round("p", 9))


_CORR_COLS = ["session_id", "user_id", "campaign_id", "webpage_id", "product_category_1", "product_category_2",
              "user_group_id", "age_level", "user_depth", "city_development_index", "var_1", "is_click", "score"]


@register("corr_matrix", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM wide"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]))
def q_corr_matrix(spark, sf_dir):
    return stats.corr_matrix(wide(spark, sf_dir), _CORR_COLS)


_RECENT = """
  , t AS (SELECT *, (epoch_us("DateTime") - epoch_us(lag("DateTime") OVER (PARTITION BY user_id
          ORDER BY "DateTime" NULLS LAST, row_ord))) / 1e6 / 3600.0 AS h, count(*) OVER (PARTITION BY user_id) AS n FROM wide),
  f AS (SELECT *, CASE WHEN h <= 1.0 THEN 1 ELSE 0 END AS had_recent_session FROM t WHERE n > 2 AND h IS NOT NULL)"""


@register("crosstab", sql=_RECENT + """ SELECT had_recent_session,
  count(*) FILTER (WHERE is_click = 0) AS is_click_0, count(*) FILTER (WHERE is_click = 1) AS is_click_1
  FROM f GROUP BY had_recent_session""")
def q_crosstab(spark, sf_dir):
    return stats.crosstab(history.recent_session_rows(wide(spark, sf_dir)), "had_recent_session", "is_click")


@register("chi_square", sql=_RECENT + """
  , o AS (SELECT count(*) FILTER (WHERE had_recent_session = 0 AND is_click = 0) AS o00,
            count(*) FILTER (WHERE had_recent_session = 0 AND is_click = 1) AS o01,
            count(*) FILTER (WHERE had_recent_session = 1 AND is_click = 0) AS o10,
            count(*) FILTER (WHERE had_recent_session = 1 AND is_click = 1) AS o11 FROM f),
  e AS (SELECT *, CAST(o00 + o01 + o10 + o11 AS DOUBLE) AS n FROM o),
  x AS (SELECT *, (o00 + o01) * (o00 + o10) / n AS e00, (o00 + o01) * (o01 + o11) / n AS e01,
               (o10 + o11) * (o00 + o10) / n AS e10, (o10 + o11) * (o01 + o11) / n AS e11 FROM e),
  y AS (SELECT o00, o01, o10, o11,
    power(o00 + 0.5 * sign(e00 - o00) - e00, 2) / e00 + power(o01 + 0.5 * sign(e01 - o01) - e01, 2) / e01
    + power(o10 + 0.5 * sign(e10 - o10) - e10, 2) / e10 + power(o11 + 0.5 * sign(e11 - o11) - e11, 2) / e11 AS chi2,
    1 AS dof FROM x),
  -- upper tail of the normal distribution at sqrt(chi2), twice: Simpson's rule over u in [0, 1)
  cell AS (SELECT y.*, i, i / 20000.0::DOUBLE AS u FROM y, range(0, 20000) AS k(i)),
  dens AS (SELECT o00, o01, o10, o11, chi2, dof, CASE WHEN i = 0 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
      * exp(-power(sqrt(chi2) + u / (1 - u), 2) / 2) / sqrt(2 * pi()) / power(1 - u, 2) AS f FROM cell)
  SELECT o00, o01, o10, o11, chi2, dof, round(2 * sum(f) / 60000.0, 9) AS p FROM dens GROUP BY ALL""")
def q_chi_square(spark, sf_dir):
    t = stats.chi_square_2x2(history.recent_session_rows(wide(spark, sf_dir)), "had_recent_session", "is_click")
    return t.withColumn("p", F.round("p", 9))
