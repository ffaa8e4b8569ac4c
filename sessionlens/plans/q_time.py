"""Queries for time series (rows 120-126) and sorts / set operations (127-132)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlens.functions import scalars as S
from sessionlens.operators import cleaning, profile, setops, timeseries
from sessionlens.plans.q_clean import INFER_SQL, SPLIT_CASE, TEST_START, TRAIN_COLS, VAL_START
from sessionlens.plans.q_profile import N_CLICKS, _NCLICK_SQL
from sessionlens.plans.registry import narrow, register, wide


@register("parse_datetime", sql="""SELECT row_ord,
  try_strptime(strftime("DateTime", '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed,
  try_strptime(strftime("DateTime", '%d/%m/%Y %H:%M'), '%d/%m/%Y %H:%M') AS parsed_dayfirst,
  try_strptime('not a time ' || CAST(row_ord AS VARCHAR), '%Y-%m-%d %H:%M:%S') AS parsed_bad FROM wide""")
def q_parse_datetime(spark, sf_dir):
    w = wide(spark, sf_dir)
    text = F.date_format("DateTime", "yyyy-MM-dd HH:mm:ss")
    dayfirst = F.date_format("DateTime", "dd/MM/yyyy HH:mm")
    bad = F.concat(F.lit("not a time "), F.col("row_ord").cast("string"))
    return w.select("row_ord", S.parse_datetime(text).cast("timestamp_ntz").alias("parsed"),
                    S.parse_datetime_dayfirst(dayfirst).cast("timestamp_ntz").alias("parsed_dayfirst"),
                    S.parse_datetime(bad).cast("timestamp_ntz").alias("parsed_bad"))


@register("hourly_ctr", sql="""
  , d AS (SELECT * FROM wide WHERE "DateTime" IS NOT NULL AND is_click IS NOT NULL),
  cal AS (SELECT unnest(generate_series(min(date_trunc('hour', "DateTime")), max(date_trunc('hour', "DateTime")),
          INTERVAL 1 HOUR)) AS period FROM d),
  a AS (SELECT date_trunc('hour', "DateTime") AS period, count(*) AS sessions, CAST(sum(is_click) AS BIGINT) AS clicks
        FROM d GROUP BY 1)
  SELECT cal.period, COALESCE(sessions, 0) AS sessions, COALESCE(clicks, 0) AS clicks,
         CAST(clicks AS DOUBLE) / sessions AS ctr FROM cal LEFT JOIN a USING (period)""")
def q_hourly_ctr(spark, sf_dir):
    return timeseries.hourly_ctr(wide(spark, sf_dir))


@register("daily_ctr", sql="""
  , d AS (SELECT * FROM wide WHERE "DateTime" IS NOT NULL AND is_click IS NOT NULL),
  cal AS (SELECT unnest(generate_series(min(date_trunc('day', "DateTime")), max(date_trunc('day', "DateTime")),
          INTERVAL 1 DAY)) AS period FROM d),
  a AS (SELECT date_trunc('day', "DateTime") AS period, count(*) AS sessions, sum(is_click) AS clicks FROM d GROUP BY 1)
  SELECT CAST(cal.period AS DATE) AS day, COALESCE(CAST(clicks AS DOUBLE) / sessions, 0.0) AS ctr
  FROM cal LEFT JOIN a USING (period)""")
def q_daily_ctr(spark, sf_dir):
    return timeseries.daily_ctr(wide(spark, sf_dir))


@register("monthly_ctr", sql="""SELECT last_day("DateTime") AS month_end, avg(is_click) AS ctr FROM wide
  WHERE "DateTime" IS NOT NULL AND is_click IS NOT NULL GROUP BY 1""")
def q_monthly_ctr(spark, sf_dir):
    return timeseries.monthly_ctr(wide(spark, sf_dir))


@register("diurnal_profile", sql="""SELECT CAST(hour("DateTime") AS INTEGER) AS hour, avg(is_click) AS click_rate,
  count(session_id) AS exposure FROM wide WHERE "DateTime" IS NOT NULL AND is_click IS NOT NULL GROUP BY 1""")
def q_diurnal_profile(spark, sf_dir):
    return timeseries.diurnal_profile(wide(spark, sf_dir))


@register("time_bounds", sql=f"""SELECT {SPLIT_CASE} AS split, min("DateTime") AS min_time, max("DateTime") AS max_time
  FROM wide WHERE "DateTime" IS NOT NULL GROUP BY 1""")
def q_time_bounds(spark, sf_dir):
    s = cleaning.time_range_split(wide(spark, sf_dir), VAL_START, TEST_START)
    return timeseries.time_bounds(s, ["split"])


@register("localize_utc", sql="""SELECT row_ord, epoch_us("DateTime") AS utc_micros,
  strftime("DateTime", '%Y-%m-%dT%H:%M:%S.%fZ') AS utc_iso FROM wide""")
def q_localize_utc(spark, sf_dir):
    d = timeseries.localize_utc(wide(spark, sf_dir))
    return d.select("row_ord", F.unix_micros("DateTime_utc").alias("utc_micros"),
                    timeseries.utc_text("DateTime_utc").alias("utc_iso"))


# -- sorts, unions, set differences --------------------------------------------------------

@register("sort_sessions", sql='SELECT * FROM wide ORDER BY user_id NULLS LAST, "DateTime" NULLS LAST, row_ord')
def q_sort_sessions(spark, sf_dir):
    return setops.sort_sessions(wide(spark, sf_dir), "user_time")


@register("sort_campaigns", sql=_NCLICK_SQL + " SELECT * FROM nc ORDER BY rate_1 DESC NULLS LAST, campaign_id")
def q_sort_campaigns(spark, sf_dir):
    nc = profile.n_clickers_rate(narrow(spark, sf_dir), N_CLICKS)
    return nc.orderBy(F.col("rate_1").desc_nulls_last(), "campaign_id")


@register("union_splits", sql=f'SELECT *, {SPLIT_CASE} AS split FROM wide WHERE "DateTime" IS NOT NULL')
def q_union_splits(spark, sf_dir):
    w = wide(spark, sf_dir)
    parts = [cleaning.time_range_part(w, lo, hi).withColumn("split", F.lit(name))
             for name, lo, hi in (("train", None, VAL_START), ("val", VAL_START, TEST_START),
                                  ("test", TEST_START, None))]
    return setops.union_splits(*parts)


def _q(c):
    return f'"{c}"'


_NOT_NULL = " AND ".join(f"{_q(c)} IS NOT NULL" for c in TRAIN_COLS)


@register("rows_only_once", sql=f"""
  , b AS ({INFER_SQL}), a AS (SELECT * FROM b WHERE {_NOT_NULL})
  SELECT * FROM (SELECT * FROM b UNION ALL SELECT * FROM a) GROUP BY ALL HAVING count(*) = 1""")
def q_rows_only_once(spark, sf_dir):
    before = cleaning.clean_inference(wide(spark, sf_dir))
    return setops.rows_only_once(before, cleaning.dropna_any(before))


@register("dropped_rows", sql=f"SELECT * FROM ({INFER_SQL}) WHERE NOT ({_NOT_NULL})")
def q_dropped_rows(spark, sf_dir):
    before = cleaning.clean_inference(wide(spark, sf_dir))
    return setops.dropped_rows(before, cleaning.dropna_any(before))
