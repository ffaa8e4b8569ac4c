"""Time series (inventory rows 120-126)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.functions.scalars import wall_micros
from sessionlens.schema import TARGET


def _with_gaps(agg: DataFrame, unit: str) -> DataFrame:
    """A table by period with a row of 0 for every ``unit`` ('hour' / 'day')
    missing between its first and its last. Each row writes the empty periods
    up to the next one, so the data are scanned once and nothing is joined.
    The window holds the table by period alone: a row per hour of the time
    span at most, whatever the number of sessions."""
    step = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY"}[unit]
    d = agg.withColumn("_next", F.lead("period").over(Window.orderBy("period"))).withColumn("_at", F.expr(
        f"explode(sequence(period, coalesce(_next - {step}, period), {step}))"))
    own = lambda c: F.when(F.col("_at") == F.col("period"), F.col(c)).otherwise(F.lit(0)).alias(c)
    return d.select(F.col("_at").alias("period"), own("sessions"), own("clicks"))


def _trunc(df: DataFrame, unit: str, ts: str):
    # date_trunc yields TIMESTAMP; keep the input's type (NTZ stays NTZ)
    return F.date_trunc(unit, ts).cast(df.schema[ts].dataType)


def _by_period(df: DataFrame, unit: str, ts: str) -> DataFrame:
    return (df.where(F.col(ts).isNotNull() & F.col(TARGET).isNotNull())
              .groupBy(_trunc(df, unit, ts).alias("period"))
              .agg(F.count(F.lit(1)).alias("sessions"), F.sum(TARGET).cast("long").alias("clicks")))


def hourly_ctr(df: DataFrame, ts: str = "DateTime") -> DataFrame:
    """Sessions, clicks and CTR per hour; hours without data are rows with
    0 sessions, 0 clicks and a null CTR."""
    return _with_gaps(_by_period(df, "hour", ts), "hour").withColumn(
        "ctr", F.try_divide(F.col("clicks").cast("double"), F.col("sessions")))


def daily_ctr(df: DataFrame, ts: str = "DateTime") -> DataFrame:
    """Mean click per day; a day without data is 0."""
    return _with_gaps(_by_period(df, "day", ts), "day").select(
        F.to_date("period").alias("day"),
        F.coalesce(F.try_divide(F.col("clicks").cast("double"), F.col("sessions")), F.lit(0.0)).alias("ctr"))


def monthly_ctr(df: DataFrame, ts: str = "DateTime") -> DataFrame:
    """Mean click per month, labelled by the month's last day; months
    without data do not appear."""
    d = df.where(F.col(ts).isNotNull() & F.col(TARGET).isNotNull())
    return d.groupBy(F.last_day(ts).alias("month_end")).agg(F.avg(TARGET).alias("ctr"))


def diurnal_profile(df: DataFrame, ts: str = "DateTime") -> DataFrame:
    """Click rate and exposure (sessions) by hour of day."""
    d = df.where(F.col(ts).isNotNull() & F.col(TARGET).isNotNull())
    return d.groupBy(F.hour(ts).alias("hour")).agg(
        F.avg(TARGET).alias("click_rate"), F.count("session_id").alias("exposure"))


def time_bounds(df: DataFrame, by=None, ts: str = "DateTime") -> DataFrame:
    """First and last time, overall or per group (e.g. per split)."""
    g = df.groupBy(*by) if by else df
    return g.agg(F.min(ts).alias("min_time"), F.max(ts).alias("max_time"))


def localize_utc(df: DataFrame, ts: str = "DateTime", out: str = "DateTime_utc") -> DataFrame:
    """Naive wall time read as UTC: an instant (TIMESTAMP), whatever the
    session time zone."""
    return df.withColumn(out, F.timestamp_micros(wall_micros(ts)))


def utc_text(ts: str, fmt: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"):
    """An instant rendered in UTC, whatever the session time zone."""
    wall = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(ts).cast("timestamp_ntz"))
    return F.date_format(wall, fmt)
