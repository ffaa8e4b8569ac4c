"""Joins, semi/anti joins, lookups and as-of joins (inventory rows 41-51)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.scalars import wall_micros
from sessionlens.operators.ordering import keyed_scan
from sessionlens.schema import ROW_ORD, TARGET, TEST_PRODUCT


def join_lookup(big: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """Attach a per-key table to every row. AQE broadcasts the small side
    when its measured bytes allow it and splits a skewed key otherwise."""
    return big.join(small, on=on, how=how)


def user_counts_join(df: DataFrame) -> DataFrame:
    """clicks_per_user, sessions_per_user (distinct) and clicks_per_session,
    joined back to each row (one user aggregate, one session aggregate)."""
    per_user = df.groupBy("user_id").agg(
        F.sum(TARGET).cast("long").alias("clicks_per_user"),
        F.count_distinct("session_id").alias("sessions_per_user"))
    per_session = df.groupBy("session_id").agg(F.sum(TARGET).cast("long").alias("clicks_per_session"))
    return df.join(per_user, "user_id", "left").join(per_session, "session_id", "left")


def users_with_product(df: DataFrame, product: str = TEST_PRODUCT) -> DataFrame:
    return df.where(F.col("product") == product).select("user_id").distinct()


def semi_join_users(df: DataFrame, users: DataFrame) -> DataFrame:
    """Rows whose user is in ``users`` (EXISTS)."""
    return df.join(users, "user_id", "left_semi")


def anti_join_users(df: DataFrame, users: DataFrame) -> DataFrame:
    """Rows whose user is not in ``users`` (NOT EXISTS). A null user is
    kept, as ``isin`` on a set without it would."""
    return df.join(users, "user_id", "left_anti")


def outer_join_campaign(df: DataFrame) -> DataFrame:
    """Per campaign: distinct users exposed, full-outer-joined with the
    distinct users who clicked at least once in total."""
    d = df.dropna(subset=["user_id", "campaign_id", TARGET])
    exposure = d.groupBy("campaign_id").agg(F.count_distinct("user_id").alias("exposure"))
    clickers = d.groupBy("user_id").agg(F.sum(TARGET).alias("_c")).where(F.col("_c") > 0)
    per_campaign = (d.select("campaign_id", "user_id").distinct()
                     .join(clickers.select("user_id"), "user_id", "left_semi")
                     .groupBy("campaign_id").agg(F.count(F.lit(1)).alias("clickers_num")))
    return exposure.join(per_campaign, "campaign_id", "full")


def historical_click_table(df: DataFrame) -> DataFrame:
    """(user_id, DateTime, historical_click): clicks of the user's earlier
    rows (per user; the reference's shift crosses users)."""
    cols = df.select("user_id", "DateTime", ROW_ORD, TARGET)
    s = keyed_scan(cols, "user_id", ["DateTime", ROW_ORD], sum_cols=[TARGET])
    return s.select("user_id", "DateTime", F.col(f"_sum_{TARGET}").cast("long").alias("historical_click"))


def history_merge(df: DataFrame, history: DataFrame) -> DataFrame:
    """Left join on (user, DateTime). Duplicate keys in ``history`` fan out
    (the reference's behaviour, kept as the raw join): a key held d times on
    both sides gives d * d rows, so aggregate ``history`` first where rows of
    one user share a time without bound."""
    return df.join(history, ["user_id", "DateTime"], "left")


def sessions_table(df: DataFrame) -> DataFrame:
    """(user_id, DateTime, session_id, sessions): earlier rows of the user."""
    cols = df.select("user_id", "DateTime", ROW_ORD, "session_id")
    return keyed_scan(cols, "user_id", ["DateTime", ROW_ORD], count_out="sessions").select(
        "user_id", "DateTime", "session_id", F.col("sessions").cast("long").alias("sessions"))


def sessions_merge(df: DataFrame, sessions: DataFrame) -> DataFrame:
    return df.join(sessions, ["user_id", "DateTime", "session_id"], "left")


def _micros(c):
    return wall_micros(c)


def _asof_union(h: DataFrame, keys: DataFrame, value_cols) -> DataFrame:
    """Internal per-(user, time) rows and external keys in one frame, with
    external rows ordered before internal rows of the same time."""
    ext = keys
    for c in value_cols:
        ext = ext.withColumn(c, F.lit(0).cast("long"))
    return (h.select("user_id", "DateTime", *value_cols).withColumn("_ext", F.lit(False))
             .unionByName(ext.withColumn("_ext", F.lit(True)))
             .withColumn("_us", _micros("DateTime"))
             .withColumn("_side", F.when(F.col("_ext"), 0).otherwise(1)))


def asof_clicks(external: DataFrame, internal: DataFrame, drop_last: bool = False) -> DataFrame:
    """For each external row: the sum of the user's internal clicks strictly
    earlier in time (``drop_last`` also leaves out the latest of those rows,
    as the reference's cumsum/shift does).

    No range join: the internal rows are pre-aggregated per (user, time) and
    unioned with the distinct external (user, time) keys; a keyed scan, which
    splits a hot user across tasks, sums what comes before, and the result
    joins back on (user, time). With external rows ordered first at equal
    times, the exclusive running sum is the strictly-earlier sum.
    """
    h = (internal.where(F.col("DateTime").isNotNull())
                 .groupBy("user_id", "DateTime").agg(
                     F.sum(TARGET).cast("long").alias("_clicks"),
                     F.max_by(F.col(TARGET), F.col(ROW_ORD)).alias("_last")))
    keys = external.select("user_id", "DateTime").where(F.col("DateTime").isNotNull()).distinct()
    sums = ["_clicks"]
    if drop_last:
        # the previous group's last click, as a running sum of differences
        # between consecutive internal groups
        h = keyed_scan(h.withColumn("_us", _micros("DateTime")), "user_id", ["_us"], lag_cols=["_last"])
        h = h.withColumn("_dlast", (F.col("_last") - F.coalesce(F.col("_lag__last"), F.lit(0))).cast("long"))
        sums = ["_clicks", "_dlast"]
    sc = keyed_scan(_asof_union(h, keys, sums), "user_id", ["_us", "_side"], sum_cols=sums).where("_ext")
    val = F.col("_sum__clicks") - (F.col("_sum__dlast") if drop_last else F.lit(0))
    res = sc.select("user_id", "DateTime", val.cast("long").alias("historical_click"))
    return (external.join(res, ["user_id", "DateTime"], "left")
                    .withColumn("historical_click", F.coalesce("historical_click", F.lit(0))))


def asof_sessions(external: DataFrame, internal: DataFrame, with_rows: bool = True) -> DataFrame:
    """Internal sessions of the user strictly earlier in time, plus the
    external sessions of the user already seen (time order, then row order).
    Only ids and times are scanned; ``with_rows`` joins the external rows."""
    h = (internal.where(F.col("DateTime").isNotNull())
                 .groupBy("user_id", "DateTime").agg(F.count(F.lit(1)).alias("_n")))
    keys = external.select("user_id", "DateTime").where(F.col("DateTime").isNotNull()).distinct()
    u = _asof_union(h, keys, ["_n"])
    before = (keyed_scan(u, "user_id", ["_us", "_side"], sum_cols=["_n"]).where("_ext")
              .select("user_id", "DateTime", F.col("_sum__n").alias("_internal")))
    ext = keyed_scan(external.select("user_id", "DateTime", ROW_ORD), "user_id", ["DateTime", ROW_ORD], count_out="_seen")
    out = ext.join(before, ["user_id", "DateTime"], "left").select(
        F.col(ROW_ORD).alias("_row"), (F.coalesce("_internal", F.lit(0)) + F.col("_seen")).cast("long").alias("sessions"))
    if not with_rows:
        return out.withColumnRenamed("_row", ROW_ORD)
    return external.join(out, external[ROW_ORD] == out["_row"]).drop("_row")
