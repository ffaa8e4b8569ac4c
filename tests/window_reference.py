"""The same features and histories as plain windows and joins: slow on a hot
user, simple to read, and independent of the library's plans."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionlens.functions.scalars import early_morning, wall_micros
from sessionlens.operators.features import (EXCESS_DUP_QUANTILE, HIGH_VOLUME_QUANTILE, MIN_GAP_SECONDS, _FIRST,
                                            _final_select, _prep)
from sessionlens.schema import ROW_ORD, TARGET


def _order():
    return [F.col("DateTime").asc_nulls_last(), F.col(ROW_ORD).asc()]


def _first_row(w):
    return F.row_number().over(w.orderBy(ROW_ORD)) == 1


def _window_features(d, needed):
    """All grouped features as windows over the rows ."""
    c = F.col
    wU = Window.partitionBy("user_id")
    wUD = Window.partitionBy("user_id", "_date")
    wUT = Window.partitionBy("user_id", "DateTime")

    def nuniq(col, w):
        return F.size(F.collect_set(col).over(w))

    def mixed(col, w):
        v = c(col).cast("int")
        return F.coalesce((F.max(v).over(w) != F.min(v).over(w)).cast("int"), F.lit(0))

    has_t = c("DateTime").isNotNull()
    d = d.select(
        "*",
        F.count(F.lit(1)).over(wUT).alias("_n_ut"),
        nuniq("product", wUT).alias("_nu_prod_ut"),
        nuniq("webpage_id", wUT).alias("_nu_web_ut"),
        mixed("secondary_product_category_known", wUT).alias("session_mixed_secondary_product_category_known"),
        mixed("city_development_index_known", wUT).alias("session_mixed_city_development_index_known"),
        mixed("var_1", wUT).alias("session_mixed_var1"),
        F.count(F.lit(1)).over(wUD).alias("_n_ud"),
        F.count("webpage_id").over(wUD).alias("_web_ud"),
        # per-day distinct counts, kept on the day's first row only so that
        # a per-user sum averages over days, not rows
        F.when(_first_row(wUD) & c("_date").isNotNull(), nuniq("product", wUD)).alias("_dp"),
        F.when(_first_row(wUD) & c("_date").isNotNull(), nuniq("campaign_id", wUD)).alias("_dc"),
        F.when(_first_row(wUD) & c("_date").isNotNull(), nuniq("webpage_id", wUD)).alias("_dw"),
        F.when(c("_date").isNotNull(), F.size(F.collect_set(F.hour("DateTime")).over(wUD))).alias("_dh"),
        nuniq("product", wU).alias("_nu_prod"),
        nuniq("product_category", wU).alias("_nu_cat"),
        nuniq("campaign_id", wU).alias("_nu_camp"),
        nuniq("webpage_id", wU).alias("_nu_web"),
        F.sum(F.coalesce(early_morning("DateTime").cast("int"), F.lit(0))).over(wU).alias("_early"),
        mixed("city_development_index_known", wU).alias("mixed_city_development_index_known"),
        mixed("secondary_product_category_known", wU).alias("mixed_product_category_2_known"),
        F.coalesce((F.max("var_1").over(wU) == F.min("var_1").over(wU)).cast("int"), F.lit(0))
         .alias("user_uniform_var1"),
        F.size(F.collect_set("_date").over(wU)).alias("_days"),
        F.when(c("product").isNotNull() & c("campaign_id").isNotNull() & c("webpage_id").isNotNull(),
               F.count(F.lit(1)).over(Window.partitionBy("user_id", "product", "campaign_id", "webpage_id")))
         .alias("_ident"),
    )
    d = d.select(
        "*",
        F.percentile(c("_n_ud"), F.lit(HIGH_VOLUME_QUANTILE)).over(Window.partitionBy("_date")).alias("_thr"),
        F.max(F.when(has_t, c("_n_ut"))).over(wU).alias("_max_ut"),
        F.ceil(F.try_divide(F.sum("_dp").over(wU), c("_days"))).alias("_div_prod"),
        F.ceil(F.try_divide(F.sum("_dc").over(wU), c("_days"))).alias("_div_camp"),
        F.ceil(F.try_divide(F.sum("_dw").over(wU), c("_days"))).alias("_div_web"),
        F.max("_dh").over(wU).alias("_max_hours"),
        F.max("_ident").over(wU).alias("_max_ident"),
        _first_row(wU).alias("_first_of_user"),
    )
    d = d.withColumn("_thr", F.when(c("_date").isNotNull(), c("_thr")))
    # 0.99 quantile over users (one value per user): a one-row aggregate
    thr99 = (d.where(c("_first_of_user")).agg(F.percentile("_max_ut", F.lit(EXCESS_DUP_QUANTILE)).alias("_thr99")))
    d = d.crossJoin(F.broadcast(thr99))
    for n, key in _FIRST.items():
        if n in needed:
            w = Window.partitionBy("user_id", key).orderBy(*_order())
            d = d.withColumn(f"_first_{key}", F.when(c(key).isNotNull() & c("user_id").isNotNull(),
                                                     F.first(ROW_ORD).over(w.rowsBetween(Window.unboundedPreceding,
                                                                                         Window.unboundedFollowing))))
    return d


def sequential(d, needed):
    """Plain windows per user, in the reference's words."""
    micros = wall_micros("DateTime")
    order = [F.col("DateTime").asc_nulls_last(), F.col(ROW_ORD).asc()]
    if "prev_session_same_product" in needed:
        prev = F.lag("product").over(Window.partitionBy("user_id").orderBy(*order))
        d = d.withColumn("prev_session_same_product",
                         F.when(F.col("user_id").isNull(), 0)
                          .otherwise(F.coalesce((prev == F.col("product")).cast("int"), F.lit(0))))
    if "sessions_with_min_gap_count" in needed:
        gap = micros - F.lag(micros).over(Window.partitionBy("user_id").orderBy(ROW_ORD))
        d = d.withColumn("_short_gap", (gap < MIN_GAP_SECONDS * 1_000_000).cast("int"))
        d = d.withColumn("_gaps", F.sum("_short_gap").over(Window.partitionBy("user_id")))
    if "daily_session_sequence" in needed:
        w = Window.partitionBy("user_id", "_date").orderBy(ROW_ORD)
        d = d.withColumn("daily_session_sequence", F.least(F.row_number().over(w), F.lit(7)))
    return d


def compute_features(df, names, keep=(ROW_ORD,)):
    d = _prep(df)
    return _final_select(sequential(_window_features(d, set(names)), set(names)), list(names), keep)


def historical_click(df):
    w = user_time().rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("historical_click", F.coalesce(F.sum(TARGET).over(w), F.lit(0)).cast("long"))


def historical_sessions(df):
    return df.withColumn("historical_sessions", (F.row_number().over(user_time()) - 1).cast("long"))


def time_since_prev(df):
    secs = (wall_micros("DateTime") - wall_micros(F.lag("DateTime").over(user_time()))) / 1e6
    return (df.withColumn("seconds_since_prev", secs)
              .withColumn("hours_since_prev", F.col("seconds_since_prev") / 3600.0))


def user_time():
    return Window.partitionBy("user_id").orderBy(F.col("DateTime").asc_nulls_last(), F.col(ROW_ORD))


def asof(external, internal, value, drop_last=False):
    """All internal rows strictly earlier, by a plain join (small frames)."""
    i = internal.where("DateTime is not null").select(
        F.col("user_id").alias("u"), F.col("DateTime").alias("t"), F.col(ROW_ORD).alias("o"), value.cast("long").alias("v"))
    e = external.select(ROW_ORD, "user_id", "DateTime")
    j = e.join(i, (F.col("u") == F.col("user_id")) & (F.col("t") < F.col("DateTime")), "left")
    last = F.coalesce(F.max_by("v", F.struct("t", "o")), F.lit(0)) if drop_last else F.lit(0)
    return j.groupBy(ROW_ORD).agg((F.coalesce(F.sum("v"), F.lit(0)) - last).cast("long").alias("asof"))
