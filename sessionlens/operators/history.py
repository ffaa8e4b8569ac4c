"""History features and analytic windows from the notebooks (rows 112-119)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.functions.scalars import epoch_seconds, wall_micros
from sessionlens.operators.ordering import DEFAULT_CHUNK, global_row_number, keyed_scan
from sessionlens.schema import ROW_ORD, TARGET


def _scanned(df: DataFrame, add, keep, values=(), **scan) -> DataFrame:
    """``add`` on a keyed scan of the user's rows in (time, row) order, over
    the scan's own columns and ``keep`` only. With ``keep`` these are the
    result; without it the new columns meet the whole rows by row id."""
    carried = list(dict.fromkeys(["user_id", "DateTime", ROW_ORD, *values, *(keep or ())]))
    out = add(keyed_scan(df.select(*carried), "user_id", ["DateTime", ROW_ORD], **scan))
    new = [c for c in out.columns if c not in carried]
    if keep is not None:
        return out.select(*keep, *new)
    new_only = out.select(F.col(ROW_ORD).alias("_row"), *new)
    return df.join(new_only, df[ROW_ORD] == new_only["_row"]).drop("_row")


def historical_click(df: DataFrame, keep=None) -> DataFrame:
    """Clicks of the user's earlier rows (time order, then row order)."""
    def add(s):
        return s.withColumn("historical_click", F.col(f"_sum_{TARGET}").cast("long")).drop(f"_sum_{TARGET}")
    return _scanned(df, add, keep, [TARGET], sum_cols=[TARGET])


def historical_sessions(df: DataFrame, keep=None) -> DataFrame:
    """Number of the user's earlier rows; the first is 0."""
    return _scanned(df, lambda s: s, keep, count_out="historical_sessions")


def product_viewed_before(df: DataFrame) -> DataFrame:
    """1 if the user saw the row's product in an earlier row (time order).

    The reference scans all earlier rows per row (O(n^2)); here it is the
    first occurrence of (user, product), an aggregate joined back."""
    okey = F.struct(F.col("DateTime").isNull(), F.col("DateTime"), F.col(ROW_ORD))
    first = (df.where(F.col("product").isNotNull())
               .groupBy("user_id", "product").agg(F.min(okey).alias("_first")))
    j = df.join(first, ["user_id", "product"], "left")
    return j.withColumn("product_viewed_before",
                        F.coalesce((okey != F.col("_first")).cast("int"), F.lit(0))).drop("_first")


def time_since_prev(df: DataFrame, keep=None) -> DataFrame:
    """Seconds and hours since the user's previous row in time order
    (hours = seconds / 3600; the reference divides by 360)."""
    secs = (wall_micros("DateTime") - wall_micros(F.col("_lag_DateTime"))) / 1e6

    def add(s):
        return (s.withColumn("seconds_since_prev", secs)
                 .withColumn("hours_since_prev", F.col("seconds_since_prev") / 3600.0).drop("_lag_DateTime"))
    return _scanned(df, add, keep, lag_cols=["DateTime"])


def recent_session_rows(df: DataFrame, within_hours: float = 1.0) -> DataFrame:
    """User, row id and target of the rows after the first of users with more
    than 2 rows, flagged ``had_recent_session`` when the user's previous row
    is at most ``within_hours`` earlier."""
    t = time_since_prev(df, keep=["user_id", ROW_ORD, TARGET]).where(F.col("hours_since_prev").isNotNull())
    busy = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 2)
    f = t.join(busy.select(F.col("user_id").alias("_busy")), F.col("user_id").eqNullSafe(F.col("_busy")), "left_semi")
    return f.withColumn("had_recent_session", (F.col("hours_since_prev") <= within_hours).cast("int"))


def recent_session_ctr(df: DataFrame, within_hours: float = 1.0) -> DataFrame:
    """CTR with and without a recent row (see ``recent_session_rows``) and
    the lift (with - without) / without."""
    f = recent_session_rows(df, within_hours)
    g = f.agg(F.avg(F.when(F.col("had_recent_session") == 1, F.col(TARGET))).alias("ctr_with_recent"),
              F.avg(F.when(F.col("had_recent_session") == 0, F.col(TARGET))).alias("ctr_without_recent"),
              F.count(F.lit(1)).alias("rows"))
    return g.withColumn("relative_lift", F.try_divide(F.col("ctr_with_recent") - F.col("ctr_without_recent"),
                                                      F.col("ctr_without_recent")))


def viewed_before_ctr(df: DataFrame) -> DataFrame:
    """Overall CTR, CTR when the product was / was not viewed before, and
    the lift (viewed - overall) / overall (sign as it should be)."""
    v = product_viewed_before(df)
    g = v.agg(F.avg(TARGET).alias("overall_ctr"),
              F.avg(F.when(F.col("product_viewed_before") == 1, F.col(TARGET))).alias("ctr_viewed_before"),
              F.avg(F.when(F.col("product_viewed_before") == 0, F.col(TARGET))).alias("ctr_not_viewed_before"))
    return g.withColumn("relative_lift", F.try_divide(
        F.col("ctr_viewed_before") - F.col("overall_ctr"), F.col("overall_ctr")))


def _halo_context(df: DataFrame, value: str, order_col: str, m: int, chunk_size: int):
    """Rows numbered 1..N in ``order_col`` order, chunked; each chunk gets
    copies of the ``m`` rows on either side so lag/lead up to ``m`` never
    leaves the chunk. Returns (frame, window)."""
    pos = global_row_number(df.select(order_col, value), order_col, "_pos", chunk_size)
    pos = pos.withColumn("_chunk", F.floor((F.col("_pos") - 1) / chunk_size).cast("long"))
    off = (F.col("_pos") - 1) % chunk_size
    own = pos.withColumn("_own", F.lit(True))
    prev_halo = pos.where(off < m).withColumn("_chunk", F.col("_chunk") - 1).withColumn("_own", F.lit(False))
    next_halo = pos.where(off >= chunk_size - m).withColumn("_chunk", F.col("_chunk") + 1) \
                   .withColumn("_own", F.lit(False))
    allrows = own.unionByName(prev_halo).unionByName(next_halo)
    return allrows, Window.partitionBy("_chunk").orderBy("_pos")


def diff_prev_nonnull(df: DataFrame, column: str = "DateTime", order_col: str = ROW_ORD,
                      chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """Epoch difference (seconds) to the previous non-null value in row
    order; 0 when there is none; null for null rows."""
    e = df.select(order_col, epoch_seconds(column).alias("_e"))
    nn = e.where(F.col("_e").isNotNull())
    # previous non-null = previous row among the non-null rows (global order)
    ctx, w = _halo_context(nn, "_e", order_col, 1, chunk_size)
    prev = ctx.withColumn("_prev", F.lag("_e").over(w)).where("_own")
    diffs = prev.select(order_col, F.coalesce(F.col("_e") - F.col("_prev"), F.lit(0.0)).alias("diff_prev_nonnull"))
    return (df.join(diffs, order_col, "left"))


def null_context(df: DataFrame, column: str = "DateTime", m: int = 5, order_col: str = ROW_ORD,
                 differences: bool = False, chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """For each row whose ``column`` is null: the epoch values of the ``m``
    rows before, itself and the ``m`` rows after (row order), as one array
    of 2m+1 (null outside the table); optionally successive differences."""
    e = df.select(order_col, epoch_seconds(column).alias("_e"))
    ctx, w = _halo_context(e, "_e", order_col, m, chunk_size)
    cells = ([F.lag("_e", k).over(w) for k in range(m, 0, -1)] + [F.col("_e")]
             + [F.lead("_e", k).over(w) for k in range(1, m + 1)])
    out = ctx.select(order_col, "_own", "_e", F.array(*cells).alias("context")).where(F.col("_own") & F.col("_e").isNull())
    if differences:
        out = out.withColumn("context", F.transform(
            F.sequence(F.lit(1), F.lit(2 * m + 1)),
            lambda i: F.when(i == 1, F.lit(0.0)).otherwise(
                F.element_at("context", i) - F.element_at("context", i - 1))))
    return out.select(order_col, "context")
