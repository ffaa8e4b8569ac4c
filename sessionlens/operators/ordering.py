"""Order-dependent scans that stay distributed.

A window with no PARTITION BY runs in one task. These helpers number rows
and carry values along a global order in two levels instead: rows fall
into chunks of the order key; each chunk is scanned on its own (one task
per chunk), chunk summaries (one row per chunk) get a running total, and
the offsets join back. The summary table has rows / chunk_size rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.session import cut_lineage

DEFAULT_CHUNK = 1 << 20

def _chunk(order_col: str, chunk_size: int):
    return F.floor(F.col(order_col) / F.lit(chunk_size)).cast("bigint")


def global_row_number(df: DataFrame, order_col: str, out: str = "rn",
                      chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """1-based position of each row in ``order_col`` order (values unique)."""
    d = df.withColumn("_chunk", _chunk(order_col, chunk_size))
    local = d.withColumn("_local", F.row_number().over(
        Window.partitionBy("_chunk").orderBy(order_col)))
    sizes = d.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_chunk", (F.sum("_n").over(
        Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"))
    return (local.join(offsets, "_chunk", "left")
                 .withColumn(out, F.col("_local") + F.coalesce(F.col("_off"), F.lit(0)))
                 .drop("_chunk", "_local", "_off"))


def fill_forward(df: DataFrame, column: str, order_col: str, partition_cols=None,
                 chunk_size: int = DEFAULT_CHUNK, out: str | None = None) -> DataFrame:
    """Last non-null value at or before each row (pandas ``ffill``)."""
    return _fill(df, column, order_col, partition_cols, chunk_size, out or column, True)


def fill_backward(df: DataFrame, column: str, order_col: str, partition_cols=None,
                  chunk_size: int = DEFAULT_CHUNK, out: str | None = None) -> DataFrame:
    """Next non-null value at or after each row (pandas ``bfill``)."""
    return _fill(df, column, order_col, partition_cols, chunk_size, out or column, False)


def _fill(df, column, order_col, partition_cols, chunk_size, out, forward):
    # backward is forward in descending order: a frame that ends with the
    # partition would be scanned anew for every row
    order = F.col(order_col).asc() if forward else F.col(order_col).desc()
    keys = list(partition_cols or [])
    if keys:
        w = Window.partitionBy(*keys).orderBy(order)
        return df.withColumn(out, F.last(column, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = df.withColumn("_chunk", _chunk(order_col, chunk_size))
    local = F.last(column, ignorenulls=True).over(
        Window.partitionBy("_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    known = F.when(F.col(column).isNotNull(), F.col(order_col))
    edge = F.max_by(F.col(column), known) if forward else F.min_by(F.col(column), known)
    chunks = F.col("_chunk").asc() if forward else F.col("_chunk").desc()
    carry = F.last("_edge", ignorenulls=True).over(
        Window.orderBy(chunks).rowsBetween(Window.unboundedPreceding, -1))
    summary = (d.groupBy("_chunk").agg(edge.alias("_edge"))
                .select("_chunk", carry.alias("_carry")))
    return (d.withColumn("_local", local)
             .join(summary, "_chunk", "left")
             .withColumn(out, F.coalesce(F.col("_local"), F.col("_carry")))
             .drop("_chunk", "_local", "_carry"))


def exact_quantiles(counts: DataFrame, key: str, value: str, weight: str, quantiles) -> DataFrame:
    """(key, quantiles: array): interpolated quantiles of ``value``, each row
    counting ``weight`` times. Ranks come from a keyed scan of the values in
    order, so no task holds a key's values."""
    known = counts.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.sum(weight).alias("_w"))
    scan = keyed_scan(known, key, [value], sum_cols=["_w"])
    total = known.groupBy(key).agg(F.sum("_w").alias("_total")).withColumnRenamed(key, "_key")
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    at = total.select("_key", F.posexplode(F.transform(asked, lambda q: q * (F.col("_total") - 1))).alias("_i", "_at"))
    at = at.withColumn("_rank", F.explode(F.array(F.floor("_at"), F.ceil("_at"))))
    hit = scan.join(at, (F.col(key) == F.col("_key")) & (F.col("_rank") >= F.col("_sum__w"))
                    & (F.col("_rank") < F.col("_sum__w") + F.col("_w")))
    share = F.col("_at") - F.floor("_at")
    one = hit.groupBy(key, "_i").agg(  # the value below, moved by its share towards the value above
        (F.min(value) + (F.max(value) - F.min(value)) * F.first(share)).alias("_q"))
    return one.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_i", "_q"))).alias("_l")).select(
        key, F.transform("_l", lambda x: x["_q"]).alias("quantiles"))


def keyed_scan(df: DataFrame, key: str, order_cols, lag_cols=(), sum_cols=(), count_out: str | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """Per-key ordered scan that survives a key holding a third of the rows.

    ``order_cols`` (names, ascending, nulls last) must end in a unique
    tiebreaker. Adds ``_lag_<c>`` (``c`` on the key's previous row),
    ``_sum_<c>`` (sum of ``c`` over the key's earlier rows) and, with
    ``count_out``, the number of earlier rows of the key.

    A window ``partitionBy(key)`` sends every row of a key to one task. Here
    the rows are range-partitioned on (key, order): Spark samples the sort
    key, so a hot key spans several partitions. Each (partition, key) piece
    is scanned with a local window; a summary row per piece (its last values,
    totals and size) gets running offsets over the pieces of its key (a
    handful of rows per key) and joins back to stitch the piece borders.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(o).asc_nulls_last() for o in order_cols]
    # Range bounds are sampled from the input partitions in iteration order,
    # so a recomputation could move rows between pieces; the rows and their
    # piece ids are written once (reliable checkpoint) and both branches
    # below, and any retry, read the same assignment.
    r = cut_lineage(df.repartitionByRange(n, F.col(key).asc_nulls_last(), *sort)
                      .withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid", key).orderBy(*sort)
    local = [F.row_number().over(w).alias("_lrn")]
    local += [F.lag(c).over(w).alias(f"_llag_{c}") for c in lag_cols]
    local += [F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_lsum_{c}")
              for c in sum_cols]
    scanned = r.select("*", *local)
    # last row of a piece = max of (nulls-last order key, values)
    okey = [x for o in order_cols for x in (F.col(o).isNull().alias(f"n_{o}"), F.col(o).alias(f"o_{o}"))]
    aggs = [F.count(F.lit(1)).alias("_pn")] + [F.sum(c).alias(f"_pt_{c}") for c in sum_cols]
    if lag_cols:
        aggs.append(F.max(F.struct(*okey, *[F.col(c).alias(f"v_{c}") for c in lag_cols])).alias("_plast"))
    pieces = r.groupBy("_pid", key).agg(*aggs)
    wk = Window.partitionBy(key).orderBy("_pid")
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    carry = [F.coalesce(F.sum("_pn").over(before), F.lit(0)).alias("_off_n")]
    carry += [F.coalesce(F.sum(f"_pt_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols]
    carry += [F.lag(F.col("_plast")[f"v_{c}"]).over(wk).alias(f"_prev_{c}") for c in lag_cols]
    offsets = pieces.select(F.col("_pid").alias("_opid"), F.col(key).alias("_okey"), *carry)
    j = scanned.join(offsets, (F.col("_pid") == F.col("_opid")) & F.col(key).eqNullSafe(F.col("_okey")), "left")
    out = [F.col(c) for c in df.columns]
    out += [F.when(F.col("_lrn") == 1, F.col(f"_prev_{c}")).otherwise(F.col(f"_llag_{c}")).alias(f"_lag_{c}")
            for c in lag_cols]
    out += [(F.col(f"_off_{c}") + F.col(f"_lsum_{c}")).alias(f"_sum_{c}") for c in sum_cols]
    if count_out:
        out.append((F.col("_off_n") + F.col("_lrn") - 1).alias(count_out))
    return j.select(*out)
