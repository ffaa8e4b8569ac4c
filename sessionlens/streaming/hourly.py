"""Hourly click rate over a stream of session files (the streaming form of
inventory row 121).

The reference only reads whole files. With sessions arriving as files in a
folder, the same hourly table is a Structured Streaming job: a watermark
on ``DateTime`` bounds the state, and a one-hour tumbling window emits
each hour once it can no longer change (append mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.schema import TARGET


def hourly_ctr_stream(stream: DataFrame, lateness: str = "2 hours", ts: str = "DateTime") -> DataFrame:
    """Streaming DataFrame -> (period, sessions, clicks, ctr) per hour."""
    s = stream.where(F.col(ts).isNotNull() & F.col(TARGET).isNotNull())
    if not isinstance(s.schema[ts].dataType, T.TimestampType):
        s = s.withColumn(ts, F.col(ts).cast("timestamp"))
    g = (s.withWatermark(ts, lateness)
          .groupBy(F.window(ts, "1 hour").alias("w"))
          .agg(F.count(F.lit(1)).alias("sessions"), F.sum(TARGET).cast("long").alias("clicks")))
    return g.select(F.col("w.start").alias("period"), "sessions", "clicks",
                    (F.col("clicks") / F.col("sessions")).alias("ctr"))


# The state holds one row per hour not yet closed by the watermark, whatever
# the input volume (partial aggregation runs before the shuffle), so a few
# state partitions suffice. The number is fixed into the checkpoint at the
# first run, so it is chosen here rather than inherited.
STATE_PARTITIONS = 8


def run_hourly_ctr(spark: SparkSession, source_dir: str, schema: T.StructType, checkpoint: str,
                   query_name: str, lateness: str = "2 hours",
                   state_partitions: int = STATE_PARTITIONS) -> DataFrame:
    """Process every file now in ``source_dir`` (``availableNow``), append
    the closed hours to an in-memory table and return it. The checkpoint
    folder makes the query restartable. The query runs in a session clone
    (same SparkContext, own SQL settings) so the caller's settings stay as
    they are; the clone works in UTC, so the hour windows of naive wall
    times are wall-clock hours whatever the caller's time zone."""
    spark = spark.newSession()
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    stream = spark.readStream.schema(schema).parquet(source_dir)
    q = (hourly_ctr_stream(stream, lateness).writeStream.outputMode("append").format("memory")
         .queryName(query_name).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(query_name)
