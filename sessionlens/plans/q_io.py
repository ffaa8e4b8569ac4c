"""Queries for sources and sinks (rows 1-8, 10) and the streaming hourly
table. Each sink query writes the session view to a fresh folder under
the shared checkpoint folder and returns what the matching reader reads
back, so the oracle compares the round trip with the source."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from sessionlens.operators import cleaning, setops
from sessionlens.plans.registry import narrow, register, wide
from sessionlens.session import scratch_path
from sessionlens.sources import io
from sessionlens.streaming.hourly import run_hourly_ctr

WIDE_COLS = ["session_id", "DateTime", "user_id", "product", "campaign_id", "webpage_id",
             "product_category_1", "product_category_2", "user_group_id", "gender", "age_level",
             "user_depth", "city_development_index", "var_1", "is_click", "score"]
_WIDE_NO_ORD = "SELECT * EXCLUDE (row_ord) FROM wide"


def _csv_roundtrip(spark, sf_dir):
    w = wide(spark, sf_dir)
    path = scratch_path(spark, "sessions-csv")
    w.drop("row_ord").write.option("header", True).csv(path)
    schema = w.drop("row_ord").schema
    return io.read_sessions(spark, path, fmt="csv", schema=schema)


@register("read_sessions", sql=_WIDE_NO_ORD)
def q_read_sessions(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir).drop("row_ord")


@register("read_sessions_nonempty", sql=_WIDE_NO_ORD)
def q_read_sessions_nonempty(spark, sf_dir):
    w = wide(spark, sf_dir)
    path = scratch_path(spark, "sessions-parquet")
    w.drop("row_ord").write.parquet(path)
    return io.read_sessions_nonempty(spark, path, fmt="parquet", schema=None).drop("row_ord")


@register("write_typed_split", sql="SELECT * FROM wide")
def q_write_typed_split(spark, sf_dir):
    path = scratch_path(spark, "split-csv")
    io.write_typed_split(wide(spark, sf_dir), path, fmt="csv")
    return io.read_typed_split(spark, path, fmt="csv")


@register("read_typed_split", sql="SELECT * FROM wide")
def q_read_typed_split(spark, sf_dir):
    path = scratch_path(spark, "split-parquet")
    io.write_typed_split(wide(spark, sf_dir), path, fmt="parquet")
    return io.read_typed_split(spark, path, fmt="parquet")


@register("write_features_labels", sql="SELECT row_ord, is_click FROM wide")
def q_write_features_labels(spark, sf_dir):
    path = scratch_path(spark, "test-set")
    io.write_features_labels(wide(spark, sf_dir), path, fmt="csv")
    feats = io.read_typed_features(spark, os.path.join(path, "features"), fmt="csv")
    labels = io.read_typed(spark, os.path.join(path, "labels"), fmt="csv")
    # both halves come back complete and keyed the same way
    return feats.select("row_ord").join(labels, "row_ord", "inner")


@register("read_typed_features", sql="SELECT * EXCLUDE (is_click) FROM wide")
def q_read_typed_features(spark, sf_dir):
    path = scratch_path(spark, "features")
    io.write_features_labels(wide(spark, sf_dir), path, fmt="parquet")
    return io.read_typed_features(spark, os.path.join(path, "features"))


@register("write_external_features", sql="SELECT * EXCLUDE (product_category_2, city_development_index), "
          "product_category_2 IS NOT NULL AS secondary_product_category_known, "
          "city_development_index IS NOT NULL AS city_development_index_known FROM wide")
def q_write_external_features(spark, sf_dir):
    path = scratch_path(spark, "external")
    io.write_external_features(cleaning.clean_inference(wide(spark, sf_dir)), path)
    return io.read_typed(spark, path)


@register("write_predictions", sql="SELECT score AS y_proba FROM wide")
def q_write_predictions(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    io.write_predictions(wide(spark, sf_dir).withColumnRenamed("score", "y_proba"), path, "y_proba")
    return io.read_predictions(spark, path, "y_proba")


@register("union_sources", sql="SELECT DISTINCT * EXCLUDE (row_ord) FROM (SELECT * FROM wide UNION ALL SELECT * FROM narrow)")
def q_union_sources(spark, sf_dir):
    return setops.union_sources(wide(spark, sf_dir), narrow(spark, sf_dir))


@register("hourly_ctr_stream", sql="""
  , d AS (SELECT * FROM wide WHERE "DateTime" IS NOT NULL AND is_click IS NOT NULL)
  SELECT date_trunc('hour', "DateTime") AS period, count(*) AS sessions, CAST(sum(is_click) AS BIGINT) AS clicks,
    CAST(sum(is_click) AS DOUBLE) / count(*) AS ctr FROM d
  WHERE date_trunc('hour', "DateTime") + INTERVAL 3 HOUR <= (SELECT max("DateTime") FROM d) GROUP BY 1""")
def q_hourly_ctr_stream(spark, sf_dir):
    src = scratch_path(spark, "stream-src")
    w = wide(spark, sf_dir)
    w.write.parquet(src)
    out = run_hourly_ctr(spark, src, spark.read.parquet(src).schema, scratch_path(spark, "stream-ckpt"),
                         "hourly_" + os.path.basename(src).replace("-", "_"), lateness="2 hours")
    return out.select(F.col("period").cast("timestamp_ntz").alias("period"), "sessions", "clicks", "ctr")
