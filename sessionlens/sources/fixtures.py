"""Session views derived from the driver's ``events`` table.

The engine's input is a flat table of ad sessions. The test data has no
such table, so two views build one from ``events`` (see FIXTURES.md):

* ``sessions_wide``: user = ``events.user_id``; few users, many rows each.
* ``sessions_narrow``: user = ``event_id // 3``; many users, three rows each.

Both are plain projections of one Parquet scan, so filters and column
pruning of any query on top reach the scan. ``SQL_WIDE`` / ``SQL_NARROW``
give the same views for DuckDB (the correctness oracle).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

_USER_WIDE = "user_id"
_USER_NARROW_SPARK = "CAST(floor(event_id / 3) AS BIGINT)"
_USER_NARROW_DUCK = "CAST(floor(event_id // 3) AS BIGINT)"


def _columns(user: str, bucket: str, quote: str) -> list[str]:
    return [
        "event_id AS row_ord",
        "event_id AS session_id",
        f"{bucket} AS {quote}DateTime{quote}",
        f"{user} AS user_id",
        "chr(CAST(65 + k % 10 AS INT)) AS product",
        "event_id % 10 AS campaign_id",
        "(event_id + k) % 9 AS webpage_id",
        "k % 5 + 1 AS product_category_1",
        "CASE WHEN k % 4 = 0 THEN k % 3 + 1 END AS product_category_2",
        f"{user} % 13 AS user_group_id",
        f"CASE WHEN event_id % 37 = 0 THEN NULL WHEN {user} % 2 = 0 THEN 'Male' "
        "ELSE 'Female' END AS gender",
        f"{user} % 7 AS age_level",
        f"{user} % 3 + 1 AS user_depth",
        f"CASE WHEN event_id % 3 = 0 THEN NULL ELSE {user} % 4 + 1 END "
        "AS city_development_index",
        f"CASE WHEN {user} % 5 = 0 THEN 0 ELSE event_id % 2 END AS var_1",
        "CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS is_click",
        "CAST(CAST(floor(value) AS BIGINT) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS score",
    ]


_SPARK_BUCKET = "ts - make_dt_interval(0, 0, minute(ts) % 15, extract(SECOND FROM ts))"
_SPARK_K = "CAST(get_json_object(props, '$.k') AS BIGINT)"
_DUCK_BUCKET = "time_bucket(INTERVAL 15 MINUTE, ts)"
_DUCK_K = "CAST(json_extract(props, '$.k') AS BIGINT)"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _view(spark: SparkSession, sf_dir: str, user: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").selectExpr("*", f"{_SPARK_K} AS k")
    return ev.selectExpr(*_columns(user, _SPARK_BUCKET, "`"))


def sessions_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, _USER_WIDE)


def sessions_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, _USER_NARROW_SPARK)


def _duck_view(user: str) -> str:
    cols = ",\n  ".join(_columns(user, _DUCK_BUCKET, '"'))
    return f"SELECT {cols}\nFROM (SELECT *, {_DUCK_K} AS k FROM events) e"


SQL_WIDE = _duck_view(_USER_WIDE)
SQL_NARROW = _duck_view(_USER_NARROW_DUCK)


def with_views(sql: str) -> str:
    """Prefix a DuckDB query with the two session views as CTEs."""
    return f"WITH wide AS ({SQL_WIDE}),\nnarrow AS ({SQL_NARROW})\n{sql}"
