"""Readers, splits and metrics on inputs that once lost rows or raised."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sessionlens.operators import cleaning, encode, history, metrics, models, profile, splits, stats
from sessionlens.schema import SESSION_SCHEMA
from sessionlens.sources import io

HEADER = ",".join(SESSION_SCHEMA.names)


def _line(session="1", time="2017-07-02 00:00:00", user="858557.0", rest="359520.0,13787,4,,10.0,Female,4.0,3,3.0,0,0.0"):
    return f"{session},{time},{user},C,{rest}"


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")


def test_float_text_is_read(spark, tmp_path):
    _write(f"{tmp_path}/a/x.csv", [_line("140690.0"), _line("", "bad time", " ")])
    a, b = io.read_sessions(spark, f"{tmp_path}/a").orderBy("row_ord").collect()
    assert (a.session_id, a.user_id, a.campaign_id, a.product_category_2, a.is_click) == (140690, 858557, 359520, None, 0)
    assert a.DateTime == dt.datetime(2017, 7, 2)
    assert (b.session_id, b.user_id, b.DateTime) == (None, None, None)


@pytest.mark.parametrize("bad", ["12.5", "x1", "99999999999999999999"])
def test_other_text_raises(spark, tmp_path, bad):
    _write(f"{tmp_path}/a/x.csv", [_line(bad)])
    with pytest.raises(Exception, match="not a whole number"):
        io.read_sessions(spark, f"{tmp_path}/a").collect()


def test_wall_time_inside_a_dst_gap(spark, tmp_path):
    _write(f"{tmp_path}/a/x.csv", [_line(time="2024-03-10 02:30:00")])
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert io.read_sessions(spark, f"{tmp_path}/a").first().DateTime == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_row_order_follows_files_and_blocks(spark, tmp_path):
    sizes = [3, 400, 27, 1]
    n = 0
    for k, size in enumerate(sizes):
        _write(f"{tmp_path}/a/part-{k}.csv", [_line(str(n + i)) for i in range(size)])
        n += size
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")  # several blocks a file
    try:
        rows = io.read_sessions(spark, f"{tmp_path}/a").select("session_id", "row_ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.session_id, r.row_ord) for r in rows) == [(i, i) for i in range(n)]


def _users(spark):
    # user u has u % 4 + 1 rows; every third user has only null targets
    rows = [(100 * u + k, u, dt.datetime(2020, 1, 1), "A" if u % 2 else "B", None if u % 3 == 0 else k % 2, 10 * u + k)
            for u in range(60) for k in range(u % 4 + 1)]
    return spark.createDataFrame(rows, "session_id long, user_id long, DateTime timestamp_ntz, product string, is_click int, row_ord long")


def test_splits_keep_users_without_targets(spark):
    d = _users(spark)
    n = d.count()
    assert splits.split_by_user(d).count() == n
    assert splits.leave_one_product_out(d, leave_out=False).count() == n
    assert splits.split_common_rare(d).count() == n
    assert splits.split_stratified_rows(d).count() == n
    assert splits.holdout_split(d).count() == n and splits.kfold(d).count() == n
    s = splits.split_stats(splits.split_by_user(d))
    assert s.agg(F.sum("rows")).first()[0] == n and s.agg(F.sum("pct_rows")).first()[0] == pytest.approx(100)


def test_cast_is_64_bit(spark):
    d = spark.createDataFrame([(3e9,), (-2.7,), (None,)], "x double")
    assert [r.x for r in cleaning.cast_float_to_int(d).collect()] == [3_000_000_000, -2, None]


def test_scores_without_positives_are_null(spark):
    d = spark.createDataFrame([(0, 0, 0.1), (0, 1, 0.7)], "y_true int, y_pred int, y_proba double")
    assert metrics.auprc(d).first().auprc is None
    assert metrics.average_precision(d).first().ap_lift is None
    empty = d.filter("false")
    assert metrics.roc_auc(empty).first().auc is None and metrics.auprc(empty).first().auprc is None


def test_concentrated_scores_spread_over_tasks(spark):
    d = spark.range(4000).select((F.col("id") % 2).cast("int").alias("y_true"), F.lit(0).alias("y_pred"),
                                 F.when(F.col("id") == 0, 1e9).otherwise(F.col("id") / 1e6).alias("y_proba"))
    got = metrics.cumulative_by_value(metrics.score_counts(d), "y_proba", ["neg"]).collect()
    below = 0
    for r in sorted(got, key=lambda r: r.y_proba):
        assert r._below_neg == below
        below += r.neg


def test_ratios_with_empty_sides_are_null(spark):
    d = _users(spark)
    none = d.withColumn("is_click", F.lit(0))
    assert models.class_ratio(none).first().neg_pos_ratio is None
    assert history.viewed_before_ctr(none).first().relative_lift is None
    assert history.recent_session_ctr(none).first().relative_lift is None
    assert profile.cleaning_loss(d.withColumn("x", F.lit(None).cast("int")), d.withColumn("x", F.lit(None).cast("int")), ["x"]).count() == 2
    line = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "a double, b double")
    assert stats.pearson(line, "a", "b").first().r == pytest.approx(1)


def test_many_levels_become_columns(spark):
    d = spark.range(12).withColumn("v", F.concat(F.lit("l"), F.col("id").cast("string")))
    assert len(encode.dummies(d, "v").columns) == 14
    with pytest.raises(ValueError):
        encode.dummies(d, "v", max_levels=11)


def test_incomplete_beta_identities():
    i = stats.incomplete_beta
    assert i(1, 3.5, 0.3) == pytest.approx(1 - 0.7 ** 3.5, rel=1e-13)
    assert i(2.5, 1, 0.3) == pytest.approx(0.3 ** 2.5, rel=1e-13)
    assert i(7, 7, 0.5) == pytest.approx(0.5, rel=1e-13)
    for a, b, x in [(0.5, 3, 0.2), (40, 0.5, 0.97), (3, 9, 0.6)]:
        assert i(a, b, x) + i(b, a, 1 - x) == pytest.approx(1, rel=1e-12)


def test_checkpoint_folder_is_required_on_a_cluster():
    from sessionlens.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_exact_quantiles_match_sorted_rows(spark):
    import numpy as np

    from sessionlens.operators.ordering import exact_quantiles
    rows = [(k, float((7 * i * i) % 31), 1 + i % 3) for k in ("a", "b") for i in range(40)] + [("c", 5.0, 1), ("d", None, 2)]
    got = {r.k: r.quantiles for r in exact_quantiles(
        spark.createDataFrame(rows, "k string, x double, n int"), "k", "x", "n", [0.25, 0.5, 0.9]).collect()}
    for k in ("a", "b", "c"):
        values = np.repeat([x for j, x, _ in rows if j == k], [n for j, _, n in rows if j == k])
        assert got[k] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.9]).tolist())
    assert "d" not in got
