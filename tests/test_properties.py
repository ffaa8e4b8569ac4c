"""Properties of splits, samples and features on the smoke data."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sessionlens.operators import splits, stats
from sessionlens.plans.registry import narrow, wide


def test_user_split_disjoint_and_complete(spark):
    n = narrow(spark, SF_SMALL)
    s = splits.split_by_user(n)
    assert s.count() == n.where(F.col("user_id").isNotNull()).count()
    per_user = s.groupBy("user_id").agg(F.count_distinct("split").alias("k"))
    assert per_user.where("k > 1").count() == 0


def test_user_split_group_sizes_follow_rounding(spark):
    n = narrow(spark, SF_SMALL)
    users = splits.assign_user_splits(n)
    counts = {r.split: r["count"] for r in users.groupBy("split").count().collect()}
    total = sum(counts.values())
    assert abs(counts.get("train", 0) - 0.6 * total) <= 10
    assert counts.get("val", 0) > 0 and counts.get("test", 0) > 0


def test_leave_one_product_out_removes_product_from_train(spark):
    s = splits.leave_one_product_out(narrow(spark, SF_SMALL))
    assert s.where((F.col("split") == "train") & (F.col("product") == "A")).count() == 0
    splits.assert_split_integrity(s)


def test_kfold_sizes(spark):
    w = wide(spark, SF_SMALL)
    n = w.count()
    sizes = sorted(r["count"] for r in splits.kfold(w, 5).groupBy("fold").count().collect())
    assert sum(sizes) == n and sizes[-1] - sizes[0] <= 1


def test_balanced_samples_ratio(spark):
    w = wide(spark, SF_SMALL)
    clicks = w.where("is_click = 1").count()
    rep = {(r.sample_id, r.is_click): r.rows for r in splits.balance_report(splits.balanced_samples(w, 2, 2)).collect()}
    assert rep[(0, 1)] == clicks and rep[(0, 0)] == min(2 * clicks, w.where("is_click = 0").count())


def test_chi_square_p_value(spark):
    df = spark.createDataFrame([(0, 0)] * 30 + [(0, 1)] * 10 + [(1, 0)] * 10 + [(1, 1)] * 30, "a int, b int")
    chi2, p = stats.chi_square_test(df, "a", "b")
    # Yates-corrected chi-square of [[30, 10], [10, 30]]
    assert abs(chi2 - 18.05) < 1e-9 and 0 < p < 1e-4


def test_pearson_p_value(spark):
    df = spark.createDataFrame([(float(i), float(i) * 2 + (i % 3)) for i in range(20)], "x double, y double")
    r, p = stats.pearson_test(df, "x", "y")
    assert r > 0.99 and p < 1e-10
