"""Distinct sketches and the outcome batch against exact counts."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sessionlens.operators import profile, sketches, timeseries
from sessionlens.sources.fixtures import sessions_narrow


def _rows(spark, n_users):
    """A level ``hot`` that every user has on two days, ``rare`` with every 1000th; nulls in each column."""
    d = spark.range(n_users).select(
        F.col("id").alias("user_id"), F.explode(F.array(F.lit("2020-01-01"), F.lit("2020-01-02"), F.lit(None))).alias("t"))
    d = d.select("user_id", F.to_timestamp("t").alias("DateTime"), F.lit("hot").alias("a"),
                 F.when(F.col("user_id") % 1000 == 0, F.lit(7)).alias("b"))
    return d.unionByName(spark.createDataFrame([(None, None, "hot", 7)], "user_id long, DateTime timestamp, a string, b int"))


def test_estimates_keep_to_the_bound(spark):
    d = _rows(spark, 50_000)
    days = sketches.level_sketches(d, ["a", "b"])
    assert days.groupBy("day").count().count() == 3
    got = {(r.feature, r.level): r.n_distinct for r in sketches.distinct(sketches.merged(days, "feature", "level")).collect()}
    assert got.keys() == {("a", "hot"), ("b", "7")}
    for key, exact in ((("a", "hot"), 50_000), (("b", "7"), 50)):
        assert got[key] == pytest.approx(exact, rel=sketches.error_bound())
    assert got["b", "7"] == 50  # few values are counted exactly


def test_union_of_days_is_the_sketch_of_all(spark):
    """Users seen on several days count once."""
    d = _rows(spark, 20_000)
    by_day = {r.day: r.n_distinct for r in sketches.distinct(sketches.merged(sketches.level_sketches(d, ["a"]), "day")).collect()}
    whole = sketches.distinct(sketches.merged(sketches.column_sketches(d, ["user_id", "b"]), "column_name")).collect()
    assert len(by_day) == 3 and all(n == pytest.approx(20_000, rel=sketches.error_bound()) for n in by_day.values())
    assert {r.column_name: r.n_distinct for r in whole} == {
        "user_id": pytest.approx(20_000, rel=sketches.error_bound()), "b": 1}


def test_wrong_estimates_leave_the_bound(spark):
    d = spark.createDataFrame([(100, 100), (100, 110), (100, 90), (3, 4), (3, 5), (0, 0)], "exact long, estimate long")
    assert [r[0] for r in d.select(sketches.within("estimate", "exact")).collect()] == [True, False, False, True, False, True]


def test_empty(spark):
    d = _rows(spark, 10).limit(0)
    assert sketches.merged(sketches.level_sketches(d, ["a", "b"]), "feature", "level").count() == 0
    assert sketches.column_sketches(d, ["a", "b"]).count() == 0
    assert profile.outcome_batch_top(profile.outcome_batch(d.withColumns({"campaign_id": F.lit(1), "is_click": F.lit(1)}), ["a"])).count() == 0


def test_sets_share_one_scan(spark):
    d = sessions_narrow(spark, SF_SMALL)
    for frame in (profile.users_per_level(d, ["product", "gender"]), profile.outcome_batch(d, ["product", "gender"]),
                  sketches.level_sketches(d, ["product", "gender"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Expand" in plan


def test_hourly_scans_once(spark):
    for frame in (timeseries.hourly_ctr, timeseries.daily_ctr):
        plan = frame(sessions_narrow(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Join" not in plan


def test_hours_between(spark):
    d = spark.createDataFrame([("2020-01-01 22:10:00", 1), ("2020-01-01 22:50:00", 0), ("2020-01-02 01:00:00", 0),
                               (None, 1), ("2020-01-09 00:00:00", None)], "t string, is_click long")
    d = d.select(F.to_timestamp("t").alias("DateTime"), "is_click")
    got = sorted((str(r.period), r.sessions, r.clicks, r.ctr) for r in timeseries.hourly_ctr(d).collect())
    assert got == [("2020-01-01 22:00:00", 2, 1, 0.5), ("2020-01-01 23:00:00", 0, 0, None),
                   ("2020-01-02 00:00:00", 0, 0, None), ("2020-01-02 01:00:00", 1, 0, 0.0)]
    assert sorted((str(r.day), r.ctr) for r in timeseries.daily_ctr(d).collect()) == [("2020-01-01", 0.5), ("2020-01-02", 0.0)]
    assert timeseries.hourly_ctr(d.limit(0)).count() == 0


def test_batch_nulls_and_ties(spark):
    rows = [("x", 1, 1, 1), ("x", 1, 1, 0), ("y", 1, 1, 1), ("y", 1, 2, 0), (None, 1, 1, 1), ("z", None, 1, 1),
            ("z", None, None, 1), ("z", 2, 1, None), ("w", 2, 2, 1)]
    d = spark.createDataFrame(rows, "a string, b long, campaign_id long, is_click long")
    batch = profile.outcome_batch(d, ["a", "b"])
    got = {(r.outcome, r.feature, r.level, r.campaign_id): (r.value, r.sessions_number) for r in batch.collect()}
    assert got["click_rate", "a", "x", 1] == (0.5, 2) and got["sessions_num", "b", "1", 1] == (4.0, 4)
    assert not any(k[2] is None or k[3] is None for k in got) and len(got) == 3 * (5 + 3)
    top = profile.outcome_batch_top(batch, 2).where("outcome = 'click_rate' AND feature = 'a'").orderBy("rank").collect()
    assert [(r.level, r.campaign_id, r["rank"]) for r in top] == [("w", 2, 1), ("y", 1, 2)]
    wide = {(r.outcome, r.feature, r.level): (r["1"], r["2"]) for r in profile.outcome_batch_pivot(batch).collect()}
    assert wide["click_rate", "a", "y"] == (1.0, 0.0) and wide["click_num", "b", "2"] == (0.0, 1.0)
