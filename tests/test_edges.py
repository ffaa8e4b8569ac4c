"""Hand-made frames for the edges (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sessionlens.functions import scalars as S
from sessionlens.operators import cleaning, features, impute, metrics, ordering, setops

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("row_ord long, session_id long, DateTime timestamp_ntz, user_id long, product string, "
          "campaign_id long, webpage_id long, product_category long, user_group_id long, gender string, "
          "age_level long, user_depth long, var_1 long, is_click int, "
          "secondary_product_category_known boolean, city_development_index_known boolean")


def row(i, user, ts, product="A", camp=1, web=1, cat=1, var=0, click=0, **kw):
    base = dict(row_ord=i, session_id=i, DateTime=ts, user_id=user, product=product, campaign_id=camp,
                webpage_id=web, product_category=cat, user_group_id=1, gender="Male", age_level=2,
                user_depth=1, var_1=var, is_click=click, secondary_product_category_known=True,
                city_development_index_known=False)
    base.update(kw)
    return base


@pytest.fixture(scope="module")
def frame(spark):
    rows = [
        row(0, 1, T0.replace(hour=0), "A"),
        row(1, 1, T0.replace(hour=1), "A", var=1, secondary_product_category_known=False),
        row(2, 1, T0.replace(hour=8), "B"),
        # two rows, one timestamp, in reverse row order of appearance
        row(4, 1, T0.replace(hour=13), "C", camp=2, city_development_index_known=True),
        row(3, 1, T0.replace(hour=13), "C", camp=2),
        row(5, 1, T0.replace(hour=18), "A", click=1),
        row(6, 1, T0.replace(hour=21), "A"),
        row(7, 2, T0.replace(hour=6, minute=30), "D"),
        row(8, 2, T0.replace(hour=6, minute=31), "D"),
        row(9, 3, None, None),                       # null time and product
        row(10, None, T0.replace(hour=2), "E"),       # null user
        row(11, 4, T0.replace(hour=5), "F"),          # one-row user
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_time_of_day_bins(frame):
    got = {r.row_ord: r.t for r in frame.select("row_ord", S.time_of_day().alias("t")).collect()}
    assert got[0] == "Night" and got[1] == "Early Morning" and got[2] == "Morning"
    assert got[3] == "Afternoon" and got[5] == "Evening" and got[6] == "Night" and got[9] == "Unknown"


def test_early_morning_boundary(frame):
    got = {r.row_ord: r.e for r in frame.select("row_ord", S.early_morning().alias("e")).collect()}
    assert got[7] is True and got[8] is False and got[0] is False and got[11] is True


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (3,), (12,)], "x long")
    assert [r[0] for r in df.select(S.clip_upper("x", 10)).collect()] == [None, 3, 10]


def test_features_keep_rows_and_ranges(frame):
    out = features.prepare_features(frame).collect()
    assert len(out) == frame.count()
    timed = {r.row_ord for r in frame.where("DateTime IS NOT NULL").collect()}
    for r in out:
        assert 1 <= r.daily_sessions_count <= 10 or r.daily_sessions_count is None
        assert r.same_timestamp_session_count <= 6
        if r.row_ord in timed:
            # null-time groups are dropped from the max, as in the reference
            assert r.max_same_timestamp_session_count >= r.same_timestamp_session_count
        for c in ("has_viewed_category_before", "prev_session_same_product", "is_high_volume_user",
                  "session_mixed_var1", "user_uniform_var1", "excess_duplicate_timestamps"):
            assert getattr(r, c) in (0, 1)


def test_same_timestamp_features(frame):
    out = {r.row_ord: r for r in features.prepare_features(frame).collect()}
    # rows 3 and 4 share user 1 and 13:00; row 4 comes first in the file but
    # row 3 is first in (time, row order)
    assert out[3].same_timestamp_session_count == 2 and out[4].same_timestamp_session_count == 2
    assert out[3].session_mixed_city_development_index_known == 1
    assert out[3].has_viewed_campaign_before == 0 and out[4].has_viewed_campaign_before == 1
    assert out[3].duplicate_timestamp_session_count == 1
    assert out[11].total_active_days == 1 and out[11].same_timestamp_session_count == 1


def test_prev_same_product_ties_by_row_order(frame):
    out = {r.row_ord: r.prev_session_same_product for r in
           features.compute_features(frame, ["prev_session_same_product"]).collect()}
    assert out[0] == 0 and out[1] == 1 and out[2] == 0 and out[4] == 1


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "g string")
    assert impute.column_modes(df, ["g"]) == {"g": "a"}


def test_all_null_column_median_mode_zero(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "x long, y string")
    out = impute.fill_median_mode(df, ["x"], ["y"]).collect()
    assert all(r.x == 0 for r in out)


def test_new_ids_follow_row_order(spark):
    df = spark.createDataFrame([(0, 5), (1, None), (2, 7), (3, None)], "row_ord long, user_id long")
    got = {r.row_ord: r.user_id for r in impute.impute_user_id(df, chunk_size=2).collect()}
    assert got == {0: 5, 1: 8, 2: 7, 3: 9}


def test_global_row_number_across_chunks(spark):
    df = spark.range(0, 50).withColumnRenamed("id", "k").where("k % 3 != 0")
    got = [r.rn for r in ordering.global_row_number(df, "k", "rn", chunk_size=7).orderBy("k").collect()]
    assert got == list(range(1, len(got) + 1))


def test_ffill_bfill_across_chunks(spark):
    vals = [None, None, 3, None, None, None, 7, None]
    df = spark.createDataFrame(list(enumerate(vals)), "row_ord long, v long")
    got = [r.v for r in impute.ffill_bfill(df, "v", chunk_size=3).orderBy("row_ord").collect()]
    assert got == [3, 3, 3, 3, 3, 3, 7, 7]


def test_fills_scan_each_row_once(spark, capsys):
    """A frame that ends with its partition is scanned anew for every row."""
    df = spark.createDataFrame([(0, None, 1), (1, 5, 1), (2, None, 1)], "row_ord long, v long, k long")
    for keys, want in ((None, [5, 5, 5]), (["k"], [5, 5, 5])):
        filled = impute.ffill_bfill(df, "v", partition_cols=keys)
        assert [r.v for r in filled.orderBy("row_ord").collect()] == want
        filled.explain()
        assert "unboundedfollowing" not in capsys.readouterr().out.lower()


def test_drop_duplicates_keeps_first(spark):
    df = spark.createDataFrame([(0, "a", None), (1, "a", None), (2, "b", 1)], "row_ord long, x string, y long")
    assert sorted(r.row_ord for r in cleaning.drop_duplicates(df).collect()) == [0, 2]


def test_rows_only_once_and_dropped(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k long, v string")
    b = cleaning.dropna_any(a, ["v"])
    assert [r.k for r in setops.rows_only_once(a, b).collect()] == [2]
    assert [r.k for r in setops.dropped_rows(a, b).collect()] == [2]


def _scored(spark, rows):
    return spark.createDataFrame(rows, "y_true int, y_pred int, y_proba double")


def test_auc_ties_count_half(spark):
    s = _scored(spark, [(1, 1, 0.5), (0, 1, 0.5), (1, 1, 0.9), (0, 0, 0.1)])
    assert metrics.roc_auc(s).first().auc == pytest.approx(0.875)


def test_auc_symmetry(spark):
    rows = [(i % 2, 0, ((i * 37) % 11) / 10.0) for i in range(40)]
    s = _scored(spark, rows)
    flipped = s.withColumn("y_proba", 1 - F.col("y_proba"))
    a, b = metrics.roc_auc(s).first().auc, metrics.roc_auc(flipped).first().auc
    assert a + b == pytest.approx(1.0)


def test_auc_one_class_is_null(spark):
    assert metrics.roc_auc(_scored(spark, [(1, 1, 0.3), (1, 0, 0.2)])).first().auc is None


def test_no_positive_prediction_gives_zero(spark):
    m = metrics.label_metrics(_scored(spark, [(1, 0, 0.1), (0, 0, 0.2)])).first()
    assert m.precision == 0.0 and m.f1 == 0.0 and m.mcc == 0.0


def test_fbeta_and_bacc(spark):
    m = metrics.label_metrics(_scored(spark, [(1, 1, .9), (1, 0, .1), (0, 1, .8), (0, 0, .2), (0, 0, .3)]),
                              beta=2.0).first()
    assert m.fbeta == pytest.approx(5 * 1 / (5 * 1 + 4 * 1 + 1))
    assert m.bacc == pytest.approx((0.5 + 2 / 3) / 2) and m.aba == pytest.approx(2 * m.bacc - 1)


def _hot_user_frame(spark):
    from conftest import SF_SMALL
    from sessionlens.plans.registry import wide
    d = cleaning.clean_inference(wide(spark, SF_SMALL))
    # one user holds a third of all rows (a bot) on top of the normal users
    return d.withColumn("user_id", F.when(F.col("row_ord") % 3 == 0, F.lit(999999)).otherwise(F.col("user_id")))


def test_history_equals_windows_with_a_hot_user(spark):
    import window_reference
    from sessionlens.operators import history
    d = _hot_user_frame(spark)
    for name in ("historical_click", "historical_sessions", "time_since_prev"):
        a, b = getattr(window_reference, name)(d), getattr(history, name)(d)
        assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count(), name


def test_keyed_scan_splits_hot_key(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("row_ord"),
                                     F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id") % 40).alias("k"))
    r = df.repartitionByRange(6, "k", "row_ord").withColumn("p", F.spark_partition_id())
    assert r.where("k = 1").select("p").distinct().count() > 1
    got = ordering.keyed_scan(df, "k", ["row_ord"], count_out="n", num_partitions=6)
    from pyspark.sql import Window
    exp = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("row_ord")) - 1)
    assert got.exceptAll(exp).count() == 0


@pytest.mark.parametrize("which", ["edge", "wide", "narrow", "hot"])
def test_features_equal_windows(spark, frame, which):
    import window_reference
    from conftest import SF_SMALL
    from sessionlens.plans.registry import narrow, wide
    d = {"edge": lambda: frame, "wide": lambda: cleaning.clean_inference(wide(spark, SF_SMALL)),
         "narrow": lambda: cleaning.clean_inference(narrow(spark, SF_SMALL)),
         "hot": lambda: _hot_user_frame(spark)}[which]()
    names = features.FEATURE_NAMES + ["daily_session_sequence", "has_viewed_product_before"]
    a = features.compute_features(d, names).cache()
    b = window_reference.compute_features(d, names).cache()
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_asof_equals_plain_join_with_a_hot_user(spark):
    import window_reference
    from sessionlens.operators import joins
    d = _hot_user_frame(spark)
    for drop_last in (False, True):
        a = joins.asof_clicks(d, d, drop_last=drop_last).select("row_ord", "historical_click")
        b = window_reference.asof(d, d, F.col("is_click"), drop_last)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, drop_last
    a = joins.asof_sessions(d, d).select("row_ord", "sessions")
    b = (window_reference.asof(d, d, F.lit(1)).join(window_reference.historical_sessions(d), "row_ord")
         .select("row_ord", F.col("asof") + F.col("historical_sessions")))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_wall_micros_exact_across_dst_in_any_session_zone(spark):
    import calendar
    walls = [dt.datetime(2024, 11, 3, h, m, 0, 123456) for h in (0, 1, 4, 5, 6) for m in (0, 30)]
    walls += [dt.datetime(2024, 3, 10, h, 30) for h in (1, 2, 3, 7)]
    df = spark.createDataFrame([(w,) for w in walls], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r[0] for r in df.select(S.wall_micros("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    want = [calendar.timegm(w.timetuple()) * 1_000_000 + w.microsecond for w in walls]
    assert got == want


def test_feature_plan_parses_the_input_once(spark, capsys):
    """The joins read stored columns, not the session view again."""
    from conftest import SF_SMALL
    from sessionlens.plans.q_features import feature_input
    features.prepare_features(feature_input(spark, SF_SMALL)).explain()
    plan = capsys.readouterr().out
    assert "_nu_prod_ut" in plan and "get_json_object" not in plan
