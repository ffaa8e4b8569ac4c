"""Ordered target statistics, ML stages that save and load, and the search."""

import random

import duckdb
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sessionlens.operators import models, search
from sessionlens.operators.target_stats import OrderedTargetEncoder, OrderedTargetModel
from sessionlens.plans import q_models
from sessionlens.plans.registry import wide
from sessionlens.session import scratch_path


def _rows(n=300):
    r = random.Random(3)
    return [(i, r.choice(["hot"] * 3 + ["a", "b", None]), r.choice([1, 2, None]), r.choice([0, 0, 1])) for i in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "row_ord long, color string, size int, is_click int").repartition(5)


def _encoder(**kw):
    return OrderedTargetEncoder(inputCols=["color", "size"], outputCols=["color_ts", "size_ts"], **kw)


def test_a_row_sees_earlier_rows_only(spark):
    import hashlib
    rows = _rows()
    got = {r.row_ord: r for r in _encoder(prior=0.25, weight=2.0).ordered(_frame(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: (hashlib.md5(f"42|{r[0]}".encode()).hexdigest(), r[0]))
    seen = {}
    for i, *cats, y in order:
        for name, c in zip(("color_ts", "size_ts"), cats):
            n, k = seen.get((name, c), (0, 0))
            assert got[i][name] == pytest.approx((k + 0.5) / (n + 2), abs=1e-12)
            seen[name, c] = (n + 1, k + y)
    # another label of its own changes no row's own value
    flipped = [(i, c, s, 1 - y if i == 7 else y) for i, c, s, y in rows]
    again = {r.row_ord: r for r in _encoder(prior=0.25, weight=2.0).ordered(_frame(spark, flipped)).collect()}
    assert again[7].color_ts == got[7].color_ts and again[7].size_ts == got[7].size_ts


def test_new_rows_see_whole_categories_and_the_model_loads(spark, monkeypatch):
    df = _frame(spark, _rows())
    model = _encoder().fit(df)
    path = scratch_path(spark, "ts")
    model.write().overwrite().save(path)
    new = spark.createDataFrame([(1, "hot", 9), (2, "never", 1), (3, None, None)], "row_ord long, color string, size int")
    n, k = df.where("color = 'hot'").agg(F.count("*"), F.sum("is_click")).first()
    n0, k0 = df.where("color IS NULL").agg(F.count("*"), F.sum("is_click")).first()
    exp = {1: (k + 0.5) / (n + 1), 2: 0.5, 3: (k0 + 0.5) / (n0 + 1)}
    from sessionlens.operators import target_stats
    for most in (1 << 16, 0):  # broadcast and shuffled categories
        monkeypatch.setattr(target_stats, "BROADCAST_LEVELS", most)
        for m in (model, OrderedTargetModel.load(path)):
            got = {r.row_ord: r for r in m.transform(new).collect()}
            assert {i: r.color_ts for i, r in got.items()} == pytest.approx(exp)
            assert got[1].size_ts == 0.5


def test_hot_category_is_spread_over_tasks(spark):
    df = spark.range(4000).select(F.col("id").alias("row_ord"), F.lit("hot").alias("color"), F.lit(1).alias("size"),
                                  (F.col("id") % 3 == 0).cast("int").alias("is_click"))
    from sessionlens.operators.ordering import keyed_scan
    enc = _encoder()
    cells = enc._long(df, "row_ord").withColumn("_key", F.struct("_c", "_v"))
    scan = keyed_scan(cells.drop("_v"), "_key", ["row_ord"], count_out="_before").withColumn("p", F.spark_partition_id())
    assert scan.groupBy("_c").agg(F.max("_before").alias("m")).agg(F.min("m")).first()[0] == 3999
    assert enc.ordered(df).count() == 4000


@pytest.mark.parametrize("at_once", ["7", "10000"])
def test_spans_and_scans_agree(spark, monkeypatch, at_once):
    """Columns of few levels take no unpivoted scan; repeated and null ids
    come out as they do from the scan."""
    from sessionlens.operators import target_stats
    rows = _rows() + _rows(40) + [(None, "hot", 1, 1)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", at_once)
    try:
        scan = target_stats.keyed_scan
        monkeypatch.setattr(target_stats, "keyed_scan", lambda *a, **kw: pytest.fail("unpivoted"))
        counted = sorted(map(tuple, _encoder().ordered(_frame(spark, rows)).collect()), key=repr)
        monkeypatch.setattr(target_stats, "keyed_scan", scan)
        monkeypatch.setattr(target_stats, "SPAN_COUNTS", 0)
        assert counted == sorted(map(tuple, _encoder().ordered(_frame(spark, rows)).collect()), key=repr)
        assert len(counted) == 340
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_few_levels_are_looked_up_without_joins(spark, capsys):
    from sessionlens.operators import encode
    df = _frame(spark, _rows())
    _encoder().fit(df).transform(df).explain()
    encode.one_hot_pipeline(["color"]).fit(df).transform(df).explain()
    assert "Join" not in capsys.readouterr().out


def test_empty_training_frame_encodes_to_nothing(spark):
    enc = _encoder()
    model, rows = enc.fit_ordered(_frame(spark, []))
    assert rows.collect() == []
    assert [r.color_ts for r in model.transform(_frame(spark, _rows(3))).collect()] == [0.5] * 3


@pytest.fixture(scope="module")
def train(spark):
    return q_models._train_test(spark, SF_SMALL)[0]


SMALL = {"numTrees": 3, "maxDepth": 3}


def test_stacked_stage_fits_saves_and_scores_inside_a_pipeline(spark):
    raw = wide(spark, SF_SMALL)
    from sessionlens.operators import cleaning
    sessions = cleaning.clean_inference(raw)
    pipe = Pipeline(stages=[models.SessionFeatures(),
                            models.StackedClassifier(models.model_choice("gbt", maxIter=2, maxDepth=3), meta_params=SMALL)])
    path = scratch_path(spark, "pipe")
    pipe.write().overwrite().save(path)
    again = Pipeline.load(path)
    stage = again.getStages()[1]
    assert stage.base_estimator.getMaxIter() == 2 and stage.getOrDefault(stage.metaParams) == '{"numTrees": 3, "maxDepth": 3}'
    fitted = again.fit(sessions)
    saved = scratch_path(spark, "fitted")
    fitted.write().overwrite().save(saved)
    cols = ["row_ord", "y_pred_prob", "prediction"]
    a, b = (m.transform(sessions).select(*cols) for m in (fitted, PipelineModel.load(saved)))
    assert a.exceptAll(b).count() == 0 and a.count() == sessions.count()


def test_out_of_fold_scores(train):
    folded = train.drop("is_validation").withColumn("fold", F.col("row_ord") % 2)
    est = models.StackedClassifier(models.model_choice("decision_tree", maxDepth=3), meta_params=SMALL, fold_col="fold")
    assert est.fit(folded).transform(folded.drop("fold")).where("y_pred_prob IS NULL").count() == 0


def test_validation_rows_train_nothing(train):
    """Other labels on validation rows change neither categories nor a tree."""
    clf = models.base_pipeline(models.model_choice("decision_tree", maxDepth=4), validation_col="is_validation")
    other = train.withColumn("is_click", F.when(F.col("is_validation"), 1 - F.col("is_click")).otherwise(F.col("is_click")))
    a, b = (clf.fit(t).stages[-1].toDebugString.split("\n", 1)[1] for t in (train, other))
    assert a == b


def test_search_tells_every_draw_and_its_scores(spark, train):
    fit, val = (train.where(c).drop("is_validation") for c in ("NOT is_validation", "is_validation"))
    out = scratch_path(spark, "search")
    space = {"maxDepth": [2, 4], "stepSize": (0.01, 0.3, "log"), "minInstancesPerNode": (1, 20, "int"), "subsamplingRate": (0.5, 1.0, "u")}
    best, results = search.halving_search(fit, val, out, space, n_draws=4, metric="auc", first_rounds=1, max_rounds=4, eta=2)
    rows = results.collect()
    assert [sum(r.rung == k for r in rows) for k in (0, 1)] == [4, 2] and best in [d for d in search.draws(space, 4)]
    for k in (0, 1):  # the best half goes on
        rung = sorted((r for r in rows if r.rung == k), key=lambda r: (-r.auc, r.draw))
        assert [r.went_on for r in rung] == [True] * (len(rung) // 2) + [False] * (len(rung) - len(rung) // 2)
    users = [set(x.user_id for x in t.select("user_id").distinct().collect()) for t in (fit, val)]
    assert not users[0] & users[1]
    con = duckdb.connect()
    for r in rows:  # the scores again, by SQL from the saved predictions
        assert r.grown <= r.rounds
        tp, fp, fn, tn = con.execute(f"""SELECT count(*) FILTER (WHERE y_true = 1 AND y_pred = 1), count(*) FILTER (WHERE y_true = 0 AND y_pred = 1),
            count(*) FILTER (WHERE y_true = 1 AND y_pred = 0), count(*) FILTER (WHERE y_true = 0 AND y_pred = 0)
            FROM read_parquet('{r.path}/*.parquet')""").fetchone()
        auc, = con.execute(f"""WITH p AS (SELECT y_true, y_proba FROM read_parquet('{r.path}/*.parquet'))
            SELECT avg(CASE WHEN a.y_proba > b.y_proba THEN 1.0 WHEN a.y_proba = b.y_proba THEN 0.5 ELSE 0 END)
            FROM p a, p b WHERE a.y_true = 1 AND b.y_true = 0""").fetchone()
        div = lambda a, b: a / b if b else 0.0
        recall, spec = div(tp, tp + fn), div(tn, tn + fp)
        assert r.auc == pytest.approx(auc) and r.recall == pytest.approx(recall) and r.precision == pytest.approx(div(tp, tp + fp))
        assert r.f1 == pytest.approx(div(2 * tp, 2 * tp + fp + fn)) and r["f-2"] == pytest.approx(div(5 * tp, 5 * tp + 4 * fn + fp))
        assert r.bacc == pytest.approx((recall + spec) / 2) and r.aba == pytest.approx(recall + spec - 1)
        assert r.mcc == pytest.approx(div(tp * tn - fp * fn, ((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) ** 0.5))
        assert 0 <= r.auprc <= 1


def test_evaluator_is_a_stage(spark, train):
    df = spark.createDataFrame([(1, 1.0, 0.9), (0, 0.0, 0.2), (1, 0.0, 0.4), (0, 1.0, 0.6)], "is_click int, prediction double, s double")
    for name, exp in (("precision", 0.5), ("auc", 0.75), ("f-2", 0.5), ("mcc", 0.0)):
        ev = search.ClickScoreEvaluator(name, scoreCol="s")
        assert ev.evaluate(df) == pytest.approx(exp) and ev.isLargerBetter()
    path = scratch_path(spark, "ev")
    ev.write().overwrite().save(path)
    assert search.ClickScoreEvaluator.load(path).evaluate(df) == pytest.approx(0.0)
    with pytest.raises(ValueError):
        search.ClickScoreEvaluator("nope", scoreCol="s").evaluate(df)


def test_scores_are_computed_once_for_their_rank(spark):
    """The filter of the metric lies above stored scores, not above the model."""
    from sessionlens.plans import q_models
    seen = spark.sparkContext.accumulator(0)

    def score(x):
        seen.add(1)
        return float(x)

    df = spark.range(500, numPartitions=4).withColumn("is_click", (F.col("id") % 3 == 0).cast("int"))
    scored = df.withColumn("p", F.udf(score, "double")("id"))
    assert q_models._ranks(scored, F.col("p")).collect()[0][0] in (True, False)
    assert seen.value == 500


def test_encoding_carries_only_what_classifiers_read(spark, train):
    clf = models.base_pipeline(models.model_choice("decision_tree", maxDepth=3), validation_col="is_validation")
    stages, rows = clf.encode(train)
    assert set(rows.columns) == {"row_ord", "is_click", "is_validation", "features", *models.BASE_NUMERIC, *stages[0].getOutputCols()}
    assert rows.count() == train.count()
    enc, _ = clf.stages()
    whole = {r.row_ord: r for r in enc.ordered(train.where("NOT is_validation")).collect()}
    got = rows.where("NOT is_validation").collect()
    assert len(got) == len(whole) and all(r[c] == whole[r.row_ord][c] for r in got for c in enc.getOutputCols())


def test_full_scores_of_training_rows_in_one_pass(spark, train):
    """Without other rows, the training rows are scored once for both uses."""
    from sessionlens.plans import q_models
    seen = spark.sparkContext.accumulator(0)

    def score(x):
        seen.add(1)
        return (x % 10) / 10

    class Model:
        def transform(self, df):
            p = F.udf(score, "double")("row_ord")
            return df.withColumn("y_pred_prob", p).withColumn("prediction", (F.col("y_pred_prob") > 0.5).cast("int"))

    out = q_models._stacked_scores(Model(), train).collect()
    assert len(out) == train.count() == seen.value and all(r.in_range and r.is_label for r in out)


def test_features_are_written_once(spark, monkeypatch):
    """The holdout split is told as rows are read, not written with every feature again."""
    monkeypatch.setattr(q_models, "_shared", {})
    written, stored = [], q_models.stored
    monkeypatch.setattr(q_models, "stored", lambda df, name: written.append(name) or stored(df, name))
    rows = q_models.feature_table(spark, SF_SMALL)
    assert written == ["features"]
    n, n_test = rows.count(), rows.where("split = 'test'").count()
    assert n == wide(spark, SF_SMALL).count() and n_test == -(-n // 5)


def test_forests_keep_the_rows_nodes(train):
    """Without them every row walks down every tree again in each pass; the trees are the same."""
    forest = models.model_choice("random_forest", **SMALL)
    assert forest.getCacheNodeIds() and models.meta_model(**SMALL).getCacheNodeIds()
    clf = models.base_pipeline(forest)
    stages, rows = clf.encode(train.drop("is_validation"))
    a, b = (models.base_pipeline(f).fit_encoded(stages, rows).stages[-1].toDebugString.split("\n", 1)[1]
            for f in (forest, forest.copy().setCacheNodeIds(False)))
    assert a == b


def test_the_meta_model_has_the_whole_forest(spark, train, monkeypatch):
    asked, forest = [], models.meta_model
    monkeypatch.setattr(models, "meta_model", lambda **p: asked.append(forest(**p)) or forest(**{**p, **SMALL}))
    monkeypatch.setattr(q_models, "_shared", {k: v for k, v in q_models._shared.items() if not k[2].startswith("stacked")})
    q_models.q_meta_model(spark, SF_SMALL)
    assert [(f.getNumTrees(), f.getMaxDepth()) for f in asked] == [(500, 10)]


def test_the_search_query_has_all_draws_and_rounds(spark, train, monkeypatch):
    asked, halving = [], search.halving_search

    def few(fit, val, out, n_draws=9, **kw):
        asked.append((n_draws, max(search._rungs(kw.get("first_rounds", 5), kw.get("max_rounds", 1500), 3))))
        return halving(fit, val, out, {"maxDepth": [2]}, n_draws=2, metric="auc", first_rounds=1, max_rounds=1)

    monkeypatch.setattr(search, "halving_search", few)
    assert len(q_models.q_param_search(spark, SF_SMALL).collect()) == 2 and asked == [(100, 1500)]


def test_ended_boosting_is_not_fitted_again(spark, train, monkeypatch):
    """More rounds would grow the same trees; every rung has the row all the same."""
    fit, val = (train.where(c).drop("is_validation") for c in ("NOT is_validation", "is_validation"))
    fitted, real = [], models.BaseClassifier.fit_encoded
    monkeypatch.setattr(models.BaseClassifier, "fit_encoded", lambda self, *a: fitted.append(self.estimator.getMaxIter()) or real(self, *a))
    space = {"maxDepth": [2], "minInstancesPerNode": [100000]}  # no split: the second tree gains nothing
    _, results = search.halving_search(fit, val, scratch_path(spark, "search"), space, n_draws=9, first_rounds=3, max_rounds=9)
    rows = results.collect()
    assert fitted == [3] * 9 and [(r.rung, r.rounds, r.grown) for r in rows] == [(0, 3, 1)] * 9 + [(1, 9, 1)] * 3
    assert len({r.path for r in rows}) == 9 and all(spark.read.parquet(r.path).count() == val.count() for r in rows[-1:])
