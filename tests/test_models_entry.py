"""Smoke tests for the entry point, the model jobs and the streaming job."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from sessionlens.operators import models
from sessionlens.plans import q_models
from sessionlens.session import scratch_path


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "daily_sessions_count" in df.columns and len(df.columns) == 45


def test_stacked_model_save_load_same_scores(spark):
    train, test = q_models._train_test(spark, SF_SMALL)
    train = train.drop("is_validation")
    m = models.StackedClassifier(models.model_choice("gbt", maxIter=3, maxDepth=3),
                                 meta_params={"numTrees": 3, "maxDepth": 3}).fit(train)
    a = m.transform(test).select("row_ord", "y_pred_prob", "prediction")
    path = scratch_path(spark, "t-model")
    models.save_model(m, path)
    b = models.load_model(path).transform(test).select("row_ord", "y_pred_prob", "prediction")
    assert a.exceptAll(b).count() == 0 and a.count() == test.count()
    r = a.agg(F.min("y_pred_prob"), F.max("y_pred_prob")).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0


def test_streaming_hourly_matches_batch(spark):
    out = E.queries()["hourly_ctr_stream"](spark, SF_SMALL)
    assert out.count() > 0
