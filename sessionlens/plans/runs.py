"""End-to-end plans: the training run and the inference run.

One SparkSession and lazy DataFrames replace the reference's chain of
processes and CSV hand-offs. Lineage is cut by stored tables at
the split (reused by every later step) and the writes go to ``out_dir``
(a shared folder on a cluster).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.operators import cleaning, features, impute, metrics, models, search, splits
from sessionlens.schema import ROW_ORD, TARGET
from sessionlens.session import stored
from sessionlens.sources import io

SPLITS = ("train", "val", "test")


def preprocess(sessions: DataFrame, imputer_model=None):
    """Clean, split by user (test product left out of train), fit the mode
    imputer on train, impute and compute features inside each split.
    Returns (processed splits by name, fitted imputer)."""
    cleaned = stored(cleaning.clean_train(sessions), "cleaned")
    split = stored(splits.leave_one_product_out(cleaned), "split")
    parts = {s: split.where(F.col("split") == s).drop("split") for s in SPLITS}
    imputer_model = imputer_model or impute.ModeImputer().fit(parts["train"])
    processed = {}
    for s, df in parts.items():
        d = impute.impute_session_id(impute.impute_user_id(df))
        d = cleaning.cast_float_to_int(imputer_model.transform(d), null_free_only=False)
        # model fitting makes many passes; each reads this table
        # instead of recomputing the feature plan
        processed[s] = stored(features.prepare_features(d), s)
    return processed, imputer_model


def evaluate(scored: DataFrame, beta: float = 2.0) -> DataFrame:
    """AUC, F1 and balanced accuracy (+ the other label metrics), long form.
    Every row is scored once: the metrics read stored scores."""
    s = stored(scored.select(F.col(TARGET).alias("y_true"), F.col("prediction").alias("y_pred"),
                             F.col("y_pred_prob").alias("y_proba")), "evaluated")
    lab = metrics.label_metrics(s, beta=beta)
    auc = metrics.roc_auc(s)
    row = lab.crossJoin(auc)
    names = ["auc", "f1", "bacc", "aba", "mcc", "precision", "recall", "fbeta"]
    stack = ", ".join(f"'{n}', CAST({n} AS DOUBLE)" for n in names)
    return row.selectExpr(f"stack({len(names)}, {stack}) AS (metric, value)")


def training_run(spark: SparkSession, sessions: DataFrame, out_dir: str, base_params=None, meta_params=None,
                 search_draws: int = 0, metric: str = "f1", limit: int | None = None) -> DataFrame:
    """Preprocess, fit the stacked model on train (with ``search_draws``:
    with the settings that a halving search finds on the validation split),
    score validation, refit on every processed row, save transformer, models
    and the processed splits. Returns the validation metrics."""
    processed, imputer_model = preprocess(cleaning.limit_rows(sessions, limit) if limit else sessions)
    if search_draws:
        base_params, results = search.halving_search(processed["train"], processed["val"], os.path.join(out_dir, "search"),
                                                     n_draws=search_draws, metric=metric)
        results.write.mode("overwrite").parquet(os.path.join(out_dir, "search", "results"))
    # the validation split ends the boosting; the full refit grows as many trees as that took
    flag = "is_validation"
    watched = processed["train"].withColumn(flag, F.lit(False)).unionByName(processed["val"].withColumn(flag, F.lit(True)))
    base = models.model_choice("gbt", **(base_params or models.BASE_DEFAULTS))
    model = models.StackedClassifier(base, meta_params=meta_params, validation_col=flag).fit(watched)
    val_metrics = evaluate(model.transform(processed["val"]))
    grown = len(model.base.stages[-1].trees)
    full = models.refit_full(models.StackedClassifier(base.copy({base.maxIter: grown}), meta_params=meta_params), *processed.values())
    imputer_model.write().overwrite().save(os.path.join(out_dir, "imputer"))
    models.save_model(model, os.path.join(out_dir, "model"))
    models.save_model(full, os.path.join(out_dir, "full_model"))
    for name, rows in processed.items():
        io.write_features_labels(rows, os.path.join(out_dir, name))
    return val_metrics


def inference_run(spark: SparkSession, sessions: DataFrame, run_dir: str, out_dir: str) -> DataFrame:
    """Score new sessions with a saved run: inference cleaning (every row
    kept), saved imputer, features of this batch, full model; predictions
    and labels are written in input order and returned."""
    imputer_model = impute.ModeImputerModel.load(os.path.join(run_dir, "imputer"))
    d = cleaning.null_sentinel(cleaning.clean_inference(sessions))
    d = impute.impute_session_id(impute.impute_user_id(d))
    d = cleaning.cast_float_to_int(imputer_model.transform(d), null_free_only=False)
    feats = stored(features.prepare_features(d), "features")
    scored = models.load_model(os.path.join(run_dir, "full_model")).transform(feats)
    scored = stored(scored.select(ROW_ORD, "y_pred_prob", "prediction"), "scored")
    io.write_predictions(scored, os.path.join(out_dir, "predicted_probabilities"), "y_pred_prob")
    io.write_predictions(scored, os.path.join(out_dir, "predicted_labels"), "prediction")
    return scored
