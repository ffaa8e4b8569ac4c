"""Queries for encodings and model jobs (rows 9, 152-164).

Fitted scores cannot come from SQL, so the model queries return what must
hold for any fit, and SQL states it: which rows are scored, their labels, that
scores are probabilities and labels follow them, that the scores rank the
training rows better than a constant would, that a saved model scores as
before, that an ensemble's score is the mean of its members'.

The base model is fitted as configured in ``models.BASE_DEFAULTS``; its rounds
end when the validation rows (a fifth of the training users) no longer gain.
The meta forest of ``meta_model`` is that of ``models.META_DEFAULTS``; the
other queries' forests have ``FOREST`` trees of the full depth instead of its
500 (README: measured times). Training always sees the whole feature table. Queries of one session share the feature table and
the fitted stacked model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlens.operators import cleaning, encode, features, metrics, models, search, splits
from sessionlens.operators.target_stats import OrderedTargetEncoder
from sessionlens.plans.registry import narrow, register, wide
from sessionlens.session import scratch_path, stored

FOREST = {"numTrees": 30}
VALIDATION = "is_validation"
_shared: dict[tuple, object] = {}
_OHE_COLS = ["product", "product_category_1", "campaign_id", "webpage_id"]


def _once(spark, sf_dir, name, make):
    """One result a session and input."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def feature_table(spark, sf_dir):
    """Features, target and user, stored: models make many passes, and each
    pass then reads the columns it needs. The 80/20 holdout split is a
    comparison of a row's hash with the stored border, made as rows are read."""
    def make():
        f = features.prepare_features(cleaning.clean_inference(wide(spark, sf_dir)), keep=("row_ord", "user_id"))
        return splits.holdout_split(stored(f, "features"))
    return _once(spark, sf_dir, "features", make)


def _train_test(spark, sf_dir):
    """Training rows (those of a fifth of the users flagged as validation) and test rows."""
    t = feature_table(spark, sf_dir).withColumn(VALIDATION, F.pmod(F.xxhash64("user_id"), F.lit(5)) == 0)
    return t.where(F.col("split") == "train").drop("split"), t.where(F.col("split") == "test").drop("split", VALIDATION)


def _str_cols(df):
    return df.select("row_ord", *[F.col(c).cast("string").alias(c) for c in _OHE_COLS])


_HOLDOUT = """
  , r AS (SELECT row_ord, row_number() OVER (ORDER BY md5('42|' || CAST(row_ord AS VARCHAR)), row_ord) AS pos,
          count(*) OVER () AS n FROM wide),
  hs AS (SELECT row_ord, CASE WHEN pos <= n - ceil(0.2 * n) THEN 'train' ELSE 'test' END AS split FROM r)"""


@register("one_hot_fit_transform", sql=_HOLDOUT + ", " + ", ".join(
    f"""lv_{c} AS (SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS pos FROM (
          SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM wide JOIN hs USING (row_ord)
          WHERE split = 'train' AND {c} IS NOT NULL GROUP BY 1))""" for c in _OHE_COLS)
    + " SELECT w.row_ord, " + ", ".join(f"CAST(lv_{c}.pos AS INTEGER) AS {c}_pos" for c in _OHE_COLS) + " FROM wide w "
    + " ".join(f"LEFT JOIN lv_{c} ON CAST(w.{c} AS VARCHAR) = lv_{c}.v" for c in _OHE_COLS))
def q_one_hot_fit_transform(spark, sf_dir):
    w = splits.holdout_split(wide(spark, sf_dir))
    s = _str_cols(w).join(w.select("row_ord", "split"), "row_ord")
    model = encode.one_hot_pipeline(_OHE_COLS).fit(s.where(F.col("split") == "train"))
    return encode.one_hot_positions(model, _str_cols(w), _OHE_COLS).select(
        "row_ord", *[f"{c}_pos" for c in _OHE_COLS])


@register("dummies", sql="SELECT row_ord, " + ", ".join(
    f"CASE WHEN product = '{v}' THEN 1 ELSE 0 END AS product_{v}" for v in "BCDEFGHIJ") + " FROM wide")
def q_dummies(spark, sf_dir):
    w = wide(spark, sf_dir)
    d = encode.dummies(w.select("row_ord", "product"), "product", drop_first=True, prefix="product")
    return d.drop("product")


@register("class_ratio", sql="""SELECT CAST(sum(CASE WHEN is_click = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negatives,
  CAST(sum(CASE WHEN is_click = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positives,
  sum(CASE WHEN is_click = 0 THEN 1 ELSE 0 END) / CAST(sum(CASE WHEN is_click = 1 THEN 1 ELSE 0 END) AS DOUBLE)
  AS neg_pos_ratio FROM wide""")
def q_class_ratio(spark, sf_dir):
    return models.class_ratio(wide(spark, sf_dir))


def _rows(split: str, flags: str) -> str:
    """The rows of a split with their label, and flags that must all hold."""
    held = ", ".join(f"TRUE AS {f}" for f in flags.split())
    return _HOLDOUT + f""" SELECT wide.row_ord, is_click AS y_true, {held}
        FROM wide JOIN hs ON hs.row_ord = wide.row_ord WHERE split = '{split}'"""


def _held(df, **flags):
    return df.select("row_ord", F.col("is_click").alias("y_true"),
                     *[F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()])


def _ranks(scored, score):
    """One row: whether the scores rank these rows better than a constant does
    (AUC 0.5). The scores are stored first: the metric's filter on them would
    be pushed below them, and every row be scored twice."""
    auc = metrics.roc_auc(stored(scored.select(F.col("is_click").alias("y_true"), score.alias("y_proba")), "ranked"))
    return F.broadcast(auc.select((F.coalesce("auc", F.lit(0.0)) > 0.505).alias("_ranks")))


def _scores(scored, train_scored):
    """Scores are probabilities; the label is the likelier class; they rank the training rows."""
    p, label = models.positive_probability(), F.col("prediction")
    rows = scored.crossJoin(_ranks(train_scored, p))
    return _held(rows, in_range=p.between(0, 1), follows=(p == 0.5) | ((p > 0.5).cast("double") == label), ranks=F.col("_ranks"))


def _stacked_scores(model, train, df=None):
    """Of ``df``; without it of the training rows, which are scored once then."""
    scored = model.transform(train)
    if df is None:
        scored = df = stored(scored.select("row_ord", "is_click", "y_pred_prob", "prediction"), "scored")
    else:
        df = model.transform(df)
    rows = df.crossJoin(_ranks(scored, F.col("prediction").cast("double")))
    return _held(rows, in_range=F.col("y_pred_prob").between(0, 1), is_label=F.col("prediction").isin(0, 1), ranks=F.col("_ranks"))


_SCORED = _rows("test", "in_range follows ranks")
_STACKED = "in_range is_label ranks"
_TS_COLS = ["product", "campaign_id", "gender"]


@register("ordered_target_stats", sql=_HOLDOUT + """,
  t AS (SELECT wide.row_ord, split, is_click, md5('42|' || CAST(wide.row_ord AS VARCHAR)) AS h, CAST(product AS VARCHAR) AS product,
          CAST(campaign_id AS VARCHAR) AS campaign_id, CAST(gender AS VARCHAR) AS gender FROM wide JOIN hs ON hs.row_ord = wide.row_ord),
  k AS (SELECT * FROM t WHERE split = 'train'), """ + ", ".join(f"""
  l_{c} AS (SELECT {c} AS v, (sum(is_click) + 0.5) / (count(*) + CAST(1 AS DOUBLE)) AS r FROM k GROUP BY 1),
  o_{c} AS (SELECT row_ord, (coalesce(sum(is_click) OVER w, 0) + 0.5) / (count(*) OVER w + CAST(1 AS DOUBLE)) AS r FROM k
    WINDOW w AS (PARTITION BY {c} ORDER BY h, row_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""" for c in _TS_COLS)
    + " SELECT t.row_ord, split, " + ", ".join(
        f"CAST(CASE WHEN split = 'train' THEN o_{c}.r ELSE coalesce(l_{c}.r, 0.5) END AS DOUBLE) AS {c}_ts" for c in _TS_COLS) + " FROM t "
    + " ".join(f"LEFT JOIN l_{c} ON l_{c}.v IS NOT DISTINCT FROM t.{c} LEFT JOIN o_{c} ON o_{c}.row_ord = t.row_ord" for c in _TS_COLS))
def q_ordered_target_stats(spark, sf_dir):
    """Row 155, its encoding: training rows by their earlier rows, test rows by whole categories."""
    w = splits.holdout_split(wide(spark, sf_dir)).select("row_ord", "split", "is_click", *_TS_COLS)
    enc = OrderedTargetEncoder(inputCols=_TS_COLS, outputCols=[c + "_ts" for c in _TS_COLS])
    model, train = enc.fit_ordered(w.where(F.col("split") == "train"))
    return train.unionByName(model.transform(w.where(F.col("split") == "test"))).select(
        "row_ord", "split", *[c + "_ts" for c in _TS_COLS])


def _base(spark, sf_dir):
    """The fitted base model and the encoded rows that it was fitted on."""
    def make():
        train, _ = _train_test(spark, sf_dir)
        clf = models.base_pipeline(validation_col=VALIDATION)
        stages, rows = clf.encode(train)
        return clf.fit_encoded(stages, rows), rows.where(~F.col(VALIDATION))
    return _once(spark, sf_dir, "base", make)


@register("base_model", sql=_SCORED)
def q_base_model(spark, sf_dir):
    _, test = _train_test(spark, sf_dir)
    model, rows = _base(spark, sf_dir)
    return _scores(model.transform(test), model.stages[-1].transform(rows))


@register("model_choice", sql=_rows("test", "decision_tree logistic random_forest"))
def q_model_choice(spark, sf_dir):
    """Each kind but the booster (see ``base_model``): valid scores that rank the training rows."""
    train, test = _train_test(spark, sf_dir)
    clf = models.base_pipeline()
    stages, rows = clf.encode(train)
    out, p = test, models.positive_probability()
    for name, params in (("decision_tree", {"maxDepth": 7}), ("logistic", {"maxIter": 100}), ("random_forest", {**models.META_DEFAULTS, **FOREST})):
        model = models.base_pipeline(models.model_choice(name, **params)).fit_encoded(stages, rows)
        scored = model.transform(test).crossJoin(_ranks(model.stages[-1].transform(rows), p))
        out = out.join(scored.select("row_ord", (p.between(0, 1) & F.col("_ranks")).alias(name)), "row_ord", "left")
    return _held(out, decision_tree=F.col("decision_tree"), logistic=F.col("logistic"), random_forest=F.col("random_forest"))


def _stacked(spark, sf_dir, **meta_params):
    def make():
        train, _ = _train_test(spark, sf_dir)
        return models.StackedClassifier(meta_params=meta_params, validation_col=VALIDATION).fit(train)
    return _once(spark, sf_dir, f"stacked {meta_params}", make)


@register("meta_features", sql=_rows("train", "score_first numerics_pass one_hot"))
def q_meta_features(spark, sf_dir):
    """The vector is the score, then the numeric features as they are, then
    one-hot groups that hold a single 1 at most."""
    train, _ = _train_test(spark, sf_dir)
    scored = _base(spark, sf_dir)[0].transform(train).select(*train.columns, models.positive_probability().alias("y_pred_prob"))
    out = models.meta_features_pipeline().fit(scored).transform(scored)
    v = models.vector_to_array("meta_features")
    n = len(models.NUMERIC)
    numerics = F.array(*[F.col(c).cast("double") for c in models.NUMERIC])
    hot = F.slice(v, n + 2, F.size(v) - n - 1)
    ones = F.aggregate(hot, F.lit(0.0), lambda a, x: a + x)
    return _held(out, score_first=v[0] == F.col("y_pred_prob"), numerics_pass=F.slice(v, 2, n) == numerics,
                 one_hot=F.forall(hot, lambda x: x.isin(0.0, 1.0)) & (ones <= len(models.CATEGORICAL_META)))


@register("meta_model", sql=_SCORED)
def q_meta_model(spark, sf_dir):
    """The meta forest as configured in ``models.META_DEFAULTS``: all its trees."""
    train, test = _train_test(spark, sf_dir)
    m = _stacked(spark, sf_dir)

    def meta(df):
        scored = m.base.transform(df).select(*df.columns, models.positive_probability().alias("y_pred_prob"))
        return m.meta.transform(m.meta_enc.transform(scored))
    return _scores(meta(test), meta(train))


@register("stacked_fit", sql=_rows("train", _STACKED))
def q_stacked_fit(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return _stacked_scores(_stacked(spark, sf_dir, **FOREST), train)


@register("stacked_predict", sql=_rows("test", _STACKED))
def q_stacked_predict(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return _stacked_scores(_stacked(spark, sf_dir, **FOREST), train, test)


@register("refit_full", sql=_rows("test", _STACKED))
def q_refit_full(spark, sf_dir):
    """Fitted again on train and test rows; the validation users still end the rounds."""
    train, test = _train_test(spark, sf_dir)
    est = models.StackedClassifier(meta_params=FOREST, validation_col=VALIDATION)
    full = models.refit_full(est, train, test.withColumn(VALIDATION, F.lit(False)))
    return _stacked_scores(full, train, test)


@register("param_search")
def q_param_search(spark, sf_dir):
    """Every draw and rung of a halving search with its nine scores on the
    validation users, who are no training users: ``search.N_DRAWS`` draws of
    up to the base model's rounds."""
    train, _ = _train_test(spark, sf_dir)
    fit, val = train.where(~F.col(VALIDATION)).drop(VALIDATION), train.where(VALIDATION).drop(VALIDATION)
    _, results = search.halving_search(fit, val, scratch_path(spark, "search"), n_draws=search.N_DRAWS, metric="auc")
    return results.drop("path")


@register("ensemble_mean", sql=_rows("test", "is_mean follows"))
def q_ensemble_mean(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    samples = stored(splits.balanced_samples(train, k=3, ratio=2), "samples")
    fitted = []
    for i in range(3):
        part = samples.where(F.col("sample_id") == i).drop("sample_id")
        est = models.model_choice("decision_tree", maxDepth=7)
        fitted.append(models.base_pipeline(est).fit(part))
    out = models.ensemble_mean(fitted, test)
    for i, m in enumerate(fitted):
        out = out.join(m.transform(test).select("row_ord", models.positive_probability().alias(f"p{i}")), "row_ord")
    mean = (F.col("p0") + F.col("p1") + F.col("p2")) / 3
    return _held(out, is_mean=F.abs(F.col("mean_proba") - mean) < 1e-12,
                 follows=(F.col("mean_proba") >= 0.5).cast("int") == F.col("prediction"))


def _same_score(a, b, column):
    """Rows of ``a`` with whether ``b`` scores them alike."""
    other = b.select("row_ord", column.alias("_other"))
    return _held(a.withColumn("_score", column).join(other, "row_ord", "left"), same=F.col("_score") == F.col("_other"))


@register("batch_score", sql=_rows("test", "same"))
def q_batch_score(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    path = scratch_path(spark, "model")
    m = _base(spark, sf_dir)[0]
    models.save_model(m, path)
    return _same_score(m.transform(test), models.batch_score(path, test), models.positive_probability())


@register("persist_model", sql=_rows("test", "same as_stage"))
def q_persist_model(spark, sf_dir):
    """The stacked model saved and loaded, alone and as a stage of a ``Pipeline``."""
    _, test = _train_test(spark, sf_dir)
    m = _stacked(spark, sf_dir, **FOREST)
    alone, whole = scratch_path(spark, "stacked"), scratch_path(spark, "pipeline-model")
    models.save_model(m, alone)
    models.save_model(models.PipelineModel([m]), whole)
    scored = m.transform(test)
    for name, path in (("_alone", alone), ("_staged", whole)):
        back = models.load_model(path).transform(test).select("row_ord", F.col("y_pred_prob").alias(name))
        scored = scored.join(back, "row_ord", "left")
    return _held(scored, same=F.col("y_pred_prob") == F.col("_alone"), as_stage=F.col("y_pred_prob") == F.col("_staged"))


# -- end-to-end runs ------------------------------------------------

@register("training_run")
def q_training_run(spark, sf_dir):
    from sessionlens.plans import runs
    out = scratch_path(spark, "run")
    return runs.training_run(spark, wide(spark, sf_dir), out, meta_params=FOREST)


@register("inference_run")
def q_inference_run(spark, sf_dir):
    from sessionlens.plans import runs
    run = scratch_path(spark, "run")
    runs.training_run(spark, wide(spark, sf_dir), run, meta_params=FOREST)
    return runs.inference_run(spark, narrow(spark, sf_dir), run, scratch_path(spark, "scores"))
