"""Model jobs on ``pyspark.ml`` (inventory rows 154-164 and 9).

The reference trains a boosted-tree base model and a random-forest meta
model on pandas frames. Here both are ``pyspark.ml`` estimators trained on
distributed DataFrames; only fitted parameters reach the driver.
"""

from __future__ import annotations

import importlib
import json
import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.operators import features as feats
from sessionlens.operators.encode import one_hot_pipeline
from sessionlens.operators.target_stats import OrderedTargetEncoder
from sessionlens.schema import RANDOM_STATE, ROW_ORD, TARGET
from sessionlens.session import stored

# Fixed values of the reference's default model settings.
BASE_DEFAULTS = {"maxIter": 1500, "stepSize": 0.05, "maxDepth": 7, "subsamplingRate": 0.8}
META_DEFAULTS = {"numTrees": 500, "maxDepth": 10, "minInstancesPerNode": 5}

NUMERIC, CATEGORICAL_META = feats.threshold_features()
# Fixed values of the reference: the columns its base model takes as categories.
BASE_CATEGORICAL = ["product", "campaign_id", "webpage_id", "product_category", "user_group_id", "gender", "var_1",
                    "session_time_of_day", "user_depth", "secondary_product_category_known", "city_development_index_known"]
BASE_CATEGORICAL += [f.name for f in feats.FEATURES if f.categorical and f.name not in BASE_CATEGORICAL]  # string columns
BASE_NUMERIC = [f.name for f in feats.FEATURES if f.name not in BASE_CATEGORICAL]


class SessionFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage: cleaned sessions -> registry features (+ target)."""

    keepCols = Param(Params._dummy(), "keepCols", "columns carried through",
                     typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, keepCols=None):
        super().__init__()
        self._setDefault(keepCols=[ROW_ORD])
        kw = self._input_kwargs
        self._set(**{k: v for k, v in kw.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return feats.prepare_features(df, keep=tuple(self.getOrDefault(self.keepCols)))


def positive_probability(col: str = "probability"):
    return vector_to_array(F.col(col))[1]


def class_ratio(df: DataFrame, label: str = TARGET) -> DataFrame:
    """One row: negatives, positives and negatives / positives."""
    g = df.agg(F.sum((F.col(label) == 0).cast("long")).alias("negatives"),
               F.sum((F.col(label) == 1).cast("long")).alias("positives"))
    return g.withColumn("neg_pos_ratio", F.try_divide(F.col("negatives"), F.col("positives")))


def with_class_weight(df: DataFrame, label: str = TARGET, out: str = "class_weight") -> DataFrame:
    """Balanced weights n / (2 n_class) (scikit-learn's 'balanced'); the two
    class counts are one broadcast row."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = c.agg(F.sum("_nc").alias("_n"))
    w = c.crossJoin(tot).select(label, (F.col("_n") / (2.0 * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label, "left")


def model_choice(name: str, **params):
    """Base estimators by name: decision tree, boosted trees, forest, logistic.
    Boosters of other libraries are not here under their names: ``gbt`` is."""
    kinds = {"decision_tree": DecisionTreeClassifier, "gbt": GBTClassifier,
             "random_forest": RandomForestClassifier, "logistic": LogisticRegression}
    if name not in kinds:
        raise ValueError(f"unknown model {name!r}; one of {sorted(kinds)}")
    est = kinds[name](labelCol=TARGET, featuresCol="features")
    if est.hasParam("seed"):
        est = est.setSeed(RANDOM_STATE)
    if name == "random_forest":
        est = est.setCacheNodeIds(True)  # same trees; rows do not walk down every tree in each pass
    return est.setParams(**params) if params else est


class BaseClassifier(Estimator, MLWritable, MLReadable):
    """The base model: categories as ordered target statistics, numeric
    features as they are, any ``pyspark.ml`` classifier on top.

    Training rows are encoded by earlier rows only; the fitted pipeline
    encodes new rows by whole categories. With ``validationCol`` the rows it
    flags train nothing: they are encoded like new rows and, for boosted
    trees, end the rounds early (``validationIndicatorCol``). ``balanced``
    weighs the classes alike.
    """

    numericCols = Param(Params._dummy(), "numericCols", "numeric features", typeConverter=TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categories", typeConverter=TypeConverters.toListString)
    validationCol = Param(Params._dummy(), "validationCol", "flag of validation rows", typeConverter=TypeConverters.toString)
    balanced = Param(Params._dummy(), "balanced", "weigh classes alike", typeConverter=TypeConverters.toBoolean)

    def __init__(self, estimator=None, numeric=None, categorical=None, validation_col=None, balanced=False):
        super().__init__()
        self.estimator = estimator if estimator is not None else model_choice("gbt", **BASE_DEFAULTS)
        self._setDefault(numericCols=BASE_NUMERIC, categoricalCols=BASE_CATEGORICAL, validationCol="", balanced=False)
        chosen = {"numericCols": numeric, "categoricalCols": categorical, "validationCol": validation_col}
        self._set(**{k: v for k, v in chosen.items() if v is not None}, balanced=balanced)

    def copy(self, extra=None) -> "BaseClassifier":
        """Parameters of the inner classifier in ``extra`` go to it."""
        that = super().copy(extra)
        that.estimator = self.estimator.copy({k: v for k, v in (extra or {}).items() if k.parent == self.estimator.uid})
        return that

    def stages(self) -> tuple[OrderedTargetEncoder, VectorAssembler]:
        cats = self.getOrDefault(self.categoricalCols)
        enc = OrderedTargetEncoder(inputCols=cats, outputCols=[c + "_ts" for c in cats])
        asm = VectorAssembler(inputCols=[*self.getOrDefault(self.numericCols), *enc.getOutputCols()], outputCol="features",
                              handleInvalid="keep")
        return enc, asm

    def encode(self, train: DataFrame) -> tuple[list, DataFrame]:
        """The fitted encoding stages and the training rows (stored encoded,
        assembled as they are read); several classifiers can be fitted on them.
        The rows have what the classifiers read: id, label, flag and features;
        the categories themselves are neither dealt out nor stored again."""
        enc, asm = self.stages()
        flag = self.getOrDefault(self.validationCol)
        read = {enc.getOrDefault(enc.idCol), enc.getLabelCol(), flag, *self.getOrDefault(self.numericCols)}
        read |= {v for p, v in self.estimator.extractParamMap().items() if p.name.endswith("Col")}  # weights, for one
        keep = [c for c in train.columns if c in read]
        fitted, rows = enc.fit_ordered(train.where(~F.col(flag)) if flag else train, keep)
        if flag:
            new = fitted.transform(train.where(F.col(flag)))
            rows = rows.unionByName(new.select(*keep, *enc.getOutputCols()))
        rows = stored(rows, "encoded")
        if self.getOrDefault(self.balanced):
            rows = with_class_weight(rows)
        return [fitted, asm], asm.transform(rows)

    def fit_encoded(self, stages: list, rows: DataFrame) -> PipelineModel:
        est, flag = self.estimator.copy(), self.getOrDefault(self.validationCol)
        if flag and est.hasParam("validationIndicatorCol"):
            est = est.setValidationIndicatorCol(flag)
        elif flag:
            rows = rows.where(~F.col(flag))
        if self.getOrDefault(self.balanced):
            est = est.setWeightCol("class_weight")
        return PipelineModel([*stages, est.fit(rows)])

    def _fit(self, train: DataFrame) -> PipelineModel:
        return self.fit_encoded(*self.encode(train))

    def write(self) -> MLWriter:
        return _WithStages(self, {"estimator": self.estimator})

    @classmethod
    def read(cls) -> MLReader:
        return _StagesReader(cls)


class _WithStages(MLWriter):
    """A stage made of stages: its parameters, and each inner stage in a
    folder of its own (named with its class in the metadata)."""

    def __init__(self, instance, inner: dict):
        super().__init__()
        self.instance, self.inner = instance, {k: v for k, v in inner.items() if v is not None}

    def saveImpl(self, path: str) -> None:
        classes = {k: f"{type(v).__module__}.{type(v).__name__}" for k, v in self.inner.items()}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"inner": classes})
        for name, stage in self.inner.items():
            stage.write().overwrite().save(os.path.join(path, name))


class _StagesReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, SparkSession.getActiveSession())
        inner = {}
        for name, full in metadata["inner"].items():
            module, _, cls = full.rpartition(".")
            inner[name] = getattr(importlib.import_module(module), cls).load(os.path.join(path, name))
        out = self.cls(**inner)
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        return out


def base_pipeline(estimator=None, numeric=None, categorical=None, validation_col: str | None = None,
                  balanced: bool = False) -> BaseClassifier:
    """The base model around ``estimator`` (default: boosted trees)."""
    return BaseClassifier(estimator, numeric, categorical, validation_col, balanced)


def meta_features_pipeline(numeric=None, categorical=None, prob_col: str = "y_pred_prob") -> Pipeline:
    """[base probability, numeric threshold features, one-hot of the
    categorical threshold features] as one vector ``meta_features``."""
    numeric = list(numeric if numeric is not None else NUMERIC)
    categorical = list(categorical if categorical is not None else CATEGORICAL_META)
    ohe = one_hot_pipeline(categorical, "_midx", "_mohe")
    asm = VectorAssembler(inputCols=[prob_col, *numeric, *[c + "_mohe" for c in categorical]],
                          outputCol="meta_features", handleInvalid="keep")
    return Pipeline(stages=[*ohe.getStages(), asm])


def meta_model(**params) -> RandomForestClassifier:
    """Random forest on all features per split, balanced class weights."""
    p = {**META_DEFAULTS, **params}
    return RandomForestClassifier(labelCol=TARGET, featuresCol="meta_features", weightCol="class_weight",
                                  featureSubsetStrategy="all", seed=RANDOM_STATE, cacheNodeIds=True, **p)


class StackedModel(Model, MLWritable, MLReadable):
    """Base pipeline + meta encoder + meta forest. ``transform`` adds
    ``y_pred_prob`` (base probability, the score) and ``prediction`` (the
    meta model's label)."""

    def __init__(self, base: PipelineModel | None = None, meta_enc: PipelineModel | None = None,
                 meta: Model | None = None):
        super().__init__()
        self.base, self.meta_enc, self.meta = base, meta_enc, meta

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = df.columns
        s = self.base.transform(df).select(*cols, positive_probability().alias("y_pred_prob"))
        m = self.meta_enc.transform(s)
        out = self.meta.transform(m)
        return out.select(*cols, "y_pred_prob", F.col("prediction").cast("int").alias("prediction"))

    def write(self) -> MLWriter:
        return _WithStages(self, {"base": self.base, "meta_enc": self.meta_enc, "meta": self.meta})

    @classmethod
    def read(cls) -> MLReader:
        return _StagesReader(cls)


class StackedClassifier(Estimator, MLWritable, MLReadable):
    """Fit the base model, the meta encoder and the meta model on the same
    rows (in-sample base scores, as the reference does; with ``foldCol``
    out-of-fold base scores instead). A stage like any other: it has
    parameters, saves and loads, and fits inside a ``Pipeline``."""

    metaParams = Param(Params._dummy(), "metaParams", "meta forest parameters as JSON", typeConverter=TypeConverters.toString)
    foldCol = Param(Params._dummy(), "foldCol", "fold of a row, for out-of-fold base scores", typeConverter=TypeConverters.toString)
    validationCol = Param(Params._dummy(), "validationCol", "flag of rows that only end the boosting", typeConverter=TypeConverters.toString)

    def __init__(self, base_estimator=None, meta_params: dict | None = None, fold_col: str | None = None,
                 validation_col: str | None = None):
        super().__init__()
        self.base_estimator = base_estimator
        self._setDefault(metaParams="{}", foldCol="", validationCol="")
        self._set(metaParams=json.dumps(meta_params or {}), foldCol=fold_col or "", validationCol=validation_col or "")

    def copy(self, extra=None) -> "StackedClassifier":
        that = super().copy(extra)
        if self.base_estimator is not None:
            that.base_estimator = self.base_estimator.copy({k: v for k, v in (extra or {}).items() if k.parent == self.base_estimator.uid})
        return that

    def write(self) -> MLWriter:
        return _WithStages(self, {"base_estimator": self.base_estimator})

    @classmethod
    def read(cls) -> MLReader:
        return _StagesReader(cls)

    def _base(self) -> BaseClassifier:
        return base_pipeline(self.base_estimator, validation_col=self.getOrDefault(self.validationCol) or None)

    def _fit(self, train: DataFrame) -> StackedModel:
        base = self._base().fit(train)
        flag, fold = self.getOrDefault(self.validationCol), self.getOrDefault(self.foldCol)
        rows = train.where(~F.col(flag)).drop(flag) if flag else train
        if fold:
            parts = []
            for k in [r[0] for r in rows.select(fold).distinct().collect()]:  # a handful of folds
                m = base_pipeline(self.base_estimator).fit(rows.where(F.col(fold) != k))
                parts.append(m.transform(rows.where(F.col(fold) == k))
                             .select(*rows.columns, positive_probability().alias("y_pred_prob")))
            scored = parts[0]
            for p in parts[1:]:
                scored = scored.unionByName(p)
        else:
            scored = base.transform(rows).select(*rows.columns, positive_probability().alias("y_pred_prob"))
        # the trees make many passes: rows are dealt evenly to the tasks
        scored = stored(scored.repartition(int(train.sparkSession.conf.get("spark.sql.shuffle.partitions")), ROW_ORD), "scored")
        enc = meta_features_pipeline().fit(scored)
        meta = meta_model(**json.loads(self.getOrDefault(self.metaParams))).fit(with_class_weight(enc.transform(scored)))
        return StackedModel(base, enc, meta)


def refit_full(estimator: Estimator, *frames: DataFrame):
    """Fit again on every processed row (union of the splits)."""
    allrows = frames[0]
    for f in frames[1:]:
        allrows = allrows.unionByName(f, allowMissingColumns=True)
    return estimator.fit(allrows)


def ensemble_mean(models, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Mean positive-class probability of several fitted models, by chained
    transforms on one frame (no joins), and the label at ``threshold``."""
    out, probs = df, []
    for i, m in enumerate(models):
        m = m.copy()  # the caller's models keep their column names
        last = m.stages[-1] if isinstance(m, PipelineModel) else m
        for setter, name in (("setProbabilityCol", f"_p{i}"), ("setRawPredictionCol", f"_raw{i}"),
                             ("setPredictionCol", f"_pred{i}")):
            getattr(last, setter)(name)
        keep = out.columns
        out = m.transform(out).select(*keep, positive_probability(f"_p{i}").alias(f"_prob{i}"))
        probs.append(F.col(f"_prob{i}"))
    mean = sum(probs[1:], probs[0]) / len(probs)
    return (out.withColumn("mean_proba", mean)
               .withColumn("prediction", (F.col("mean_proba") >= threshold).cast("int"))
               .drop(*[f"_prob{i}" for i in range(len(probs))]))


def save_model(model, path: str) -> None:
    """Persist a fitted PipelineModel or StackedModel (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """The saved model; its class is in the metadata that Spark ML writes."""
    kind = DefaultParamsReader.loadMetadata(path, SparkSession.getActiveSession())["class"]
    return StackedModel.load(path) if kind.endswith(".StackedModel") else PipelineModel.load(path)


def batch_score(model_path: str, df: DataFrame) -> DataFrame:
    """Load a saved model and score new rows."""
    return load_model(model_path).transform(df)
