"""Classification metrics as aggregates (inventory rows 165-178).

Scored rows carry ``y_true`` (0/1), ``y_pred`` (0/1) and ``y_proba``.
Label metrics are one aggregate of four sums. Score metrics (ROC AUC,
area under the precision-recall curve, average precision) first reduce the
rows to one row per distinct score (partial aggregation), then need
cumulative counts in score order: those come from ``cumulative_by_value``,
which scans range partitions of the values and adds their offsets, so no
step sorts all distinct scores in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.session import cut_lineage

Y_TRUE, Y_PRED, Y_PROBA = "y_true", "y_pred", "y_proba"


def confusion_counts(df: DataFrame, group_cols=()) -> DataFrame:
    """tp, fp, fn, tn (per group)."""
    t, p = F.col(Y_TRUE), F.col(Y_PRED)
    aggs = [F.sum(((t == 1) & (p == 1)).cast("long")).alias("tp"),
            F.sum(((t == 0) & (p == 1)).cast("long")).alias("fp"),
            F.sum(((t == 1) & (p == 0)).cast("long")).alias("fn"),
            F.sum(((t == 0) & (p == 0)).cast("long")).alias("tn")]
    g = df.groupBy(*group_cols) if group_cols else df
    return g.agg(*aggs)


def confusion_matrix(df: DataFrame) -> DataFrame:
    """Counts by (label, prediction)."""
    return df.groupBy(Y_TRUE, Y_PRED).agg(F.count(F.lit(1)).alias("count"))


def _d(c):
    return F.col(c).cast("double")


def _safe(num, den):
    """num / den, 0 when den is 0 (sklearn's zero_division=0)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def precision_expr():
    return _safe(_d("tp"), _d("tp") + _d("fp"))


def recall_expr():
    return _safe(_d("tp"), _d("tp") + _d("fn"))


def fbeta_expr(beta: float):
    b2 = float(beta) ** 2
    return _safe((1 + b2) * _d("tp"), (1 + b2) * _d("tp") + b2 * _d("fn") + _d("fp"))


def mcc_expr():
    tp, fp, fn, tn = _d("tp"), _d("fp"), _d("fn"), _d("tn")
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return _safe(tp * tn - fp * fn, den)


def bacc_expr():
    tpr = _safe(_d("tp"), _d("tp") + _d("fn"))
    tnr = _safe(_d("tn"), _d("tn") + _d("fp"))
    # classes absent from y_true do not count (as in sklearn)
    k = (F.when(F.col("tp") + F.col("fn") > 0, 1).otherwise(0)
         + F.when(F.col("tn") + F.col("fp") > 0, 1).otherwise(0))
    return _safe(tpr + tnr, k.cast("double"))


def label_metrics(df: DataFrame, group_cols=(), beta: float = 2.0) -> DataFrame:
    """precision, recall, f1, f-beta, mcc, bacc, aba in one aggregate."""
    c = confusion_counts(df, group_cols)
    return c.select(*group_cols, "tp", "fp", "fn", "tn",
                    precision_expr().alias("precision"), recall_expr().alias("recall"),
                    fbeta_expr(1.0).alias("f1"), fbeta_expr(beta).alias("fbeta"),
                    mcc_expr().alias("mcc"), bacc_expr().alias("bacc"),
                    (2 * bacc_expr() - 1).alias("aba"))


def cumulative_by_value(df: DataFrame, value_col: str, sum_cols, descending: bool = False) -> DataFrame:
    """``df`` has one row per distinct ``value_col``. Adds ``_below_<c>``:
    the sum of ``c`` over rows strictly before in value order (ascending,
    or descending). Range partitions (sampled bounds, so concentrated values
    spread too) are scanned on their own; one row a partition carries on."""
    order = F.col(value_col).desc() if descending else F.col(value_col).asc()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written once: bounds are sampled, both branches must see the same ones
    d = cut_lineage(df.repartitionByRange(parts, order).withColumn("_bk", F.spark_partition_id()))
    w = Window.partitionBy("_bk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = d.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_loc_{c}") for c in sum_cols])
    tot = d.groupBy("_bk").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    wb = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)   # one row a partition
    offs = tot.select("_bk", *[F.coalesce(F.sum(f"_tot_{c}").over(wb), F.lit(0)).alias(f"_off_{c}")
                               for c in sum_cols])
    j = local.join(offs, "_bk")
    return j.select(*df.columns, *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"_below_{c}")
                                   for c in sum_cols])


def score_counts(df: DataFrame) -> DataFrame:
    """One row per distinct score: positives and negatives."""
    return (df.where(F.col(Y_PROBA).isNotNull())
              .groupBy(Y_PROBA).agg(F.sum((F.col(Y_TRUE) == 1).cast("long")).alias("pos"),
                                    F.sum((F.col(Y_TRUE) == 0).cast("long")).alias("neg")))


def roc_auc(df: DataFrame) -> DataFrame:
    """ROC AUC with ties counted half: sum over scores of
    pos * (neg below + neg tied / 2), over P * N. Null when one class is
    missing (the reference raises)."""
    c = cumulative_by_value(score_counts(df), Y_PROBA, ["neg"])
    return c.agg(
        (F.sum(_d("pos") * (_d("_below_neg") + _d("neg") / 2))
         / F.when((F.sum("pos") > 0) & (F.sum("neg") > 0), _d_sum("pos") * _d_sum("neg"))).alias("auc"))


def _d_sum(c):
    return F.sum(c).cast("double")


def _pr_points(df: DataFrame) -> DataFrame:
    """Per distinct score (descending thresholds): tp and fp at this
    threshold and at the previous one."""
    c = cumulative_by_value(score_counts(df), Y_PROBA, ["pos", "neg"], descending=True)
    tot = c.agg(F.sum("pos").alias("_P"))
    c = c.crossJoin(F.broadcast(tot))
    return c.select(
        (F.col("_below_pos") + F.col("pos")).alias("tp"), (F.col("_below_neg") + F.col("neg")).alias("fp"),
        F.col("_below_pos").alias("tp_prev"), F.col("_below_neg").alias("fp_prev"), "_P")


def _prec(tp, fp):
    return F.when(tp + fp == 0, F.lit(1.0)).otherwise(tp.cast("double") / (tp + fp))


def auprc(df: DataFrame) -> DataFrame:
    """Trapezoid area under the precision-recall curve, from the point
    (recall 0, precision 1) through every distinct threshold."""
    p = _pr_points(df)
    r, r0 = F.try_divide("tp", _d("_P")), F.try_divide("tp_prev", _d("_P"))
    pr, pr0 = _prec(F.col("tp"), F.col("fp")), _prec(F.col("tp_prev"), F.col("fp_prev"))
    return p.agg(F.sum((r - r0) * (pr + pr0) / 2).alias("auprc"))


def average_precision(df: DataFrame) -> DataFrame:
    """Step-wise AP = sum (R_i - R_{i-1}) * P_i, and AP over the base rate."""
    p = _pr_points(df)
    r, r0 = F.try_divide("tp", _d("_P")), F.try_divide("tp_prev", _d("_P"))
    ap = p.agg(F.sum((r - r0) * _prec(F.col("tp"), F.col("fp"))).alias("average_precision"))
    base = df.agg(F.avg(_d(Y_TRUE)).alias("base_rate"))
    return ap.crossJoin(base).withColumn("ap_lift", F.try_divide("average_precision", "base_rate"))


def classification_report(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class."""
    c = confusion_counts(df)
    one = c.select(F.lit(1).alias("class"), precision_expr().alias("precision"),
                   recall_expr().alias("recall"), fbeta_expr(1.0).alias("f1"),
                   (F.col("tp") + F.col("fn")).alias("support"))
    swapped = c.select(F.col("tn").alias("tp"), F.col("fn").alias("fp"), F.col("fp").alias("fn"))
    zero = swapped.select(F.lit(0).alias("class"), precision_expr().alias("precision"),
                          recall_expr().alias("recall"), fbeta_expr(1.0).alias("f1"),
                          (F.col("tp") + F.col("fn")).alias("support"))
    return zero.unionByName(one)


def score_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.min(Y_PROBA).alias("min_score"), F.max(Y_PROBA).alias("max_score"),
                  F.avg(Y_PROBA).alias("mean_score"))


def cv_scores(df: DataFrame, fold_col: str = "fold") -> DataFrame:
    """Per-fold F1 and accuracy, then their mean and (population) std."""
    per = confusion_counts(df, [fold_col]).select(
        fold_col, fbeta_expr(1.0).alias("f1"),
        ((_d("tp") + _d("tn")) / (_d("tp") + _d("tn") + _d("fp") + _d("fn"))).alias("accuracy"))
    return per.agg(F.avg("f1").alias("mean_f1"), F.stddev_pop("f1").alias("std_f1"),
                   F.avg("accuracy").alias("mean_accuracy"), F.stddev_pop("accuracy").alias("std_accuracy"),
                   F.count(F.lit(1)).alias("folds"))


def compute_score(option: str, df: DataFrame) -> float:
    """One metric by name, like the reference's ``compute_score``:
    f1, mcc, bacc, aba, auc, auprc, precision, recall, f-<beta>."""
    if option in ("auc", "auprc") and Y_PROBA not in df.columns:
        raise ValueError(f"{option} needs predicted probabilities ({Y_PROBA})")
    if option == "auc":
        return roc_auc(df).first()["auc"]
    if option == "auprc":
        return auprc(df).first()["auprc"]
    if option.startswith("f-"):
        return label_metrics(df, beta=float(option.split("-", 1)[1])).first()["fbeta"]
    if option in ("f1", "mcc", "bacc", "aba", "precision", "recall"):
        return label_metrics(df).first()[option]
    raise ValueError(f"Invalid scoring method: {option}")
