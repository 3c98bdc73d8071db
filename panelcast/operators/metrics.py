"""Evaluation metrics as grouped aggregates (one group per fold).

Curve metrics aggregate per distinct score first (map-side), then run a window over
the distinct scores of a fold, so rows never meet in one task; with continuous
scores, pass ``bins`` to bucket the scores before the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _score(col: str, bins: int | None) -> Column:
    c = F.col(col).cast("double")
    return F.floor(c * bins) / bins if bins else c


def roc_auc(df: DataFrame, group: str, score: str, label: str, bins: int | None = None) -> DataFrame:
    """Exact ROC-AUC per group; ties count one half; 0 when a class is missing.
    Rows are first reduced per (group, distinct score); negatives below each score
    come from a distributed prefix sum, so no group is gathered into one task."""
    from panelcast.operators.splits import grouped_prefix_sums
    agg = (df.groupBy(group, _score(score, bins).alias("_s"))
           .agg(F.sum(F.col(label).cast("long")).alias("_tp"),
                F.sum((1 - F.col(label)).cast("long")).alias("_fp")))
    a = grouped_prefix_sums(agg, group, "_s", ["_fp"], exclusive=True)
    r = a.groupBy(group).agg(
        F.sum(F.col("_tp") * (F.col("cum__fp") + F.col("_fp") / 2.0)).alias("_u"),
        F.sum("_tp").alias("_P"), F.sum("_fp").alias("_N"))
    auc = F.when((F.col("_P") > 0) & (F.col("_N") > 0), F.col("_u") / (F.col("_P") * F.col("_N"))).otherwise(0.0)
    return r.select(group, auc.alias("roc_auc"))


def pr_auc(df: DataFrame, group: str, score: str, label: str, bins: int | None = None) -> DataFrame:
    """Trapezoid area under the precision-recall curve, starting at (recall 0,
    precision 1) and walking thresholds from high to low; null without positives.
    The previous point of each threshold is recovered from the running sums
    themselves, so the walk needs no cross-partition lag."""
    from panelcast.operators.splits import grouped_prefix_sums
    agg = (df.groupBy(group, _score(score, bins).alias("_s"))
           .agg(F.sum(F.col(label).cast("long")).alias("_tp"), F.count(F.lit(1)).alias("_n")))
    a = grouped_prefix_sums(agg, group, "_s", ["_tp", "_n"], descending=True)
    P = agg.groupBy(group).agg(F.sum("_tp").alias("_P"))
    a = a.join(P, group)
    ctp, cn = F.col("cum__tp"), F.col("cum__n")
    ptp, pn = ctp - F.col("_tp"), cn - F.col("_n")
    rec, pre = F.try_divide(ctp, F.col("_P")), F.try_divide(ctp, cn)
    rec0 = F.coalesce(F.try_divide(ptp, F.col("_P")), F.lit(0.0))
    pre0 = F.when(pn > 0, ptp / pn).otherwise(F.lit(1.0))
    area = F.sum((rec - rec0) * (pre + pre0) / 2.0)
    return a.groupBy(group).agg(F.when(F.max("_P") > 0, area).alias("pr_auc"))


def _div0(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion_metrics(df: DataFrame, group: str, pred: str, label: str) -> DataFrame:
    """Accuracy, precision, recall and F1 with zero for empty denominators."""
    p, y = F.col(pred).cast("int"), F.col(label).cast("int")
    r = df.groupBy(group).agg(
        F.count_if((p == 1) & (y == 1)).alias("tp"), F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 1)).alias("fn"), F.count_if((p == 0) & (y == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return r.select(group, _div0(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                    _div0(tp, tp + fp).alias("precision"), _div0(tp, tp + fn).alias("recall"),
                    _div0(2 * tp, 2 * tp + fp + fn).alias("f1"))


def regression_metrics(df: DataFrame, group: str, y: str, p: str, empty_mape: float | None = None) -> DataFrame:
    """MAE, RMSE and MAPE (over y > 0 only; ``empty_mape`` when no such row)."""
    err = F.col(y) - F.col(p)
    mape = F.avg(F.when(F.col(y) > 0, F.abs(err) / F.col(y)))
    if empty_mape is not None:
        mape = F.coalesce(mape, F.lit(float(empty_mape)))
    return df.groupBy(group).agg(F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
                                 mape.alias("mape"), F.count(F.lit(1)).alias("n_val"))


def class_weights(counts: DataFrame) -> DataFrame:
    """Balanced weights n / (2 n_c) and the negative-to-positive ratio per fold,
    from train counts (``n_train``, ``pos_train``)."""
    n, pos = F.col("n_train"), F.col("pos_train")
    neg = n - pos
    return counts.select("fold", F.when(neg > 0, n / (2.0 * neg)).alias("weight_neg"),
                         F.when(pos > 0, n / (2.0 * pos)).alias("weight_pos"),
                         (neg / F.greatest(pos, F.lit(1))).alias("scale_pos_weight"))


def fold_summary(cls: DataFrame, reg: DataFrame) -> DataFrame:
    """Report figures over folds: ROC averaged over folds with ROC > 0, PR over all,
    MAE over MAE > 0, MAPE over non-null MAPE > 0.001 (mean, median, min) and over all
    non-null folds, the population standard deviation of MAE, and the two target gates.
    Classifier and regressor fold tables are matched on ``fold`` (full outer) and
    reduced by one aggregate."""
    from panelcast.spec import GATE_MAPE, GATE_ROC_AUC, MAPE_MIN
    j = cls.select("fold", "roc_auc", "pr_auc", F.lit(1).alias("_c")).join(
        reg.select("fold", "mae", "mape", F.lit(1).alias("_r")), "fold", "full")
    ok = F.col("mape").isNotNull() & ~F.isnan("mape") & (F.col("mape") > MAPE_MIN)
    m_ok = F.when(ok, F.col("mape"))
    mae_ok = F.when(F.col("mae") > 0, F.col("mae"))
    out = j.agg(F.coalesce(F.avg(F.when(F.col("roc_auc") > 0, F.col("roc_auc"))), F.lit(0.0)).alias("avg_roc_auc"),
                F.coalesce(F.avg("pr_auc"), F.lit(0.0)).alias("avg_pr_auc"),
                F.count("_c").alias("n_valid_folds"),
                F.coalesce(F.avg(mae_ok), F.lit(0.0)).alias("avg_mae"),
                F.coalesce(F.median(mae_ok), F.lit(0.0)).alias("median_mae"),
                F.stddev_pop(mae_ok).alias("std_mae"),
                F.avg(m_ok).alias("avg_mape"), F.median(m_ok).alias("median_mape"),
                F.avg(F.when(F.col("mape").isNotNull() & ~F.isnan("mape"), F.col("mape"))).alias("avg_mape_all"),
                F.min(m_ok).alias("best_fold_mape"),
                F.count(mae_ok).alias("n_folds_used"))
    return (out.withColumn("roc_gate", F.col("avg_roc_auc") >= GATE_ROC_AUC)
            .withColumn("mape_gate", F.coalesce(F.col("avg_mape") < GATE_MAPE, F.lit(False))))


def classifier_folds(scored: DataFrame, fold: str = "fold", score: str = "score", label: str = "label") -> DataFrame:
    """Report rows of the classifier: roc_auc, pr_auc, f1 (at 0.5), n_pos_train (positives of all
    earlier rows) and n_pos_val of each fold with validation positives; a null fold only trains."""
    counts = scored.groupBy(fold).agg(F.sum(label).alias("n_pos_val"))
    # one row a fold: the running sum over them is bounded by the number of folds
    w = Window.orderBy(F.coalesce(fold, F.lit(-1))).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("n_pos_train", F.coalesce(F.sum("n_pos_val").over(w), F.lit(0))).where(F.col(fold).isNotNull() & (F.col("n_pos_val") > 0))
    rows = scored.where(F.col(fold).isNotNull()).withColumn("_pred", (F.col(score) > 0.5).cast("int"))
    return (roc_auc(rows, fold, score, label).join(pr_auc(rows, fold, score, label), fold)
            .join(confusion_metrics(rows, fold, "_pred", label).select(fold, "f1"), fold)
            .join(counts, fold)
            .select(fold, "roc_auc", "pr_auc", "f1", F.col("n_pos_train").cast("bigint").alias("n_pos_train"),
                    F.col("n_pos_val").cast("bigint").alias("n_pos_val")))


def dataset_section(targets: DataFrame, e: str = "entity") -> DataFrame:
    """records, entities, event rate, positive samples and date range of a panel with targets."""
    return targets.agg(F.count(F.lit(1)).alias("records"), F.countDistinct(e).alias("entities"),
                       F.avg("flood_event").alias("flood_event_rate"), F.count_if(F.col("demand_target") > 0).alias("positive_demand_samples"),
                       F.concat_ws(" to ", F.min("date").cast("string"), F.max("date").cast("string")).alias("date_range"))
