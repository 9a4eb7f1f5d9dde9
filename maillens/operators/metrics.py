"""Evaluation of hard 0/1 predictions, batched over groups.

One aggregate per group (grid point x fold, or the final model) gives
the confusion counts; error rate, accuracy, AUROC and AUPR follow in
closed form. For 0/1 scores the ROC and PR curves of
``BinaryClassificationMetrics`` have at most two thresholds, so:

* ROC points (0,0), (FPR1, TPR1), (FPR0, TPR0), (1,1) where index 1 is
  "predicted 1" and index 0 is "everything predicted 1": TPR0 = 1 when a
  positive exists (else 0), FPR0 likewise for negatives.
* PR points (0, p1), (r1, p1), (r0, p0) with p0 = base rate; without any
  predicted 1: (0, p0), (r0, p0).
* Empty positives / negatives give rate 0, as the library does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRIC_COLUMNS = ("n", "tp", "fp", "fn", "tn", "error", "accuracy", "aupr", "auroc",
                  "mae", "mse")


def confusion(pred: DataFrame, group_cols: list[str], prediction: str = "prediction",
              label: str = "label") -> DataFrame:
    p, y = F.col(prediction), F.col(label)
    one = F.lit(1)
    return pred.groupBy(*group_cols).agg(
        F.count(one).alias("n"),
        F.count(F.when((p == 1) & (y == 1), one)).alias("tp"),
        F.count(F.when((p == 1) & (y != 1), one)).alias("fp"),
        F.count(F.when((p != 1) & (y == 1), one)).alias("fn"),
        F.count(F.when((p != 1) & (y != 1), one)).alias("tn"),
        F.sum(F.abs(p - y)).alias("_abs"),
        F.sum(F.pow(p - y, 2)).alias("_sq"),
    )


def _rate(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def with_metrics(conf: DataFrame) -> DataFrame:
    """Add error, accuracy (%), aupr, auroc, mae, mse to confusion counts.
    All are null for an empty group."""
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n"))
    pos, neg = tp + fn, fp + tn
    t1, f1 = _rate(tp, pos), _rate(fp, neg)
    t0 = F.when(pos > 0, 1.0).otherwise(0.0)
    f0 = F.when(neg > 0, 1.0).otherwise(0.0)
    auroc = f1 * t1 / 2 + (f0 - f1) * (t1 + t0) / 2 + (1 - f0) * (t0 + 1) / 2
    p0 = pos / n
    p1 = tp / (tp + fp)
    aupr = F.when(tp + fp > 0, t1 * p1 + (t0 - t1) * (p1 + p0) / 2).otherwise(t0 * p0)
    nonempty = n > 0
    err = (fp + fn) / n
    return conf.select(
        *[c for c in conf.columns if not c.startswith("_")],
        F.when(nonempty, err).alias("error"),
        F.when(nonempty, (1 - err) * 100).alias("accuracy"),
        F.when(nonempty, aupr).alias("aupr"),
        F.when(nonempty, auroc).alias("auroc"),
        F.when(nonempty, F.col("_abs") / n).alias("mae"),
        F.when(nonempty, F.col("_sq") / n).alias("mse"),
    )


def evaluate(pred: DataFrame, group_cols: list[str], prediction: str = "prediction",
             label: str = "label") -> DataFrame:
    return with_metrics(confusion(pred, group_cols, prediction, label))


def score_auc(pred: DataFrame, score: str, label: str = "label",
              metric: str = "areaUnderROC") -> float:
    """AUC from real-valued scores (the curve the hard labels lose)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    return BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label,
                                         metricName=metric).evaluate(pred)
