"""Areas under the ROC and PR curves from real-valued scores, all models in
one pass.

Rows of equal score are one threshold, so each group's rows are first added
up by score. The thresholds of all groups then lie in one range partitioning
by (group, descending score): a partition holds a stretch of a group, never a
group of any size. A small table of the stretches' totals gives each one what
stands before it, and running sums inside a stretch do the rest. Sums of
products are exact decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maillens.session import scratch_path

SCORE_DECIMALS = 9      # scores that agree so far are one threshold


def thresholds(pred: DataFrame, group_cols: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """(group..., score, pos, neg): rows of class 1 and 0 at every score."""
    return (pred.select(*group_cols, F.round(F.col(score), SCORE_DECIMALS).alias("score"), F.col(label).alias("y"))
            .groupBy(*group_cols, "score")
            .agg(F.count(F.when(F.col("y") == 1, 1)).alias("pos"), F.count(F.when(F.col("y") != 1, 1)).alias("neg")))


def _running(cells: DataFrame, group_cols: list[str]) -> DataFrame:
    """``cells`` plus ``tp``, ``fp`` up to and with the threshold."""
    spark = cells.sparkSession
    path = scratch_path(spark, "thresholds")
    # Written, so that a partition's number stays with its rows.
    (cells.repartitionByRange(*group_cols, F.desc("score"))
     .withColumn("__part", F.spark_partition_id()).write.parquet(path))
    ranged = spark.read.parquet(path)
    before = Window.partitionBy(*group_cols).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition and group in it: partitions + groups rows at most.
    stretch = (ranged.groupBy(*group_cols, "__part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
               .withColumn("tp0", F.coalesce(F.sum("p").over(before), F.lit(0)))
               .withColumn("fp0", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("p", "n"))
    inside = (Window.partitionBy(*group_cols, "__part").orderBy(F.desc("score"))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranged.join(stretch, [*group_cols, "__part"])
            .withColumn("tp", F.col("tp0") + F.sum("pos").over(inside))
            .withColumn("fp", F.col("fp0") + F.sum("neg").over(inside)).drop("tp0", "fp0", "__part"))


def score_metrics(pred: DataFrame, group_cols: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """(group..., n, auroc, aupr) of ``pred(group..., score, label 0/1)``.

    The curves are those of Spark's ``BinaryClassificationMetrics`` without
    binning: trapezoids between thresholds, the PR curve starting at the first
    threshold's precision. Without a row of class 1 both areas are 0, without
    one of class 0 both are 1; a group without rows has no row.
    """
    run = _running(thresholds(pred, group_cols, score, label), group_cols)
    big = lambda c: c.cast("decimal(19,0)")
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    tp0, fp0 = tp - pos, fp - neg
    now = tp / (tp + fp)
    earlier = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(now)
    sums = run.groupBy(*group_cols).agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("q"),
        F.sum(big(tp + tp0) * big(neg)).alias("area2"),            # twice the area, in pairs of rows
        F.sum(pos * (now + earlier) / 2).alias("pr"))
    auroc = (F.when(F.col("p") == 0, 0.0).when(F.col("q") == 0, 1.0)
             .otherwise(F.col("area2").cast("double") / 2 / F.col("p") / F.col("q")))
    aupr = F.when(F.col("p") == 0, 0.0).otherwise(F.col("pr") / F.col("p"))
    return sums.select(*group_cols, (F.col("p") + F.col("q")).alias("n"), auroc.alias("auroc"), aupr.alias("aupr"))
