"""Classification jobs: grid search by k-fold CV, final fit, report.

Learning table: ``(key, label, part, features...)`` with ``part`` from
``selection.add_split`` (folds of the training rows, ``k`` = test rows).
Every job returns per (grid_index, part) metrics; the report picks the
grid point with the smallest mean CV error (first wins on ties) and its
metrics on the test part, i.e. the refit on all training rows.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maillens.operators import bayes as NB
from maillens.operators import linear as LIN
from maillens.operators import metrics as ME
from maillens.operators import selection as SE
from maillens.operators import tree as TREE

# The parameter grids of the four classification scripts,
# keys in their loop order (outermost first).
LOGREG_GRID = {
    "iterations": [10, 50, 80],
    "step": [0.1, 1.0],
    "reg_param": [0.0, 0.01, 1.0],
    "reg_type": [None, "l1", "l2"],
    "intercept": [True, False],
    "mini_batch": [0.5, 1.0],
}
SVM_GRID = {
    "iterations": [10, 50, 80],
    "step": [0.1, 1.0],
    "reg_param": [0.0, 0.01, 1.0],
    "reg_type": [None, "l1", "l2"],
    "intercept": [True, False],
}
TREE_GRID = {
    "num_classes": [2],
    "impurity": ["gini", "entropy"],
    "max_depth": [3, 5, 7],
    "max_bins": [32],
}
NB_GRID = {"smoothing": list(NB.SMOOTHING)}

MODEL_NAMES = {
    "logreg": "LogisticRegressionWithSGD",
    "svm": "SVMWithSGD",
    "tree": "DecisionTree",
    "nb": "NaiveBayes",
}
GRIDS = {"logreg": LOGREG_GRID, "svm": SVM_GRID, "tree": TREE_GRID, "nb": NB_GRID}


def grid_points(model: str) -> list[dict]:
    return SE.param_grid(GRIDS[model])


def prepared(table: DataFrame, features: list[str]) -> DataFrame:
    """Compact learning table, cached: trees scan it once per level, linear
    models turn it into blocks (``linear.blocked``). A rebalance lets adaptive execution size its partitions by
    bytes, so a small table is one task and a large one spreads over the
    cluster. The caller unpersists it."""
    labels = table.select(F.col("label").cast("double").alias("y"))
    if labels.where(F.col("y").isNull() | ~F.col("y").isin(0.0, 1.0)).limit(1).count():
        raise ValueError("labels must be 0 or 1 (use features.split_by_label to "
                         "set null labels aside)")
    slim = table.select(F.col("key"), F.col("label").cast("double").alias("label"),
                        F.col("part").cast("int").alias("part"),
                        *[F.col(c).cast("double").alias(c) for c in features])
    return slim.hint("rebalance").persist()


def grid_metrics(spark: SparkSession, model: str, table: DataFrame, features: list[str],
                 k: int = SE.N_FOLDS, grid: list[dict] | None = None) -> DataFrame:
    """Metrics per (grid_index, part) for every point of the model's grid
    (or of ``grid``)."""
    grid = grid_points(model) if grid is None else grid
    if model in ("logreg", "svm"):
        kind = "logistic" if model == "logreg" else "hinge"
        conf = LIN.cross_validate(spark, table, kind, grid, features, k)
        return ME.with_metrics(conf)
    if model == "tree":
        pred = TREE.cross_validate(table, grid, features, k)
        return ME.evaluate(pred, ["grid_index", "part"])
    if model == "nb":
        lam_grid = [g["smoothing"] for g in grid]
        _, _, pred = NB.cross_validate(spark, table, features, k, lam_grid)
        ev = ME.evaluate(pred, ["part", "smoothing"])
        idx = F.array_position(F.array(*[F.lit(float(s)) for s in lam_grid]), F.col("smoothing"))
        places = F.array(*[F.lit(g["grid_index"]) for g in grid])
        return ev.withColumn("grid_index", F.get(places, (idx - 1).cast("int"))).drop("smoothing")
    raise ValueError(f"unknown model {model!r}")


def cv_summary(spark: SparkSession, model: str, metrics: DataFrame,
               k: int = SE.N_FOLDS) -> DataFrame:
    """(grid_index, params, mean_error, n_folds) per grid point."""
    grid = SE.grid_table(spark, model, grid_points(model))
    mean = SE.mean_cv_error(metrics, k)
    return grid.join(F.broadcast(mean), "grid_index", "left").select(
        "grid_index", "params", "mean_error", "n_folds")


def report(spark: SparkSession, model: str, table: DataFrame, features: list[str],
           k: int = SE.N_FOLDS) -> DataFrame:
    """One row: model, grid size, mean errors in grid order, best params,
    final accuracy %, AUPR, AUROC (hard labels), CV and final seconds.

    "Final seconds" times a fit of the best point on all training rows and
    its test, as the scripts did after their search.
    """
    t0 = time.time()
    metrics = grid_metrics(spark, model, table, features, k)
    metrics = spark.createDataFrame(metrics.collect(), metrics.schema)   # grid points x parts
    summary = cv_summary(spark, model, metrics, k)
    rows = summary.orderBy("grid_index").collect()   # one row per grid point
    best = SE.best_grid_point(summary).first()
    cv_sec = round(time.time() - t0, 2)
    t1 = time.time()
    final = None
    if best is not None:
        point = grid_points(model)[best["grid_index"]]
        final = grid_metrics(spark, model, table, features, k, [point]).where(F.col("part") == k).first()
    fin_sec = round(time.time() - t1, 2)

    def get(row, key):
        return None if row is None else row[key]

    out = [(MODEL_NAMES[model], len(rows), [r["mean_error"] for r in rows],
            get(best, "grid_index"), get(best, "params"), get(best, "mean_error"),
            get(final, "accuracy"), get(final, "aupr"), get(final, "auroc"),
            get(final, "error"), int(get(final, "n") or 0), cv_sec, fin_sec)]
    return spark.createDataFrame(
        out, "model string, grid_size int, errors array<double>, best_grid_index int, "
             "best_params string, best_cv_error double, final_accuracy double, "
             "final_aupr double, final_auroc double, final_error double, n_test long, "
             "cv_seconds double, final_seconds double")


