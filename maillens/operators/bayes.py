"""Multinomial Naive Bayes for all folds and smoothing values at once.

The model is a closed form of per-class sums, so cross-validation needs
one aggregate over the table: sums per (part, label). The sums of every
training set (all training parts but one) follow from those few rows;
the model of every (part, smoothing) is computed from them, broadcast
(k + 1 parts x smoothing values rows) and applied to the rows of each
evaluation part in one pass. Same formulas as the ML library:

    pi_c      = ln(n_c + l) - ln(N + C l)
    theta_c,j = ln(s_c,j + l) - ln(sum_j s_c,j + d l)
    predict   = arg-max_c pi_c + sum_j theta_c,j x_j   (ties: smaller label)

Classes absent from a training set are not predicted (C counts present
classes only). Features must be non-negative.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMOOTHING = (0.01, 0.1, 1.0)


def class_sums(table: DataFrame, features: list[str], k: int) -> list:
    """Rows (part, label, n, s_1..s_d) of the training parts (< k)."""
    return (table.where(F.col("part") < k)
            .groupBy("part", "label")
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in features])
            .collect())


def models(sums: list, features: list[str], k: int,
           smoothing=SMOOTHING) -> tuple[list[float], list[tuple]]:
    """(classes, rows of (part, smoothing, [pi_c, theta_c... per class]))."""
    classes = sorted({r["label"] for r in sums})
    d = len(features)
    own = {(r["part"], r["label"]): (r["n"], [r[c] or 0.0 for c in features]) for r in sums}
    rows = []
    for m in range(k + 1):
        stats = {}
        for c in classes:
            n, s = 0, [0.0] * d
            for p in range(k):
                if p == m or (p, c) not in own:
                    continue
                n += own[(p, c)][0]
                s = [a + b for a, b in zip(s, own[(p, c)][1])]
            if n > 0:
                stats[c] = (n, s)
        n_all, n_cls = sum(v[0] for v in stats.values()), len(stats)
        for lam in smoothing:
            params = []
            for c in classes:
                if c not in stats:
                    params += [None] * (d + 1)
                    continue
                n, s = stats[c]
                pi = math.log(n + lam) - math.log(n_all + n_cls * lam)
                denom = math.log(sum(s) + d * lam)
                params += [pi] + [math.log(v + lam) - denom for v in s]
            rows.append((m, float(lam), params))
    return classes, rows


def model_table(spark, classes, rows, d: int) -> DataFrame:
    """Wide model table: part, smoothing, pi_<i>, t_<i>_<j> per class i."""
    cols = []
    for i in range(len(classes)):
        cols += [f"pi_{i}"] + [f"t_{i}_{j}" for j in range(d)]
    schema = "part int, smoothing double, " + ", ".join(f"{c} double" for c in cols)
    return spark.createDataFrame([(m, lam, *p) for m, lam, p in rows], schema)


def _score(i: int, features: list[str]) -> Column:
    s = F.col(f"pi_{i}")
    for j, c in enumerate(features):
        s = s + F.col(f"t_{i}_{j}") * F.col(c)
    return s


def predict(table: DataFrame, model_tbl: DataFrame, classes, features: list[str]) -> DataFrame:
    """One row per (row, smoothing) of the evaluation parts, with
    ``prediction``. The model table is tiny and broadcast."""
    joined = table.join(F.broadcast(model_tbl), "part")
    best_s, best_c = None, None
    for i, c in enumerate(classes):
        s = _score(i, features)
        if best_s is None:
            best_s, best_c = s, F.when(s.isNotNull(), F.lit(float(c)))
            continue
        better = s.isNotNull() & (best_s.isNull() | (s > best_s))
        best_c = F.when(better, F.lit(float(c))).otherwise(best_c)
        best_s = F.when(better, s).otherwise(best_s)
    return joined.withColumn("prediction", best_c).drop(*[c for c in model_tbl.columns
                                                          if c not in ("part", "smoothing")])


def cross_validate(spark, table: DataFrame, features: list[str], k: int,
                   smoothing=SMOOTHING):
    """(model table, classes, predictions) for every part and smoothing."""
    sums = class_sums(table, features, k)
    classes, rows = models(sums, features, k, smoothing)
    tbl = model_table(spark, classes, rows, len(features))
    return tbl, classes, predict(table, tbl, classes, features)
