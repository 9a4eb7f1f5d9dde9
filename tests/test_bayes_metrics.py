"""Naive Bayes closed form vs Spark ML; hard-label metrics vs MLlib."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from maillens.operators import bayes as NB
from maillens.operators import metrics as ME

K = 3


def nb_data(spark):
    rng = np.random.default_rng(3)
    n = 60
    y = (rng.random(n) > 0.6).astype(float)
    x = np.abs(rng.normal(size=(n, 4))) + y[:, None] * np.array([0.5, 0, 1.0, 0])
    part = np.arange(n) % (K + 1)
    rows = [(int(i), float(y[i]), int(part[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "key long, label double, part int, a double, b double, "
                                       "c double, d double")


@pytest.mark.parametrize("lam", [0.01, 1.0])
def test_nb_matches_ml(spark, lam):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import VectorAssembler

    df = nb_data(spark)
    feats = ["a", "b", "c", "d"]
    _, _, pred = NB.cross_validate(spark, df, feats, K, (lam,))
    ours = {(r.key, r.part): r.prediction for r in pred.collect()}
    vec = VectorAssembler(inputCols=feats, outputCol="features").transform(df)
    for m in range(K + 1):
        train = vec.where((F.col("part") < K) & (F.col("part") != m))
        model = NaiveBayes(smoothing=lam, modelType="multinomial").fit(train)
        test = model.transform(vec.where(F.col("part") == m)).collect()
        for r in test:
            assert ours[(r.key, m)] == r.prediction


def test_nb_single_class_training_predicts_it(spark):
    rows = [(i, 1.0, i % 3, 1.0, 2.0) for i in range(6)]
    df = spark.createDataFrame(rows, "key long, label double, part int, a double, b double")
    _, classes, pred = NB.cross_validate(spark, df, ["a", "b"], 2, (1.0,))
    assert classes == [1.0]
    assert {r.prediction for r in pred.collect()} == {1.0}


CASES = [
    [(1, 1), (0, 0), (1, 0), (0, 1), (1, 1), (0, 0), (0, 0)],
    [(0, 1), (0, 0), (0, 0)],          # nothing predicted positive
    [(1, 1), (1, 0), (1, 0)],          # everything predicted positive
    [(1, 0), (0, 0)],                  # no positive label
    [(1, 1), (0, 1)],                  # no negative label
]


@pytest.mark.parametrize("case", CASES)
def test_hard_label_metrics_match_mllib(spark, case):
    from pyspark.mllib.evaluation import BinaryClassificationMetrics

    df = spark.createDataFrame([(float(p), float(y)) for p, y in case],
                               "prediction double, label double")
    got = ME.evaluate(df.withColumn("g", F.lit(0)), ["g"]).first()
    lib = BinaryClassificationMetrics(
        spark.sparkContext.parallelize([(float(p), float(y)) for p, y in case], 2))
    assert got.auroc == pytest.approx(lib.areaUnderROC, abs=1e-12)
    assert got.aupr == pytest.approx(lib.areaUnderPR, abs=1e-12)
    err = sum(p != y for p, y in case) / len(case)
    assert got.error == pytest.approx(err)
    assert got.accuracy == pytest.approx((1 - err) * 100)


def test_empty_group_has_null_error(spark):
    conf = spark.createDataFrame([(0, 0, 0, 0, 0, 0, 0.0, 0.0)],
                                 "g int, n long, tp long, fp long, fn long, tn long, "
                                 "_abs double, _sq double")
    r = ME.with_metrics(conf).first()
    assert r.error is None and r.auroc is None
