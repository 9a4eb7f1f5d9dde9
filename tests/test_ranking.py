"""Areas under curves from scores, summed arrays, folds of ML estimators."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from maillens.operators import linear as LIN
from maillens.operators import ranking as RK
from maillens.operators.partials import sum_arrays


def scored(spark):
    rnd = random.Random(2)
    rows = []
    for g in range(4):
        for _ in range(150):
            y = float(rnd.random() < 0.4)
            rows.append((g, round(rnd.gauss(y, 1.0), (0, 1, 3, 6)[g]) + 0.0, y))       # no -0.0
    rows += [(10, s, 0.0) for s in (0.1, 0.2)] + [(11, s, 1.0) for s in (0.1, 0.2)] + [(12, 1.0, 1.0), (12, 1.0, 0.0)]
    return spark.createDataFrame(rows, "g int, score double, label double").repartition(6)


def test_areas_equal_the_evaluator(spark):
    df = scored(spark)
    got = {r.g: r for r in RK.score_metrics(df, ["g"]).collect()}
    for g in (*range(4), 12):
        part = df.where(F.col("g") == g)
        for metric, value in (("areaUnderROC", got[g].auroc), ("areaUnderPR", got[g].aupr)):
            want = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName=metric,
                                                 numBins=0).evaluate(part)
            assert value == pytest.approx(want, abs=1e-12), (g, metric)
    assert (got[10].auroc, got[10].aupr) == (0.0, 0.0) and (got[11].auroc, got[11].aupr) == (1.0, 1.0)
    assert got[0].n == 150
    assert RK.score_metrics(df.where("g > 99"), ["g"]).count() == 0


def test_one_large_group_lies_in_many_stretches(spark):
    """A single group is dealt over the range partitions, not sent to one."""
    n = 4000
    df = spark.range(n).select(F.lit(1).alias("g"), (F.col("id") * 7919 % n).cast("double").alias("score"),
                               (F.col("id") % 3 == 0).cast("double").alias("label"))
    run = RK._running(RK.thresholds(df, ["g"]), ["g"])
    rows = sorted(run.collect(), key=lambda r: -r.score)
    tp = np.cumsum([r.pos for r in rows])
    assert [r.tp for r in rows] == tp.tolist()
    cells = RK.thresholds(df, ["g"]).repartitionByRange("g", F.desc("score"))
    assert cells.rdd.getNumPartitions() > 1 or cells.count() == n


def test_sums_over_many_partitions(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    fn = lambda batches: sum((np.array([p["x"].sum(), len(p)]) for p in batches), np.zeros(2))
    for n in (1, 7, 90):
        assert sum_arrays(df.repartition(n), fn, 2, n).tolist() == [499500.0, 1000.0]
        whole = sum_arrays(df.repartition(n), fn, 2, n, np.int64)
        assert whole.dtype == np.int64 and whole.tolist() == [499500, 1000]


def test_ml_folds_equal_cross_validator(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    rnd = random.Random(9)
    rows = []
    for i in range(240):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((i, float(a - b + rnd.gauss(0, 1) > 0), i % 4, a, b))
    data = spark.createDataFrame(rows, "key long, label double, part int, a double, b double")
    grid = [{"grid_index": i, "reg_param": r, "reg_type": "l2", "intercept": True} for i, r in enumerate((0.1, 1.0))]
    found = LIN.ml_cross_validate(data, "logistic", grid, ["a", "b"], 3)
    got = {(r.grid_index, r.part): r.e for r in found.groupBy("grid_index", "part").agg(
        F.avg((F.col("label") != F.col("prediction")).cast("double")).alias("e")).collect()}
    train = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(data.where("part < 3"))
    lr = LogisticRegression(standardization=False, tol=1e-9)
    cv = CrossValidator(estimator=lr, estimatorParamMaps=ParamGridBuilder().addGrid(lr.regParam, [0.1, 1.0]).build(),
                        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"), numFolds=3, foldCol="part")
    for g, accuracy in enumerate(cv.fit(train).avgMetrics):
        assert 1 - np.mean([got[g, p] for p in range(3)]) == pytest.approx(accuracy, abs=1e-9)
