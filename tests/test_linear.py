"""Batched SGD vs the MLlib SGD trainers (mini-batch fraction 1.0)."""

import numpy as np
import pytest

from maillens.operators import linear as LIN

K = 5


def data(spark):
    rng = np.random.default_rng(7)
    n = 90
    x = rng.normal(size=(n, 3))
    y = ((x @ np.array([1.5, -2.0, 0.7]) + rng.normal(scale=0.8, size=n)) > 0).astype(float)
    part = np.arange(n) % (K + 1)
    rows = [(int(i), float(y[i]), int(part[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "key long, label double, part int, a double, b double, c double")
    return df.repartition(3), x, y, part


CONFIGS = [
    ("none", 0.0, True), ("none", 0.0, False), ("l1", 0.01, True), ("l1", 1.0, False),
    ("l2", 0.01, True), ("l2", 1.0, False),
]


@pytest.mark.parametrize("kind", ["logistic", "hinge"])
def test_matches_mllib(spark, kind):
    from pyspark.mllib.classification import LogisticRegressionWithSGD, SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint

    df, x, y, part = data(spark)
    trajs = [LIN.Trajectory(1.0, t, r, b, 1.0) for t, r, b in CONFIGS]
    snaps, _ = LIN.fit(df, kind, trajs, ["a", "b", "c"], K, [10, 30])
    train = [LabeledPoint(y[i], x[i]) for i in range(len(y)) if part[i] < K]
    rdd = spark.sparkContext.parallelize(train, 2)
    trainer = LogisticRegressionWithSGD if kind == "logistic" else SVMWithSGD
    for ti, (rtype, reg, icpt) in enumerate(CONFIGS):
        for iters in (10, 30):
            m = trainer.train(rdd, iterations=iters, step=1.0, miniBatchFraction=1.0,
                              regParam=reg, regType=None if rtype == "none" else rtype,
                              intercept=icpt)
            w = snaps[iters][ti * (K + 1) + K]
            np.testing.assert_allclose(w[:-1], m.weights.toArray(), rtol=1e-9, atol=1e-12)
            assert abs(w[-1] - m.intercept) < 1e-9


def test_equivalent_grid_points_share_a_trajectory():
    a, _ = LIN.trajectory_of({"step": 1.0, "reg_type": None, "reg_param": 1.0,
                              "intercept": True, "iterations": 10})
    b, _ = LIN.trajectory_of({"step": 1.0, "reg_type": "l1", "reg_param": 0.0,
                              "intercept": True, "iterations": 80})
    assert a == b


def test_cross_validate_counts_cover_every_part(spark):
    df, _, _, part = data(spark)
    grid = [{"grid_index": i, "iterations": it, "step": 0.1, "reg_param": 0.0,
             "reg_type": None, "intercept": True, "mini_batch": mb}
            for i, (it, mb) in enumerate([(10, 1.0), (10, 0.5)])]
    conf = LIN.cross_validate(spark, df, "logistic", grid, ["a", "b", "c"], K).collect()
    per_part = np.bincount(part, minlength=K + 1)
    for r in conf:
        assert r.n == per_part[r.part]


def test_ml_option_fits(spark):
    from maillens.operators.features import assemble

    df, _, _, _ = data(spark)
    vec = assemble(df, ["a", "b", "c"])
    for kind in ("logistic", "hinge"):
        model = LIN.ml_estimator(kind, 0.01, "l2", max_iter=20).fit(vec)
        acc = model.transform(vec).where("prediction = label").count() / vec.count()
        assert acc > 0.7


def test_batch_bits_decode_to_bucket_parity(spark):
    from pyspark.sql import functions as F

    from maillens.operators.selection import bucket

    df = spark.range(50).withColumnRenamed("id", "key")
    iters = [1, 2, 61, 62, 63, 64, 80]
    cols = [(bucket(F.col("key"), LIN.batch_salt(t)) % 2).alias(f"p{t}") for t in iters]
    pdf = LIN.with_batch_bits(df, 80).select("key", "mb_0", "mb_1", *cols).toPandas()
    for t in iters:
        keep = LIN._in_batch(pdf, t)
        assert (keep == (pdf[f"p{t}"] == 0).to_numpy()).all(), t


def test_few_rows_in_many_partitions_are_one_task_per_iteration(spark, monkeypatch):
    """Each of the (up to 160) gradient jobs had a task per partition of the table."""
    df, _, _, part = data(spark)
    cached = df.repartition(40).persist()
    seen = []
    inner = LIN.sum_arrays
    monkeypatch.setattr(LIN, "sum_arrays", lambda *a, **kw: (seen.append(a[3]), inner(*a, **kw))[1])
    grid = [{"grid_index": 0, "iterations": 3, "step": 1.0, "reg_param": 0.0, "reg_type": None, "intercept": True}]
    conf = LIN.cross_validate(spark, cached, "hinge", grid, ["a", "b", "c"], K).collect()
    cached.unpersist()
    assert sum(r.n for r in conf) == len(part)
    assert seen == [1] * 4


def test_block_tasks_follow_rows_and_cores():
    assert LIN.block_tasks(0, 11, 12, 200) == 1
    assert LIN.block_tasks(399, 11, 12, 200) == 1
    assert LIN.block_tasks(1_600_000, 11, 12, 200) == 12
    assert LIN.block_tasks(1_600_000, 11, 12, 5) == 5
    assert LIN.block_tasks(10**9, 11, 12, 5000) == -(-10**9 * 88 // LIN.TASK_BYTES)


@pytest.mark.parametrize("kind", ["logistic", "hinge"])
@pytest.mark.parametrize("missing", [False, True])
def test_gradients_equal_the_plain_sum_over_rows(spark, kind, missing):
    """Per part, mini-batch and intercept, also with converged models and with a
    missing feature (its weight is undefined in every model)."""
    df, x, y, part = data(spark)
    if missing:
        from pyspark.sql import functions as F

        df = df.withColumn("b", F.when(F.col("key") == 7, None).otherwise(F.col("b")))
        x = x.copy()
        x[7, 1] = np.nan
    P = K + 1
    rng = np.random.default_rng(3)
    W, active = rng.normal(size=(4 * P, 4)), rng.random(4 * P) > 0.3
    has_bias = np.repeat([True, False, True, False], P)
    W[~has_bias, -1] = 0.0
    setup = LIN._Setup(kind, K, np.tile(np.arange(P), 4), np.repeat([False, False, True, True], P), has_bias)
    with LIN.blocked(df, ["a", "b", "c"], 2) as blocks:
        vec = LIN.sum_arrays(blocks, LIN._gradient_fn(setup, W, active, 2), W.size + len(W), LIN.partitions(blocks))
    bits = {r.key: r.mb_0 for r in LIN.with_batch_bits(df, 2).select("key", "mb_0").collect()}
    keep = np.array([bits[i] >> 1 & 1 == 0 for i in range(len(y))])
    xb = np.hstack([x, np.ones((len(y), 1))])
    margin, s = xb @ W.T, (2 * y - 1)[:, None]
    coef = 1 / (1 + np.exp(-margin)) - y[:, None] if kind == "logistic" else np.where(s * margin < 1, -s, 0.0)
    use = (active & (part[:, None] < K) & (part[:, None] != setup.model_part)
           & (~setup.half | keep[:, None]))
    G = (coef * use).T @ xb
    G[~has_bias, -1] = 0.0
    np.testing.assert_allclose(vec[:W.size].reshape(W.shape), G, rtol=1e-9, atol=1e-9)
    assert vec[W.size:].tolist() == use.sum(axis=0).tolist()
