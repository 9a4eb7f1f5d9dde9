"""Logistic regression and linear SVM by SGD, all grid points and folds
trained together.

The scripts train every (grid point, fold) alone: 1,080 logistic and 540
SVM fits of up to 80 gradient jobs each. Three facts shrink that:

* ``reg_type=None`` ignores ``reg_param`` and ``reg_param=0`` makes L1 and
  L2 plain SGD, so many grid points share a model;
* 10 / 50 / 80 iterations are prefixes of one trajectory (snapshots);
* all remaining trajectories x parts can share each gradient pass.

The learning table is turned once into cached blocks: the rows of one part
as a matrix (``blocked``), in as many tasks as its rows are worth. Each
iteration is one Spark job over the blocks: the weight matrix (models x
features, bounded by the grid, not by the data) travels in the task closure,
every task computes the gradients of the models that train on a block with
two matrix products and gives one array, and the arrays are added as a tree
(``partials.sum_arrays``). The driver applies the update rule of the MLlib
SGD optimiser:

    alpha_t = step / sqrt(t);   g = gradient sum / rows in the batch
    none: w -= alpha g
    L2:   w = w (1 - alpha reg) - alpha g
    L1:   w -= alpha g, then soft-threshold by alpha reg
    intercept: a constant 1 feature appended last, starting weight 1.0,
               regularised like the rest
    stop when |w_t - w_(t-1)| < tol * max(|w_t|, 1), from t = 2

Gradients: logistic (sigmoid(w.x) - y) x; hinge -s x when s w.x < 1
(s = 2y - 1). Prediction: w.x + b > 0 for both.

Mini-batch fraction 0.5 keeps, at iteration t, the rows whose md5 bucket
of ("batch<t>:" || key) is even (``selection.bucket``): repeatable on any
partitioning and in SQL. The bits are computed once per row by Spark
(bitmask columns), not per iteration. MLlib draws a seeded Bernoulli
sample instead, so those models agree in kind, not bit for bit.
Fraction 1.0 models are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillens.operators.partials import partitions, sum_arrays

CONVERGENCE_TOL = 0.001
TASK_ROWS = 8192           # rows that are worth a task, up to one task per core
TASK_BYTES = 64 << 20      # of blocks that one task holds before more tasks than cores are used


@dataclass(frozen=True)
class Trajectory:
    step: float
    reg_type: str        # 'none' | 'l1' | 'l2'
    reg: float
    intercept: bool
    batch: float


def trajectory_of(g: dict) -> tuple[Trajectory, int]:
    """Distinct model of a grid point, and its iteration snapshot."""
    rtype = g.get("reg_type") or "none"
    reg = float(g.get("reg_param", 0.0))
    if rtype == "none" or reg == 0.0:
        rtype, reg = "none", 0.0
    traj = Trajectory(float(g["step"]), rtype, reg, bool(g["intercept"]),
                      float(g.get("mini_batch", 1.0)))
    return traj, int(g["iterations"])


BITS_PER_WORD = 62


def batch_salt(t: int) -> str:
    return f"batch{t}:"


def with_batch_bits(data: DataFrame, iterations: int, key: str = "key") -> DataFrame:
    """Add ``mb_<w>`` bigint columns: bit (t-1) % 62 of word (t-1) // 62
    is the parity of ``bucket(key, 'batch<t>:')``; 0 = row in the batch."""
    from maillens.operators.selection import bucket

    words = []
    for w in range(-(-iterations // BITS_PER_WORD)):
        expr = F.lit(0).cast("bigint")
        for b in range(BITS_PER_WORD):
            t = w * BITS_PER_WORD + b + 1
            if t > iterations:
                break
            expr = expr + F.shiftleft(bucket(F.col(key), batch_salt(t)) % 2, b)
        words.append(expr.alias(f"mb_{w}"))
    return data.select("*", *words)


def _in_batch(pdf: pd.DataFrame, t: int) -> np.ndarray:
    w, b = divmod(t - 1, BITS_PER_WORD)
    return ((pdf[f"mb_{w}"].to_numpy(dtype=np.int64) >> b) & 1) == 0


@dataclass
class _Setup:
    kind: str
    k: int
    model_part: np.ndarray     # (M,) evaluation part of each model
    half: np.ndarray           # (M,) mini-batch 0.5
    has_bias: np.ndarray       # (M,)


def _matrix(pdf: pd.DataFrame, features: list) -> np.ndarray:
    x = pdf[features].to_numpy(dtype=np.float64)
    return np.hstack([x, np.ones((x.shape[0], 1))])


def _block_fn(features: list, words: list):
    def run(batches):
        for batch in batches:
            pdf = batch.to_pandas()
            x, y = _matrix(pdf, features), pdf["label"].to_numpy(dtype=np.float64)
            bits = pdf[words].to_numpy(dtype=np.int64)
            for part, rows in pdf.groupby("part").indices.items():
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([int(part)], pa.int32()),
                    **{name: pa.array([cells[rows].tobytes()], pa.binary())
                       for name, cells in (("x", x), ("y", y), ("bits", bits))}})

    return run


def block_tasks(rows: int, width: int, cores: int, parts: int) -> int:
    """Tasks for ``rows`` rows of ``width`` doubles: one per core as soon as
    there are rows for it, more only so that none holds too much; never more
    than the ``parts`` partitions the table has (they are merged, not split)."""
    return max(1, min(parts, max(-(-rows * width * 8 // TASK_BYTES), min(cores, -(-rows // TASK_ROWS)))))


@contextmanager
def blocked(data: DataFrame, features: list[str], iterations: int = 0):
    """(part, x, y, bits), cached while in use: rows of one part as one block.
    ``x`` holds their features and a 1 (doubles, row by row), ``y`` the labels,
    ``bits`` the mini-batch words if ``iterations`` is given, else nothing.

    A block comes from one Arrow batch at most, so it is bounded however large
    the table is. Partitions are merged without a shuffle: a table of a few
    rows in 200 partitions would cost 200 tasks in every iteration.
    """
    words = [f"mb_{w}" for w in range(-(-iterations // BITS_PER_WORD))]
    tasks = block_tasks(data.count(), len(features) + 1, data.sparkSession.sparkContext.defaultParallelism,
                        partitions(data))
    rows = data.coalesce(tasks)
    if words:
        rows = with_batch_bits(rows, iterations)
    blocks = (rows.select("label", "part", *features, *words)
              .mapInArrow(_block_fn(features, words), "part int, x binary, y binary, bits binary").persist())
    try:
        yield blocks
    finally:
        blocks.unpersist()


def _blocks(batches: Iterator[pd.DataFrame], d1: int):
    for pdf in batches:
        for part, x, y, bits in zip(pdf["part"], pdf["x"], pdf["y"], pdf["bits"], strict=True):
            y = np.frombuffer(y)
            yield int(part), np.frombuffer(x).reshape(-1, d1), y, np.frombuffer(bits, np.int64).reshape(len(y), -1)


def _coefficients(kind: str, x: np.ndarray, y: np.ndarray, W: np.ndarray) -> np.ndarray:
    """(rows, models): what each row's x is multiplied with in each gradient."""
    margin, y = x @ W.T, y[:, None]
    with np.errstate(over="ignore"):
        if kind == "logistic":
            return 1.0 / (1.0 + np.exp(-margin)) - y
        s = 2.0 * y - 1.0
        return np.where(s * margin < 1.0, -s, 0.0)


def _gradient_fn(setup: _Setup, W: np.ndarray, active: np.ndarray, t: int):
    M, d1 = W.shape

    def run(batches):
        G = np.zeros((M, d1))
        cnt = np.zeros(M)
        for part, x, y, bits in _blocks(batches, d1):
            trains = active & (part < setup.k) & (part != setup.model_part)
            keep = np.ones(len(y), bool)
            if setup.half.any():
                keep = _in_batch(pd.DataFrame({f"mb_{w}": bits[:, w] for w in range(bits.shape[1])}), t)
            if not (np.isfinite(x).all() and np.isfinite(y).all()):
                # A missing feature makes its weight undefined in every model, also where its row has no say.
                A = trains & (~setup.half | keep[:, None])
                G += (_coefficients(setup.kind, x, y, W) * A).T @ x
                cnt += A.sum(axis=0)
                continue
            for models, rows in ((trains & ~setup.half, slice(None)), (trains & setup.half, keep)):
                if models.any():
                    G[models] += _coefficients(setup.kind, x[rows], y[rows], W[models]).T @ x[rows]
                    cnt[models] += len(y[rows])
        G[~setup.has_bias, -1] = 0.0
        return np.concatenate([G.ravel(), cnt])

    return run


def fit(data: DataFrame, kind: str, trajs: list[Trajectory], features: list[str],
        k: int, snapshots: list[int], tol: float = CONVERGENCE_TOL):
    """Train every trajectory on every part; return {t: weights (M, d+1)}.

    ``data`` holds (key, label, part, features...); model index =
    trajectory * (k + 1) + part.
    """
    with blocked(data, features, _batched(trajs, snapshots)) as blocks:
        return descend(blocks, kind, trajs, len(features) + 1, k, snapshots, tol)


def _batched(trajs: list[Trajectory], snapshots: list[int]) -> int:
    """Iterations that need mini-batch bits."""
    return max(snapshots) if any(t.batch < 1.0 for t in trajs) else 0


def descend(blocks: DataFrame, kind: str, trajs: list[Trajectory], d1: int, k: int,
            snapshots: list[int], tol: float = CONVERGENCE_TOL):
    """``fit`` over the blocks of ``blocked`` (``d1`` = features + 1)."""
    P = k + 1
    M = len(trajs) * P
    setup = _Setup(kind, k,
                   np.tile(np.arange(P), len(trajs)),
                   np.repeat([t.batch < 1.0 for t in trajs], P),
                   np.repeat([t.intercept for t in trajs], P))
    step = np.repeat([t.step for t in trajs], P)
    reg = np.repeat([t.reg for t in trajs], P)
    rtype = np.repeat([t.reg_type for t in trajs], P)
    W = np.zeros((M, d1))
    W[setup.has_bias, -1] = 1.0
    active = np.ones(M, dtype=bool)
    updated_once = np.zeros(M, dtype=bool)
    snaps = {}
    tasks = partitions(blocks)
    for t in range(1, max(snapshots) + 1):
        if active.any():
            vec = sum_arrays(blocks, _gradient_fn(setup, W, active, t), M * d1 + M, tasks)
            G, cnt = vec[:M * d1].reshape(M, d1), vec[M * d1:]
            upd = active & (cnt > 0)
            alpha = step / math.sqrt(t)
            g = np.zeros_like(W)
            g[upd] = G[upd] / cnt[upd, None]
            prev = W.copy()
            new = W.copy()
            a = alpha[:, None]
            l2 = upd & (rtype == "l2")
            new[l2] = W[l2] * (1.0 - a[l2] * reg[l2, None]) - a[l2] * g[l2]
            rest = upd & (rtype != "l2")
            new[rest] = W[rest] - a[rest] * g[rest]
            l1 = upd & (rtype == "l1")
            shrink = (alpha * reg)[l1, None]
            new[l1] = np.sign(new[l1]) * np.maximum(0.0, np.abs(new[l1]) - shrink)
            new[~setup.has_bias, -1] = 0.0
            W = new
            check = upd & updated_once
            diff = np.linalg.norm(W - prev, axis=1)
            conv = check & (diff < tol * np.maximum(np.linalg.norm(W, axis=1), 1.0))
            updated_once |= upd
            active &= ~conv
        if t in snapshots:
            snaps[t] = W.copy()
    return snaps, setup


def _eval_fn(setup: _Setup, stack: np.ndarray):
    """stack: (S, M, d1) snapshot weights -> confusion counts per (S, M)."""
    S, M, d1 = stack.shape

    def run(batches):
        acc = np.zeros((S, M, 4))
        for part, x, y, _ in _blocks(batches, d1):
            models = np.flatnonzero(setup.model_part == part)
            pred = (x @ stack[:, models].reshape(-1, d1).T) > 0.0
            pos = y == 1.0
            for c, hits in enumerate((pred[pos], pred[~pos], ~pred[pos], ~pred[~pos])):
                acc[:, models, c] += hits.sum(axis=0).reshape(S, len(models))
        return acc.ravel()

    return run


def evaluate(blocks: DataFrame, snaps: dict, setup: _Setup) -> dict:
    """{(t, model): (tp, fp, fn, tn)} on each model's evaluation part."""
    keys = sorted(snaps)
    stack = np.stack([snaps[t] for t in keys])
    S, M, _ = stack.shape
    vec = sum_arrays(blocks, _eval_fn(setup, stack), S * M * 4, partitions(blocks)).reshape(S, M, 4)
    return {(t, m): tuple(int(v) for v in vec[i, m]) for i, t in enumerate(keys)
            for m in range(M)}


def plan_grid(grid: list[dict]) -> tuple[list[Trajectory], list[tuple[int, int, int]], list[int]]:
    """Distinct trajectories of a grid, its plan of (grid_index, trajectory
    index, iterations), and the iteration counts to keep."""
    trajs: list[Trajectory] = []
    index = {}
    plan = []
    for g in grid:
        traj, iters = trajectory_of(g)
        if traj not in index:
            index[traj] = len(trajs)
            trajs.append(traj)
        plan.append((g["grid_index"], index[traj], iters))
    return trajs, plan, sorted({it for _, _, it in plan})


def grid_scores(data: DataFrame, kind: str, grid: list[dict], features: list[str],
                k: int) -> tuple[DataFrame, DataFrame]:
    """(model, part, label, score): the margin w.x + b of every row under each
    distinct model of its part; and (grid_index, model), which grid points
    share a model. Two DataFrames."""
    trajs, plan, snapshots = plan_grid(grid)
    snaps, _ = fit(data, kind, trajs, features, k, snapshots)
    wanted = sorted({(ti, it) for _, ti, it in plan})
    P = k + 1
    by_part = np.stack([[snaps[it][ti * P + p] for ti, it in wanted] for p in range(P)])   # parts, models, d + 1

    def run(batches):
        for pdf in batches:
            x = _matrix(pdf, features)
            for p, rows in pdf.groupby("part").indices.items():
                score = x[rows] @ by_part[int(p)].T
                yield pd.DataFrame({"model": np.tile(np.arange(len(wanted), dtype=np.int32), len(rows)),
                                    "part": np.int32(p), "label": np.repeat(pdf["label"].to_numpy()[rows], len(wanted)),
                                    "score": score.ravel()})

    scored = data.select("label", "part", *features).mapInPandas(run, "model int, part int, label double, score double")
    models = data.sparkSession.createDataFrame(
        [(gi, wanted.index((ti, it))) for gi, ti, it in plan], "grid_index int, model int")
    return scored, models


def cross_validate(spark, data: DataFrame, kind: str, grid: list[dict],
                   features: list[str], k: int) -> DataFrame:
    """Confusion counts per (grid_index, part) for all grid points.

    ``data``: (key, label, part, features...), parts 0..k-1 = folds of
    the training rows, k = test rows. The result feeds
    ``metrics.with_metrics``.
    """
    trajs, plan, snapshots = plan_grid(grid)
    with blocked(data, features, _batched(trajs, snapshots)) as blocks:
        snaps, setup = descend(blocks, kind, trajs, len(features) + 1, k, snapshots)
        counts = evaluate(blocks, snaps, setup)
    P = k + 1
    rows = []
    for gi, ti, it in plan:
        for p in range(P):
            tp, fp, fn, tn = counts[(it, ti * P + p)]
            rows.append((gi, p, tp + fp + fn + tn, tp, fp, fn, tn, float(fp + fn), float(fp + fn)))
    return spark.createDataFrame(
        rows, "grid_index int, part int, n long, tp long, fp long, fn long, tn long, "
              "_abs double, _sq double")


def weights_of(snaps: dict, setup: _Setup, trajs: list[Trajectory], traj: Trajectory,
               iterations: int, part: int, k: int) -> tuple[np.ndarray, float]:
    """(weights, intercept) of one trained model."""
    W = snaps[iterations][trajs.index(traj) * (k + 1) + part]
    return W[:-1], float(W[-1])


def final_weights(data: DataFrame, kind: str, point: dict, features: list[str],
                  k: int) -> tuple[np.ndarray, float]:
    """(weights, intercept) of one grid point fitted on all training rows."""
    traj, iterations = trajectory_of(point)
    snaps, setup = fit(data, kind, [traj], features, k, [iterations])
    return weights_of(snaps, setup, [traj], traj, iterations, k, k)


def predict(df: DataFrame, weights, intercept: float, features: list[str]) -> DataFrame:
    """``df`` plus ``prediction`` (1.0 where w.x + b > 0, else 0.0) per row."""
    margin = F.lit(float(intercept))
    for name, w in zip(features, weights, strict=True):
        margin = margin + F.col(name) * F.lit(float(w))
    return df.withColumn("prediction", F.when(margin > 0, 1.0).otherwise(0.0))


def ml_estimator(kind: str, reg_param: float = 0.0, reg_type: str | None = None,
                 max_iter: int = 100, intercept: bool = True, tol: float = 1e-6):
    """Option: Spark ML's own trainers instead of SGD (``LogisticRegression``
    with L-BFGS / OWL-QN, ``LinearSVC`` with OWL-QN). They have no step
    size or mini-batch parameters; L1 maps to ``elasticNetParam=1`` for the
    logistic model, and ``LinearSVC`` supports L2 only."""
    from pyspark.ml.classification import LinearSVC, LogisticRegression

    reg = 0.0 if (reg_type in (None, "none")) else reg_param
    if kind == "logistic":
        return LogisticRegression(maxIter=max_iter, regParam=reg, tol=tol,
                                  elasticNetParam=1.0 if reg_type == "l1" else 0.0,
                                  fitIntercept=intercept, standardization=False)
    if reg_type == "l1":
        raise ValueError("LinearSVC supports L2 regularisation only")
    return LinearSVC(maxIter=max_iter, regParam=reg, fitIntercept=intercept,
                     tol=tol, standardization=False)


def ml_cross_validate(data: DataFrame, kind: str, grid: list[dict], features: list[str], k: int,
                      max_iter: int = 100, tol: float = 1e-9, parallelism: int | None = None) -> DataFrame:
    """Predictions (grid_index, part, label, prediction) of Spark ML's own
    trainers, as ``CrossValidator(foldCol=...)`` fits them, plus the fit on all
    training rows (part k).

    Every fit is an ML pipeline over the rows of one assembled, cached table
    whose ``part`` column holds the folds; fits run ``parallelism`` at a time
    (default: the session's), and all models score every row once.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    rows = (VectorAssembler(inputCols=features, outputCol="features")
            .transform(data.select("label", "part", *features)).persist())

    def run(task):
        g, m = task
        stage = ml_estimator(kind, float(g["reg_param"]), g.get("reg_type"), max_iter, bool(g["intercept"]), tol)
        return Pipeline(stages=[stage]).fit(rows.where((F.col("part") < k) & (F.col("part") != m))).stages[0]

    tasks = [(g, m) for g in grid for m in range(k + 1)]
    workers = max(1, min(parallelism or data.sparkSession.sparkContext.defaultParallelism, len(tasks)))
    with ThreadPoolExecutor(max_workers=workers) as pool:
        models = dict(zip([(g["grid_index"], m) for g, m in tasks], pool.map(run, tasks), strict=True))
    scores = []
    for g in grid:
        by_part = F.lit(None).cast("double")
        for m in range(k + 1):
            model = models[g["grid_index"], m]
            margin = F.lit(float(model.intercept))
            for name, w in zip(features, model.coefficients.toArray(), strict=True):
                margin = margin + F.col(name) * F.lit(float(w))
            by_part = F.when(F.col("part") == m, F.when(margin > 0, 1.0).otherwise(0.0)).otherwise(by_part)
        scores.append(F.struct(F.lit(g["grid_index"]).alias("grid_index"), by_part.alias("prediction")))
    rows.unpersist()
    return (data.select("part", "label", F.explode(F.array(*scores)).alias("s"))
            .select("s.grid_index", "part", "label", "s.prediction"))
