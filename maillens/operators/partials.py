"""Sums of fixed-size arrays over a table's partitions, added as a tree.

Iterative fits need, in every round, one array (gradients, histograms) summed
over all rows. Each task makes one array row; while more than ``FAN`` of them
are left, they are dealt into groups of about ``FAN`` whose tasks add them up.
So a level ships one array per task below it, the levels above the first ship
next to nothing, and the driver adds at most ``FAN`` arrays whose size depends
on the model alone. Arrays are added in the order of their tasks, so the same
partitions give the same sums to the last bit; with ``np.int64`` any partitions do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 32

Partial = Callable[[Iterator[pd.DataFrame]], np.ndarray]


def _row(task: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([task], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["task", "total"])


def _each(fn: Partial, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = fn(b.to_pandas() for b in batches if b.num_rows)
        yield _row(TaskContext.get().partitionId(), np.asarray(total, kind).ravel())
    return run


def _add(kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, total = None, None
        for batch in batches:
            for row in batch.to_pylist():
                part = np.frombuffer(row["total"], kind)
                first, total = (row["task"], part.copy()) if total is None else (first, total + part)
        if total is not None:
            yield _row(first, total)
    return run


def partitions(data: DataFrame) -> int:
    """Partitions of a (persisted) table; asked once per fit, not per round."""
    return data.rdd.getNumPartitions()


def sum_arrays(data: DataFrame, fn: Partial, size: int, tasks: int, kind: type = np.float64) -> np.ndarray:
    """Sum over ``data``'s partitions of ``fn(its pandas batches)``, ``size``
    entries of ``kind``; ``tasks`` is ``partitions(data)``."""
    return add_rows(data.mapInArrow(_each(fn, kind), "task long, total binary"), size, tasks, kind)


def add_rows(rows: DataFrame, size: int, tasks: int, kind: type = np.float64) -> np.ndarray:
    """Sum of the arrays in ``rows(task, total)``, one of each of ``tasks`` tasks."""
    while tasks > FAN:
        tasks = -(-tasks // FAN)
        rows = (rows.repartition(tasks, F.floor(F.col("task") / FAN)).sortWithinPartitions("task")
                .mapInArrow(_add(kind), "task long, total binary"))
    total = np.zeros(size, kind)
    for row in sorted(rows.collect(), key=lambda r: r["task"]):   # FAN arrays at most
        total += np.frombuffer(row["total"], kind)
    return total
