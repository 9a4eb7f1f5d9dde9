"""Derived tables written once to the shared scratch folder.

The folder is the cluster's ``spark.checkpoint.dir`` (see
``maillens.session.scratch_dir``). A table is identified by a name, the
state of the files it is derived from (paths, sizes, modification times),
the package's source and the Spark application, so changed input or code
gives a new table and two drivers never write the same one. It is written
with the normal commit protocol (task retries on lost executors are safe)
and reused while its ``_DONE`` marker exists.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable

from pyspark.sql import SparkSession

from maillens.session import package_zip, scratch_path


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_DONE")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _mark(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_DONE")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p).close()


_LOCKS: dict[str, threading.Lock] = {}
_GUARD = threading.Lock()


def file_state(spark: SparkSession, path: str) -> list[str]:
    """``path:size:time`` of every file at or below ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = fs.listFiles(p, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return sorted(out)


def materialize(spark: SparkSession, name: str, sources: list[str],
                write: Callable[[str], None]) -> str:
    """Path of table ``name`` derived from ``sources``; ``write(path)`` runs
    if absent.

    Queries built from several driver threads wait for one writer instead
    of overwriting each other's output."""
    state = [spark.sparkContext.applicationId, hashlib.sha1(package_zip()).hexdigest()]
    for source in sources:
        state += file_state(spark, source)
    digest = hashlib.sha1("\n".join(state).encode()).hexdigest()[:16]
    path = scratch_path(spark, f"{name}-{digest}", unique=False)
    with _GUARD:
        lock = _LOCKS.setdefault(path, threading.Lock())
    with lock:
        if not _exists(spark, path):
            write(path)
            _mark(spark, path)
    return path
