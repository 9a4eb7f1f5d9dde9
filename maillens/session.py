"""Session and scratch-space helpers.

The library never creates a session of its own inside operators: every
operator takes DataFrames (or a caller-supplied ``SparkSession``). The
helpers here are for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "maillens",
                  shuffle_partitions: int | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    """Session for local runs: AQE on, UI off, UTC, Arrow on."""
    master = master or os.environ.get("MAILLENS_MASTER", "local[8]")
    if shuffle_partitions is None:
        shuffle_partitions = _cores(master)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.openCostInBytes", str(1 << 20))
        .config("spark.sql.files.minPartitionNum", str(max(20, _cores(master))))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    ship_package(spark)
    return spark


def _cores(master: str) -> int:
    inner = master[master.find("[") + 1:master.find("]")] if "[" in master else "1"
    if inner == "*":
        return os.cpu_count() or 8
    return max(1, int(inner))


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for materialised intermediate tables.

    Uses ``spark.checkpoint.dir`` as configured for the cluster. Only when
    it is unset on a local master (tests) a private temporary folder is
    created and registered, so ``DataFrame.checkpoint()`` and written tables
    agree; any other master without the setting is an error, because its
    executors would not share such a folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="maillens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path below the scratch folder; unique per call unless asked not."""
    base = scratch_dir(spark).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{base}/maillens/{leaf}"


_SHIPPED: set[str] = set()


def package_zip() -> bytes:
    """The package's sources as a zip with fixed time stamps."""
    import io
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    arc = os.path.relpath(full, os.path.dirname(pkg))
                    info = zipfile.ZipInfo(arc, date_time=(2000, 1, 1, 0, 0, 0))
                    with open(full, "rb") as fh:
                        zf.writestr(info, fh.read())
    return buf.getvalue()


def ship_package(spark: SparkSession) -> None:
    """Make ``maillens`` importable in the executors' Python workers.

    Arrow UDFs and ``mapInPandas`` functions refer to this package, so the
    workers must import it; a zip of the package (named by its content
    hash) is added with ``addPyFile`` once per Spark application. Spark
    copies it to every executor. Installing the package on the executors
    makes this a no-op.
    """
    import hashlib

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    data = package_zip()
    digest = hashlib.sha1(data).hexdigest()[:16]
    name = f"maillens-{digest}.zip"
    path = os.path.join(os.path.dirname(pkg), "build", name)
    if not os.path.exists(path):
        try:
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "wb") as fh:
                fh.write(data)
        except OSError:   # read-only checkout: the driver's own temp space
            path = os.path.join(tempfile.mkdtemp(prefix="maillens-dist-"), name)
            with open(path, "wb") as fh:
                fh.write(data)
    spark.sparkContext.addPyFile(path)   # Spark copies it to the executors
    _SHIPPED.add(app)
