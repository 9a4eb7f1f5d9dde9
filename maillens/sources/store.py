"""Bucketed, sorted tables by key, so that joins on the key need no shuffle.

The files are plain Parquet below a path; the table that tells Spark how they
are bucketed is registered in the session's catalog under a name made from the
path, by the writer or, in a later application, by ``read_bucketed``. Rows are
dealt by key before they are written, so a bucket is one sorted file (which
also compacts an input of many small files). A large table is written in
rounds, each of some of its buckets, so that the disk holds one round's dealt
rows beside the store and not the whole table's.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_name(path: str) -> str:
    return "maillens_store_" + hashlib.sha1(path.encode()).hexdigest()[:16]


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write ``df`` to ``path`` in ``buckets`` files by hash of ``key``, each
    sorted by it. Two tables written with the same number of buckets join on
    the key without an exchange."""
    spark = df.sparkSession
    spark.sql(f"drop table if exists {table_name(path)}")
    _write(df, path, key, buckets, "overwrite")


def _write(df: DataFrame, path: str, key: str, buckets: int, mode: str, **options: str) -> None:
    (df.repartition(buckets, key).write.mode(mode).option("path", path).options(**options)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table_name(path)))


def write_bucketed_rounds(spark: SparkSession, rows: Callable[[Callable[[Column], Column]], DataFrame], path: str,
                          key: str, buckets: int, rounds: int, compression: str = "zstd") -> None:
    """``write_bucketed`` of a table that is made round by round, packed by
    ``compression``. ``rows(turn)`` gives the rows of a round: those for which
    ``turn`` holds, a condition on the column that becomes ``key``. It goes by
    the key's bucket, so every row has one round (a null key too) and every
    bucket is written in one."""
    spark.sql(f"drop table if exists {table_name(path)}")
    for i in range(rounds):
        part = rows(lambda c, i=i: F.pmod(F.pmod(F.hash(c), F.lit(buckets)), F.lit(rounds)) == i)
        _write(part, path, key, buckets, "append" if i else "overwrite", compression=compression)
        del part
        gc.collect()                    # Spark deletes a round's shuffle files when its plan
        spark.sparkContext._jvm.System.gc()      # has been collected on the driver


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType | str, key: str, buckets: int) -> DataFrame:
    """The table at ``path``; registered first where this session does not
    know it yet."""
    name = table_name(path)
    if not spark.catalog.tableExists(name):
        schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"create table {name} ({columns}) using parquet clustered by (`{key}`) sorted by (`{key}`) "
                  f"into {buckets} buckets location '{path}'")
    return spark.table(name)
