"""A store of results by run: append, replace one's own run, read back.

One folder per store, one partition per run. Writing a run replaces that run
alone (dynamic partition overwrite with Spark's commit protocol, so a failed
or repeated write leaves no half run); others stay. Parquet keeps nested
columns; CSV keeps them as JSON text, which reading turns back by the given
schema, so both formats return what was written (in CSV a null is ``\\N``, so a
text of just these two characters comes back as null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = "run"
_CSV = {"nullValue": "\\N", "escape": '"'}      # an empty text is written as two quotes
_NESTED = (T.ArrayType, T.StructType, T.MapType)


def _schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _flat(schema: T.StructType) -> T.StructType:
    """The schema of the CSV files: nested columns as text."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, _NESTED) else f.dataType)
                         for f in schema.fields])


def append_result(df: DataFrame, path: str, run: str, fmt: str = "parquet") -> None:
    """Write ``df`` as run ``run`` of the store at ``path``; a run of that
    name is replaced, all others stay."""
    if RUN in df.columns:
        raise ValueError(f"a result has no column {RUN!r} of its own")
    if fmt == "csv":
        df = df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, _NESTED) else F.col(f.name)
                         for f in df.schema.fields])
    writer = (df.withColumn(RUN, F.lit(run)).write.mode("overwrite").partitionBy(RUN)
              .option("partitionOverwriteMode", "dynamic"))
    if fmt == "csv":
        writer.options(**_CSV).csv(path, header=True)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError("fmt must be 'csv' or 'parquet'")


def read_results(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                 runs: list[str] | None = None) -> DataFrame:
    """(run, columns of ``schema``...) of all runs, or of ``runs`` (only their
    folders are read). The schema is given, never inferred."""
    schema = _schema(schema)
    stored = T.StructType([*(schema if fmt == "parquet" else _flat(schema)).fields, T.StructField(RUN, T.StringType())])
    reader = spark.read.schema(stored)
    if fmt == "csv":
        df = reader.options(**_CSV).option("multiLine", True).csv(path, header=True)
        df = df.select(RUN, *[F.from_json(f.name, f.dataType).alias(f.name) if isinstance(f.dataType, _NESTED)
                              else F.col(f.name) for f in schema.fields])
    else:
        df = reader.parquet(path).select(RUN, *[f.name for f in schema.fields])
    return df if runs is None else df.where(F.col(RUN).isin(runs))
