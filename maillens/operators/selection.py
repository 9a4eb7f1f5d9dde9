"""Model selection: repeatable splits, folds, parameter grids, arg-min.

Splits are hash based on a row key, so a row lands in the same part on
every run and every engine (the SQL oracle uses the same formula):

    bucket(key, salt) = int(first 8 hex digits of md5(salt || key), 16)
    train  <=> bucket(key, '') % 100 < train_pct
    fold    =  bucket(key, 'fold') % k

One table carries ``is_train``, ``fold`` and ``part`` (``fold`` for
training rows, ``k`` for the test rows). Model ``m`` trains on training
rows with ``part != m`` and is evaluated on rows with ``part == m``:
``m < k`` are the cross-validation folds, ``m == k`` is the final fit on
all training rows scored on the test part.
"""

from __future__ import annotations

import itertools
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TRAIN_PCT = 80
N_FOLDS = 5
FOLD_SALT = "fold"
TIE_DECIMALS = 12


def bucket(key: Column, salt: str = "") -> Column:
    """Non-negative 32-bit hash bucket of a key (md5 based)."""
    text = F.concat(F.lit(salt), key.cast("string")) if salt else key.cast("string")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def bucket_sql(key: str, salt: str = "") -> str:
    """DuckDB form of ``bucket``."""
    text = f"'{salt}' || {key}::VARCHAR" if salt else f"{key}::VARCHAR"
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def add_split(df: DataFrame, key: str, train_pct: int = TRAIN_PCT,
              k: int = N_FOLDS) -> DataFrame:
    """Add ``is_train``, ``fold`` and ``part`` (see module doc)."""
    is_train = bucket(F.col(key)) % 100 < train_pct
    fold = (bucket(F.col(key), FOLD_SALT) % k).cast("int")
    return (df.withColumn("is_train", is_train)
            .withColumn("fold", fold)
            .withColumn("part", F.when(F.col("is_train"), F.col("fold")).otherwise(F.lit(k))))


def random_split(df: DataFrame, train_frac: float = 0.8, seed: int = 42):
    """Option: Spark's ``randomSplit`` (repeatable only for a fixed
    partitioning of the input)."""
    return df.randomSplit([train_frac, 1.0 - train_frac], seed)


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("is_train").agg(F.count(F.lit(1)).alias("n"))


def fold_train_counts(df: DataFrame, k: int = N_FOLDS) -> DataFrame:
    """(fold, n_train, n_test) of each cross-validation round: rows of the
    other k-1 folds (the union the scripts built) and of the fold itself.
    One aggregate per fold, then totals by a window over k rows."""
    per = (df.where("is_train").groupBy("fold").agg(F.count(F.lit(1)).alias("n_test")))
    total = F.sum("n_test").over(Window.partitionBy())
    return per.select("fold", (total - F.col("n_test")).alias("n_train"), "n_test")


# ---------------------------------------------------------------- grids


def param_grid(spec: dict[str, list]) -> list[dict]:
    """Grid points in nested-loop order: the first key is the outermost
    loop, as in the scripts; ``grid_index`` numbers them from 0."""
    keys = list(spec)
    return [dict(zip(keys, values), grid_index=i)
            for i, values in enumerate(itertools.product(*(spec[k] for k in keys)))]


def grid_table(spark: SparkSession, model: str, grid: list[dict]) -> DataFrame:
    """(model, grid_index, params JSON) for a grid (small, driver-made)."""
    rows = [(model, g["grid_index"],
             json.dumps({k: v for k, v in g.items() if k != "grid_index"}, sort_keys=True))
            for g in grid]
    return spark.createDataFrame(rows, "model string, grid_index int, params string")


# ---------------------------------------------------------------- errors


def mean_cv_error(errors: DataFrame, k: int = N_FOLDS) -> DataFrame:
    """(grid_index, mean_error, n_folds) over the non-empty folds ``< k``.

    An empty fold has a null error and is left out of the mean (the
    scripts divided by zero there)."""
    return (errors.where(F.col("part") < k)
            .groupBy("grid_index")
            .agg(F.avg("error").alias("mean_error"),
                 F.count("error").alias("n_folds")))


def best_grid_point(mean_errors: DataFrame) -> DataFrame:
    """Row with the smallest mean error; ties go to the first grid point
    in enumeration order (what the scripts' filter-and-first did). Errors
    are compared at 12 decimals, so equal fold errors averaged in another
    order still tie."""
    w = Window.orderBy(F.round("mean_error", TIE_DECIMALS).asc_nulls_last(),
                       F.col("grid_index").asc())
    return (mean_errors.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))
