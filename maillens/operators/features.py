"""Feature tables for the classifiers: selection, fill, cast, scaling.

Features stay as separate double columns (no vector) so every step is a
plain column expression; ``assemble`` builds an ML vector when an ML
estimator needs one. Scaling statistics come from one aggregate (two
numbers per feature, map-side combined) and are applied as literals.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Positions the classification scripts read from the
# 21-column insider feature table (label = column 20).
LABEL_POSITION = 20
FEATURE_POSITIONS = (2, 3, 4, 5, 11, 12, 13, 15, 18, 19)


def names_at(df: DataFrame, positions) -> list[str]:
    return [df.columns[i] for i in positions]


def select_features(df: DataFrame, label_pos: int = LABEL_POSITION,
                    feature_pos=FEATURE_POSITIONS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns, ``label`` and the features at the given positions
    (names resolved once from the schema)."""
    label = df.columns[label_pos]
    feats = names_at(df, feature_pos)
    return df.select(*keep, F.col(label).alias("label"), *feats)


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """Numeric null and NaN to ``value``; strings and booleans untouched."""
    return df.fillna(value)


def to_double(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cast ``cols`` to double (boolean labels become 0.0 / 1.0)."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def labelled(df: DataFrame, key: str, label: str, features: list[str]) -> DataFrame:
    """(key, label, f...) all double except the key."""
    return df.select(F.col(key), F.col(label).cast("double").alias("label"),
                     *[F.col(c).cast("double").alias(c) for c in features])


def split_by_label(df: DataFrame, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """(rows with a label, rows without): a null label cannot be learned
    from, so such rows go to a side output instead of failing the job."""
    ok = F.col(label).isNotNull()
    return df.where(ok), df.where(~ok)


def scaler_stats(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """{column: (mean, sample std)} from one aggregate of 2 x d numbers."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def scaler_stats_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, mean, std) as a DataFrame (lazy; one aggregate)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', m_{c}, s_{c}" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (feature, mean, std)")


def standardize(df: DataFrame, cols: list[str], with_mean: bool = True,
                with_std: bool = True, fit_on: DataFrame | None = None) -> DataFrame:
    """Scale ``cols`` like the ML ``StandardScaler``: (x - mean) / std with
    sample std; a zero-variance column becomes 0 (or x - mean without
    ``with_std``). Statistics come from ``fit_on`` (default ``df``):
    pass the training part to avoid the leak of fitting on all rows."""
    stats = scaler_stats(fit_on if fit_on is not None else df, cols)
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        mean, std = stats[c]
        mean = mean or 0.0
        x = F.col(c) - F.lit(mean) if with_mean else F.col(c)
        if with_std:
            x = x * F.lit(0.0 if not std else 1.0 / std)
        out.append(x.alias(c))
    return df.select(*out)


def absolute(df: DataFrame, cols: list[str]) -> DataFrame:
    """|x| for ``cols`` (Naive Bayes needs non-negative values)."""
    return df.select(*[F.abs(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def assemble(df: DataFrame, cols: list[str], output: str = "features") -> DataFrame:
    """ML vector column from feature columns."""
    return VectorAssembler(inputCols=cols, outputCol=output).transform(df)
