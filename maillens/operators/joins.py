"""Size-checked broadcast and the join helpers built on it.

A side is broadcast only after a bounded probe shows that its rows, as
text, take at most ``max_bytes`` (the probe reads no more than
``max_bytes`` rows per task). Beyond the bound Spark plans a shuffle join.
A frequent-items sketch (``approx_top_k``, merged from the tasks' sketches)
then names the keys that hold more than one task's share of the rows; only
their rows are spread over salts, as many as their share asks for, and only
they are copied on the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 16 << 20
ROW_BYTES = 16             # of a row besides its text
MAX_HOT = 1000             # keys that the sketch may name
TRACKED = 100_000          # keys that a task's sketch follows


def bytes_at_most(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when the rows of ``df`` take no more than ``max_bytes`` as text."""
    text = F.octet_length(F.to_json(F.struct(*df.columns))) + ROW_BYTES
    seen = df.select(text.alias("b")).limit(max_bytes // ROW_BYTES + 1)
    return (seen.agg(F.sum("b")).first()[0] or 0) <= max_bytes


def small_side(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its size is proven small, else ``df``."""
    return F.broadcast(df) if bytes_at_most(df, max_bytes) else df


def hint(df: DataFrame, small: bool) -> DataFrame:
    """``broadcast(df)`` when an earlier probe proved it small."""
    return F.broadcast(df) if small else df


def hot_keys(df: DataFrame, key: str, groups: int | None = None) -> list[tuple]:
    """(key, salts) of the keys that hold more than a ``groups``-th of the
    rows (default: the shuffle partitions), salts = their share in groups."""
    groups = groups or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = F.expr(f"approx_top_k(`{key}`, {min(groups, MAX_HOT)}, {TRACKED})")
    row = df.agg(F.count(key).alias("n"), top.alias("top")).first()
    return [(t["item"], -(-t["count"] * groups // row["n"])) for t in row["top"] or [] if t["count"] * groups > row["n"]]


def salted(df: DataFrame, key: str, hot: list[tuple], other: DataFrame, other_key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on a skewed key with a ``__salt`` column to join on
    as well: rows of a hot key get one of its salts by a hash of the row, and
    the other side's row of that key is copied to each salt; all other rows
    keep salt 0 and are not copied."""
    kind = df.schema[key].dataType.simpleString()
    table = F.broadcast(df.sparkSession.createDataFrame(hot, f"__hot {kind}, __salts long"))   # MAX_HOT rows at most
    spread = df.join(table, df[key] == table["__hot"], "left").withColumn("__salt", F.pmod(
        F.xxhash64(*df.columns), F.coalesce("__salts", F.lit(1)))).drop("__hot", "__salts")
    copied = (other.join(table, other[other_key] == table["__hot"], "left")
              .withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__salts", F.lit(1)) - 1)))
              .drop("__hot", "__salts"))
    return spread, copied


def semi_join(df: DataFrame, keys: DataFrame, left_on: str, right_on: str,
              max_bytes: int = DEFAULT_BROADCAST_BYTES, small: bool | None = None,
              aggregated: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``left_on`` occurs in ``keys.right_on``.

    The membership filter of the reference ("value in list") expressed
    as a left-semi join instead of a driver-side list. ``small`` reuses a
    size decision already made for ``keys`` (or a table containing it).
    Too large to broadcast, ``keys`` meets the rows in a shuffle, hot keys of
    ``df`` salted. To find them takes one more run of ``df``'s plan;
    ``aggregated`` rows (one per key, or per key and partner) go without.
    """
    k = keys.select(F.col(right_on).alias("__key")).distinct()
    small = bytes_at_most(k, max_bytes) if small is None else small
    if small:
        return df.join(F.broadcast(k), df[left_on] == k["__key"], "left_semi")
    hot = [] if aggregated else hot_keys(df, left_on)
    if not hot:
        return df.join(k, df[left_on] == k["__key"], "left_semi")
    rows, k = salted(df, left_on, hot, k, "__key")
    return rows.join(k, (rows[left_on] == k["__key"]) & (rows["__salt"] == k["__salt"]), "left_semi").drop("__salt")
