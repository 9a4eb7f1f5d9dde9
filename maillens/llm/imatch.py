"""I-Match document fingerprints with randomised lexicons.

A document's terms are its distinct lower-cased runs between white space
and ASCII punctuation. The lexicon holds the terms inside a band of inverse
document frequency (share of documents from ``RARE`` to ``COMMON``), so it
has at most (mean distinct terms of a document) / ``RARE`` terms, whatever
the corpus size: that bound allows it to travel in the plan as a table of
64-bit term hashes. ``SUBSETS`` keyed random subsets of the lexicon, from an
eighth down to 1/512 of it, each give one hash over the document's sorted
distinct terms in the subset. Two fingerprints are as alike as the share of
equal hashes among the subsets that either document has terms in.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from maillens.llm.common import BROADCAST_IDS, staged

RARE = 0.004              # of the documents: highest idf ln(250)
COMMON = 0.1              # lowest idf ln(10)
SUBSETS = tuple((bits, k) for bits in (3, 5, 7, 9) for k in range(4))   # 2**-bits of the lexicon
RANGE_ROWS = 2_000        # documents per range when neighbours by doc_id meet, about
BINS = 1024               # quantile bins that the ranges are cut from

_BREAK = r"[\s\p{Punct}]+"


def term_hashes(text: Column) -> Column:
    """Distinct 64-bit term hashes of a text, unsorted."""
    terms = F.filter(F.split(F.lower(text), _BREAK, -1), lambda t: t != "")
    return F.array_distinct(F.transform(terms, lambda t: F.xxhash64(t)))


def lexicon(texts: DataFrame, rare: float = RARE, common: float = COMMON) -> list[int]:
    """Sorted hashes of the terms of ``texts(text)`` inside the idf band."""
    n = texts.count()
    terms = texts.select(F.explode(term_hashes(F.col("text"))).alias("term"))
    band = (terms.groupBy("term").agg(F.count("*").alias("df"))
            .where((F.col("df") >= rare * n) & (F.col("df") <= common * n)))
    return sorted(r["term"] for r in band.select("term").collect())


def membership(terms: list[int]) -> Callable[[Column], Column]:
    """A constant-time test for the lexicon: two-choice hash table of longs."""
    size = 1 << max(4, (4 * len(terms)).bit_length())
    mask = size - 1
    while True:
        tables: list[list[int | None]] = [[None] * size, [None] * size]
        slot = lambda t, side: (t if side == 0 else t >> 24) & mask  # noqa: E731, B023
        for term in terms:
            t, side = term, 0
            for _ in range(200):
                at = slot(t, side)
                t, tables[side][at] = tables[side][at], t
                if t is None:
                    break
                side = 1 - side
            if t is not None:
                break
        else:
            break
        size, mask = size * 2, size * 2 - 1
    a, b = (F.split(F.lit(",".join("0" if t is None else str(t) for t in side)), ",").cast("array<bigint>")
            for side in tables)
    if not terms:
        return lambda h: F.lit(False)
    low = F.lit(mask).cast("bigint")
    return lambda h: ((F.get(a, h.bitwiseAND(low).cast("int")) == h)
                      | (F.get(b, F.shiftright(h, 24).bitwiseAND(low).cast("int")) == h))


def _in_subset(bits: int, k: int) -> Callable[[Column], Column]:
    """Keyed membership: a window of ``bits`` bits of a second hash is zero."""
    ones = F.lit((1 << bits) - 1).cast("bigint")
    return lambda h: F.shiftright(F.xxhash64(F.lit(bits), h), 16 + bits * k).bitwiseAND(ones) == 0


def with_signatures(df: DataFrame, text: str, out: str, inside: Callable[[Column], Column]) -> DataFrame:
    """``df`` plus ``out``: one hash per subset (null: no term in it), then
    one over all terms if no subset has a term (else null)."""
    df = df.withColumn("__terms", term_hashes(F.col(text)))
    df = df.select("*", F.array_sort(F.filter("__terms", inside)).alias("__band"))
    hashes = []
    for bits, k in SUBSETS:
        mine = F.filter("__band", _in_subset(bits, k))
        hashes.append(F.struct(F.size(mine).alias("n"), F.xxhash64(mine).alias("h")))
    df = df.select("*", F.array(*hashes).alias("__parts"))
    parts = F.transform("__parts", lambda p: F.when(p["n"] > 0, p["h"]))
    empty = ~F.exists("__parts", lambda p: p["n"] > 0)
    rest = F.when(empty, F.xxhash64(F.array_sort("__terms")))
    return df.withColumn(out, F.concat(parts, F.array(rest))).drop("__terms", "__band", "__parts")


def fingerprint(signatures: str) -> Column:
    """Text form: 16 hex digits per hash, ``-`` for none."""
    return F.array_join(F.transform(
        signatures, lambda h: F.coalesce(F.lpad(F.lower(F.hex(h)), 16, "0"), F.lit("-"))), ".")


def likeness(a: str, b: str) -> Column:
    """Share of equal hashes among those that either side has; 0 to 1."""
    pair = F.zip_with(a, b, lambda x, y: F.when(x == y, 1).when(x.isNotNull() | y.isNotNull(), 0))
    used = F.filter(pair, lambda v: v.isNotNull())
    same = F.filter(used, lambda v: v == 1)
    return F.when(F.size(used) > 0, F.size(same) / F.size(used)).otherwise(F.lit(0.0))


def _binned(df: DataFrame, key: str, bounds: list[int]) -> DataFrame:
    """``df`` plus ``__bin``: how many of the sorted ``bounds`` are at most
    ``key``, found in two steps of about the root of their number each."""
    side = max(1, math.isqrt(len(bounds)))
    rows = [bounds[i:i + side] for i in range(0, len(bounds), side)]
    heads = F.array(*[F.lit(r[0]).cast("bigint") for r in rows])
    table = F.array(*[F.array(*[F.lit(v).cast("bigint") for v in r]) for r in rows])
    below = lambda values: F.size(F.filter(values, lambda v: v <= F.col(key)))
    df = df.withColumn("__row", below(heads))
    inside = F.when(F.col("__row") > 0, (F.col("__row") - 1) * side + below(F.get(table, F.col("__row") - 1)))
    return df.withColumn("__bin", F.coalesce(inside, F.lit(0)).cast("long")).drop("__row")


def _ranged(df: DataFrame, key: str) -> DataFrame:
    """``df`` plus ``__bin`` and ``__range`` of the non-null long ``key``: bins
    between quantiles of the key, ranges of equal width inside a bin, about
    ``RANGE_ROWS`` rows each. Keys far from the others widen the ranges of their
    own bin alone. ``__range`` rises with the key."""
    n = df.count()
    bins = max(1, min(BINS, n // RANGE_ROWS))
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    bounds = df.agg(F.percentile_approx(key, shares, F.lit(10 * bins)).alias("q")).first()["q"] if bins > 1 else []
    df = _binned(df, key, sorted(set(bounds or []))) if bounds else df.withColumn("__bin", F.lit(0).cast("long"))
    stats = df.groupBy("__bin").agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    wide = F.expr(f"greatest(1D, ceil((double(hi) - double(lo) + 1) * {RANGE_ROWS} / n))")
    stats = F.broadcast(stats.select("__bin", "lo", wide.alias("wide")))          # BINS + 1 rows at most
    place = F.floor((F.col(key).cast("double") - F.col("lo").cast("double")) / F.col("wide")).cast("long")
    return df.join(stats, "__bin").withColumn("__range", F.col("__bin") * (1 << 40) + place).drop("lo", "wide")


def with_next(df: DataFrame, key: str, columns: list[str],
              prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``prepare(df)`` plus ``next_<c>`` for ``columns`` of it: the values of the
    next row in descending order of the long ``key`` (after the last: the first).
    ``prepare`` works row by row.

    Rows meet in ranges of the key; each range also gets the first row of
    the range below it, so no task sees more than its range. Rows with equal
    keys follow each other by ``columns``; a null key comes last.
    """
    lowest = -(1 << 63)
    df = df.withColumn("__k", F.coalesce(F.col(key).cast("long"), F.lit(lowest)))
    real = _ranged(df.where(F.col("__k") > lowest), "__k")
    none = df.where(F.col("__k") == lowest).withColumn("__bin", F.lit(-1).cast("long")).withColumn(
        "__range", F.lit(-1).cast("long"))
    df = real.unionByName(none)
    heads = df.groupBy("__bin", "__range").agg(F.max("__k").alias("__head"))
    ranges, _ = staged(heads, "ranges")                     # one row per RANGE_ROWS documents
    # The next range in its bin, else the first one of the next bin, else the first of all.
    firsts = ranges.groupBy("__bin").agg(F.min("__range").alias("__first"))
    order = W.orderBy("__bin")                              # BINS + 2 rows at most
    firsts = firsts.select("__bin", F.coalesce(F.lead("__first").over(order), F.min("__first").over(W.partitionBy()))
                           .alias("__after"))
    after = F.lead("__range").over(W.partitionBy("__bin").orderBy("__range"))
    ranges = ranges.join(F.broadcast(firsts), "__bin").select("__head", F.coalesce(after, "__after").alias("__to"))
    mine = F.struct(*columns)
    few = ranges.count() <= BROADCAST_IDS
    guests = (prepare(df.join(F.broadcast(ranges) if few else ranges, F.col("__k") == F.col("__head")))
              .groupBy("__to").agg(F.min(mine).alias("__row")))
    df = prepare(df).drop("__bin")
    own = df.select("*", F.lit(False).alias("__guest"))
    extra = guests.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in columns
                            else F.col(f"__row.`{f.name}`").alias(f.name)
                            for f in df.schema.fields if f.name != "__range"],
                          F.col("__to").alias("__range"), F.lit(True).alias("__guest"))
    w = W.partitionBy("__range").orderBy("__guest", F.desc("__k"), *columns)
    out = own.unionByName(extra)
    for c in columns:
        out = out.withColumn(f"next_{c}", F.lead(c).over(w))
    return out.where(~F.col("__guest")).drop("__k", "__range", "__guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs(doc_id, text, ...)`` and of its
    edited form, whose last half is the start of the next document's text.

    Returns ``doc_id, n_chars, edited_text, fingerprint, edited_fingerprint,
    near_edited, near_next``; other columns are ignored. A null text is
    empty; texts without terms share one fingerprint; a text without terms in
    any subset is hashed over all its terms; equal texts (also repeated rows)
    have equal fingerprints; an only document is its own next one; an empty
    table gives an empty one.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    inside = membership(lexicon(rows.select("text")))
    signed = with_next(rows, "doc_id", ["text", "sig"], lambda df: with_signatures(df, "text", "sig", inside))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = signed.select(
        "doc_id", n.cast("long").alias("n_chars"), "sig", "next_sig",
        F.concat(F.substring("text", F.lit(1), n - half),
                 F.substring("next_text", F.lit(1), half)).alias("edited_text"))
    both = with_signatures(edited, "edited_text", "edited_sig", inside)
    return both.select("doc_id", "n_chars", "edited_text", fingerprint("sig").alias("fingerprint"),
                       fingerprint("edited_sig").alias("edited_fingerprint"),
                       likeness("sig", "edited_sig").alias("near_edited"),
                       likeness("sig", "next_sig").alias("near_next"))
