"""Benchmark decontamination by size-partitioned MinHash containment.

A test item is short, a document may be long, so plain MinHash would see
almost no likeness. Documents are therefore partitioned by the size of
their shingle set (class ``p``: at most ``2**p`` shingles), and each class
has its own one-permutation MinHash with ``2**(p + SPREAD)`` bins: the hash's
leading bits name the bin, the smallest hash of a bin is its entry. Items
are signed once for every class that can hold them. As bins outnumber a
document's shingles by ``2**SPREAD``, a shared shingle is its document's
entry with probability ``(1 - exp(-r)) / r >= 0.94`` for ``r = 2**-SPREAD``,
whatever the document's length; an item with ``c`` shared shingles is missed
only if fewer than a quarter of its ``q`` entries meet.

Candidates are verified by exact containment of the item's shingle set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillens.llm.common import release, rows_of, staged

WORDS = 5               # shingle length
SPREAD = 3              # bins per shingle, as a power of two
CONTAINED = 75          # least share of an item's shingles, in hundredths
MAX_CLASS = 31          # documents of up to 2**31 shingles: any string
BROADCAST_ROWS = 2_000_000   # index entries (24 bytes each) that are broadcast


def words(text: str | Column) -> Column:
    """Lower-cased words between white space (null: none)."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+", -1),
                    lambda w: w != "")


def shingled(df: DataFrame, key: str) -> DataFrame:
    """(key, shingles): sorted distinct five-word shingle hashes of ``text``;
    fewer words: the whole sequence as one; none: an empty array."""
    ws = df.select(F.col(key).alias(key), words("text").alias("ws"))
    runs = F.transform(
        F.slice("ws", 1, F.greatest(F.size("ws") - (WORDS - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get("ws", i + k) for k in range(1, WORDS)]))
    return ws.select(key, F.when(F.size("ws") >= WORDS, F.array_sort(F.array_distinct(runs)))
                     .when(F.size("ws") > 0, F.array(F.xxhash64(F.array_join("ws", " "), F.size("ws"))))
                     .otherwise(F.array().cast("array<bigint>")).alias("shingles"))


def size_class(n: Column) -> Column:
    """Smallest p with n <= 2**p."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1)))


def entries(shingles: str, p: Column) -> Column:
    """Smallest hash of every bin; needs ``shingles`` sorted."""
    bits = F.lit(64 - SPREAD) - p
    return F.filter(F.col(shingles), lambda x, i: (i == 0) | (
        F.call_function("shiftright", x, bits)
        != F.call_function("shiftright", F.get(F.col(shingles), i - 1), bits)))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items contained in documents.

    ``docs(doc_id, text, ...)``, ``benchmark(item_id, text, ...)``; other
    columns are ignored. Returns ``doc_id, item_id, n_item, n_shared,
    containment``: one row per document and item with 100 * n_shared >= 75 *
    n_item, where n_item counts the item's shingles. Rows without a key and
    texts without words match nothing; a text of one to four words only
    matches the same whole text; rows that repeat a key are merged (the
    largest overlap counts); an empty table gives an empty result.
    """
    items, item_path = staged(
        shingled(benchmark.where("item_id is not null"), "item_id")
        .select("*", F.size("shingles").cast("long").alias("n_item")), "items")
    index, index_path = staged(
        items.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(MAX_CLASS))))
        .where(100 * F.pow(F.lit(2.0), F.col("p")) >= CONTAINED * F.col("n_item"))
        .select("item_id", "n_item", "p", F.explode(entries("shingles", F.col("p"))).alias("entry")), "index")
    known = docs.where("doc_id is not null").select("doc_id", "text")
    # No filter on the arrays: pushed below them it would compute them again.
    signed = (shingled(known, "doc_id")
              .select("doc_id", size_class(F.size("shingles")).alias("p"), "shingles")
              .select("doc_id", "p", F.explode(entries("shingles", F.col("p"))).alias("entry")))
    small = index.count() <= BROADCAST_ROWS
    met = signed.join(F.broadcast(index) if small else index, ["p", "entry"])
    candidates, candidate_path = staged(
        met.groupBy("doc_id", "item_id").agg(F.count("*").alias("met"), F.max("n_item").alias("q"))
        .where("met >= greatest(1, floor(q / 4))").select("doc_id", "item_id"), "candidates")
    full = shingled(rows_of(known, candidates.select("doc_id").distinct(), "doc_id"), "doc_id")
    test = items.select("item_id", "n_item", F.col("shingles").alias("wanted"))
    verified = (full.join(candidates, "doc_id").join(test, "item_id")
                .select("doc_id", "item_id", "n_item",
                        F.size(F.array_intersect("wanted", "shingles")).cast("long").alias("n_shared"))
                .where(100 * F.col("n_shared") >= CONTAINED * F.col("n_item"))
                .groupBy("doc_id", "item_id").agg(F.max("n_item").alias("n_item"),
                                                  F.max("n_shared").alias("n_shared")))
    result, _ = staged(verified, "leaks")
    release(docs.sparkSession, item_path, index_path, candidate_path)
    return result.withColumn("containment", F.col("n_shared") / F.col("n_item"))
