"""Near-duplicate groups of documents with SuperMinHash.

Words are the runs of bytes other than blank, tab and line ends, with A-Z
lower-cased; a document's set holds its distinct five-word shingles (64-bit
hashes; fewer words: the whole sequence as one shingle). Per document one
SuperMinHash signature is taken: element ``e`` visits the slots in a keyed
random order and offers slot ``order_e(j)`` the value ``j + uniform_e(j)``.
Round ``j`` cannot lower a slot that already holds less than ``j``, so a
document leaves the rounds as soon as all its slots do (early stopping).

Band keys bring alike documents together, links are confirmed on the full
sets, and connected components of the confirmed links are the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillens.llm.common import (
    GOLD,
    components,
    mix,
    release,
    rows_of,
    staged,
    text_blocks,
    tidy,
)

SLOTS = 128                # signature length
ROWS = 4                   # slots per band: 32 bands miss a pair at 0.75 once in 190,000
WORDS = 5                  # shingle length
PERCENT = 75               # least similarity, in hundredths

_BASE = np.uint64(0x100000001B3 * 0x9E3779B1 % (1 << 64) | 1)
_SLOT_SALT = np.uint64(0xD6E8FEB86659FD93)
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                  0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False
_VALUE = np.arange(256, dtype=np.uint64)
_VALUE[65:91] += np.uint64(32)
_VALUE += np.uint64(1)

_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i <= n."""
    global _powers, _inverse
    if len(_powers) <= n:
        size = max(n + 1, 1 << 20)
        back = pow(int(_BASE), -1, 1 << 64)
        tables = []
        for base in (_BASE, np.uint64(back)):
            t = np.full(size, base, dtype=np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        _powers, _inverse = tables
    return _powers, _inverse


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of every text and the total)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    is_word = _IS_WORD[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True                                   # a text border cuts a word
    starts = is_word.copy()
    starts[1:] &= ~is_word[:-1] | cut[1:n]
    ends = is_word.copy()
    ends[:-1] &= ~is_word[1:] | cut[1:n]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    power, inverse = _power_tables(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUE[data] * power[:n], out=total[1:])
    h = (total[e] - total[s]) * inverse[s]
    h += (e - s).astype(np.uint64) * np.uint64(GOLD)
    return mix(h), np.searchsorted(s, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes text by text, their offsets)."""
    words, first = word_hashes(data, offsets)
    count = np.diff(first)
    n_sh = np.where(count >= WORDS, count - WORDS + 1, np.minimum(count, 1))
    at = np.concatenate(([0], np.cumsum(n_sh)))
    out = np.empty(at[-1], dtype=np.uint64)
    whole = np.flatnonzero(count >= WORDS)
    if len(whole):
        mult = words[:, None] * _MULT[None, :] if len(words) < 1 << 12 else None
        run = np.zeros(max(0, len(words) - WORDS + 1), dtype=np.uint64)
        for k in range(WORDS):
            part = mult[:, k] if mult is not None else words * _MULT[k]
            run += part[k:len(words) - WORDS + 1 + k]
        run = mix(run)
        take = np.ones(len(run), dtype=bool)              # drop runs over a text border
        for k in range(1, WORDS):
            past = first[1:-1] - k
            take[past[(past >= 0) & (past < len(run))]] = False
        keep = np.flatnonzero(take)
        owner = np.searchsorted(first, keep, side="right") - 1
        good = count[owner] >= WORDS
        keep, owner = keep[good], owner[good]
        out[at[owner] + keep - first[owner]] = run[keep]
    short = np.flatnonzero((count > 0) & (count < WORDS))
    if len(short):
        acc = count[short].astype(np.uint64) * np.uint64(GOLD)
        for k in range(WORDS - 1):
            there = k < count[short]
            idx = np.where(there, first[short] + k, 0)
            acc += np.where(there, words[idx] * _MULT[k], np.uint64(k + 1))
        out[at[short]] = mix(acc)
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a > 1:
            out[a:b].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = out[1:] != out[:-1]
    new[at[:-1][n_sh > 0]] = True
    running = np.concatenate(([0], np.cumsum(new)))
    return out[new], running[at]


def signatures(elements: np.ndarray, at: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures, one row of ``slots`` values per set.

    Value ``j + uniform`` is kept as the integer ``(j << 56) + 56 random
    bits``; slots of an empty set stay at the largest integer.
    """
    n_sets = len(at) - 1
    sig = np.full((n_sets, slots), np.iinfo(np.uint64).max, dtype=np.uint64)
    flat = sig.reshape(-1)
    size = np.diff(at)
    live = np.flatnonzero(size > 0)
    elem = elements
    row = np.repeat(np.arange(n_sets, dtype=np.int64) * slots, size)
    order = None                                           # one permutation per element
    for j in range(slots):
        bits = mix(elem + np.uint64((j + 1) * GOLD % (1 << 64)))
        k = j + ((bits & np.uint64(0xFF_FFFF)) % np.uint64(slots - j)).astype(np.int64)
        value = (bits >> np.uint64(8)) + np.uint64(j << 56)
        if j == 0:
            slot, first_k = k, k
        else:
            line = np.arange(len(elem))
            if order is None:
                order = np.tile(np.arange(slots, dtype=np.uint8), (len(elem), 1))
                order[line, first_k] = 0
                order[:, 0] = first_k
            slot = order[line, k].astype(np.int64)
            order[line, k] = order[:, j]
            order[:, j] = slot
        np.minimum.at(flat, row + slot, value)
        done = sig[live].max(axis=1) < np.uint64((j + 1) << 56) if j + 1 < 256 else None
        if done.all():
            break
        if done.any():
            stays = np.zeros(n_sets, dtype=bool)
            live = live[~done]
            stays[live] = True
            pick = stays[row // slots]
            elem, row, first_k = elem[pick], row[pick], first_k[pick]
            order = order[pick] if order is not None else None
    return sig


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` slots."""
    n, slots = sig.shape
    bands = slots // rows
    acc = np.zeros((n, bands), dtype=np.uint64)
    parts = sig[:, :bands * rows].reshape(n, bands, rows)
    for k in range(rows):
        acc += mix(parts[:, :, k] ^ _SLOT_SALT) * _MULT[k % len(_MULT)]
        acc = mix(acc)
    return mix(acc + np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(GOLD))


def _segment_sum(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[at[1:]] - total[at[:-1]]


_SIG_SCHEMA = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for a, b, data, offsets in text_blocks(batch.column(1)):
            elements, at = shingle_sets(data, offsets)
            keys = band_keys(signatures(elements, at))
            filled = np.diff(at) > 0
            lens = np.where(filled, keys.shape[1], 0)
            bands = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(lens))), pa.int32()),
                pa.array(keys[filled].reshape(-1).view(np.int64), pa.int64()))
            salt = np.uint64(0x5851F42D4C957F2D)
            yield pa.record_batch({
                "doc_id": ids.slice(a, b - a), "n_shingles": pa.array(np.diff(at), pa.int64()),
                "set_a": pa.array(_segment_sum(mix(elements), at).view(np.int64)),
                "set_b": pa.array(_segment_sum(mix(elements ^ salt), at).view(np.int64)),
                "bands": bands})
        tidy()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for a, b, data, offsets in text_blocks(batch.column(1)):
            elements, at = shingle_sets(data, offsets)
            yield pa.record_batch({
                "id": ids.slice(a, b - a),
                "items": pa.ListArray.from_arrays(pa.array(at, pa.int32()),
                                                  pa.array(elements.view(np.int64)))})
        tidy()


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the staged ``pairs(a, b)`` whose full sets are alike enough."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets, path = staged(rows_of(texts, wanted, "doc_id").dropDuplicates(["doc_id"])
                        .mapInArrow(_sets, "id long, items array<long>"), "sets")
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("items_a", "items_b")).cast("long")
    links, _ = staged(
        both.select("a", "b", shared.alias("s"),
                    (F.size("items_a") + F.size("items_b")).cast("long").alias("n"))
        .where(100 * F.col("s") >= PERCENT * (F.col("n") - F.col("s"))).select("a", "b"), "confirmed")
    release(texts.sparkSession, path)
    return links


def _fitting(n_a: str, n_b: str) -> F.Column:
    """Set sizes that allow the wanted similarity at all."""
    return 100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b)


def _across(rest: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between different components of the same bucket.

    The full sets travel with the bucket's rows and are compared inside the
    join, in the first bucket that a pair shares, so only links come out.
    """
    sets = rows_of(texts, rest.select(F.col("id").alias("doc_id")).distinct(), "doc_id")
    sets = sets.dropDuplicates(["doc_id"]).mapInArrow(_sets, "id long, items array<long>")
    bands = classes.select(F.col("rep").alias("id"), "bands").dropDuplicates(["id"])
    full = rest.join(sets, "id").join(bands, "id")
    left = full.select("key", *[F.col(c).alias(f"{c}1") for c in ("id", "n", "g", "items", "bands")])
    right = full.select("key", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "g", "items", "bands")])
    shared = F.size(F.array_intersect("items1", "items2"))
    # In this order: a pair that fails an early test costs no more than that.
    linked = F.when((left["g1"] >= right["g2"]) | ~_fitting("n1", "n2"), False).when(
        F.get(F.array_intersect("bands1", "bands2"), F.lit(0)) != left["key"], False).otherwise(
        100 * shared >= PERCENT * (F.col("n1") + F.col("n2") - shared))
    return (left.join(right, (left["key"] == right["key"]) & linked)
            .select(F.col("id1").alias("a"), F.col("id2").alias("b")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Groups of near-duplicate documents of ``docs(doc_id, text, ...)``.

    Returns ``doc_id, n_shingles, component_id, kept``, one row per input
    row; other columns are ignored. Documents link when 100 * |A and B| >=
    75 * |A or B|. Null or wordless texts have an empty set and link with
    nothing; a row without doc_id gets a null component and is kept; rows
    that repeat a doc_id count as one document; an empty table gives none.

    Equal sets fold into their smallest doc_id first. Every band bucket
    then compares its members with its smallest one; buckets that still
    span several components afterwards compare across those components
    (sizes more than 4:3 apart can't link), so no candidate is dropped.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    signed, _ = staged(texts.mapInArrow(_sign, _SIG_SCHEMA), "signed")
    same = ["set_a", "set_b", "n_shingles"]
    classes, class_path = staged(
        signed.where("doc_id is not null and n_shingles > 0").groupBy(*same)
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes")
    texts = texts.where("doc_id is not null")

    members = classes.select(F.col("rep").alias("id"), F.col("n_shingles").alias("n"),
                             F.explode("bands").alias("key"))
    heads = (members.groupBy("key").agg(F.min(F.struct("id", "n")).alias("h"), F.count("*").alias("c"))
             .where("c > 1").select("key", "c", F.col("h.id").alias("head"), F.col("h.n").alias("head_n")))
    shared, shared_path = staged(members.join(heads, "key"), "buckets")
    star, star_path = staged(
        shared.where((F.col("id") != F.col("head")) & _fitting("n", "head_n"))
        .select(F.col("head").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    links = _confirmed(star, texts)
    groups, group_path = staged(components(links), "groups")

    labelled, label_path = staged(
        shared.where("c > 2").join(groups, F.col("id") == F.col("node"), "left")
        .select("key", "id", "n", "head", F.coalesce("component", "id").alias("g")), "labelled")
    mixed = labelled.groupBy("key").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo < hi")
    rest, rest_path = staged(labelled.join(mixed.select("key"), "key", "left_semi").where("id != head")
                             .select("key", "id", "n", "g"), "rest")
    if not rest.isEmpty():
        more, _ = staged(_across(rest, classes, texts), "across")
        if not more.isEmpty():
            groups, group_path = staged(components(links.unionByName(more)), "groups")

    named, _ = staged(
        classes.join(groups, F.col("rep") == F.col("node"), "left")
        .select(*same, F.coalesce("component", "rep").alias("component_id")), "named")
    release(spark, class_path, shared_path, star_path, label_path, rest_path, group_path)
    out = (signed.select("doc_id", *same).join(named, same, "left")
           .select("doc_id", "n_shingles",
                   F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
                   .alias("component_id")))
    return out.withColumn("kept", F.col("component_id").isNull()
                          | (F.col("component_id") == F.col("doc_id")))
