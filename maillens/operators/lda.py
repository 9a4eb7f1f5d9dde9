"""Topics by expectation-maximisation, independent of the partitioning.

The model and its updates are those of Spark ML's EM LDA (smoothed counts
with exponents alpha - 1 and eta - 1): a cell (document d, term w, weight u)
belongs to topic k with a share proportional to

    (N_wk + eta - 1) (N_dk + alpha - 1) / (N_k + W (eta - 1))

and its weighted shares add up to the new counts. What differs is where the
numbers come from, so that the same corpus always gives the same topics:

* the first shares come from a hash of (document, term, topic), not from a
  random generator per partition;
* weights and shares are whole numbers of 1 / ``UNIT``, so sums are exact
  and no order of addition can change them.

A row holds a document's whole sparse vector, so the E-step needs no join: it
runs inside each partition with the term counts (vocabulary x topics, a
parameter's size) in the task closure. Once, the documents become blocks, a row
with the cells of many of them as plain bytes; a round is one pass that turns
blocks into blocks with the new document counts and gives one integer array per
partition, which the M-step adds (``partials.add_rows``). So every cell is worked
on once a round. A round's blocks are kept until the next stand, and written to
the shared folder every ``REFRESH`` rounds, so that a lost executor costs no more
than these.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maillens.operators.partials import add_rows, partitions
from maillens.operators.selection import bucket
from maillens.session import scratch_path

UNIT = 1 << 20          # parts of one that weights and counts are kept in
REFRESH = 5             # rounds after which the blocks are written
SALT = "topics:"
PRIME = (1 << 31) - 1   # of the start hash
CELLS = 1 << 12         # of the documents worked on together in a task, a block
ETA = 1.1               # Spark ML's default topic concentration of EM


def alpha(k: int) -> float:
    """Spark ML's default document concentration of EM."""
    return 50.0 / k + 1.0


def cells(counts: DataFrame, idf: list[float], id_col: str = "doc_id") -> DataFrame:
    """(id, seed, terms, units) of ``counts(id, terms array<int>, n
    array<double>)``: the TF-IDF weights in units; one row per document."""
    table = F.array(*[F.lit(float(v)) for v in idf])
    weight = F.zip_with("terms", "n", lambda t, n: F.round(n * F.get(table, t) * UNIT).cast("long"))
    return counts.select(id_col, (bucket(F.col(id_col), SALT) % PRIME).alias("seed"), "terms",
                         weight.alias("units"))


# ---------------------------------------------------------------- one partition


@dataclass
class _Docs:
    """A batch of documents, cells end to end."""

    term: np.ndarray       # of every cell
    units: np.ndarray
    doc: np.ndarray        # row of every cell
    n: int

    def sums(self, per_cell: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, per_cell.shape[1]), np.int64)
        if len(self.doc):
            first = np.flatnonzero(np.concatenate(([True], self.doc[1:] != self.doc[:-1])))
            out[self.doc[first]] = np.add.reduceat(per_cell, first, axis=0)     # whole numbers
        return out


def _docs(pdf: pd.DataFrame) -> _Docs:
    size = pdf["terms"].map(len).to_numpy()
    flat = lambda c: np.concatenate([np.zeros(0, np.int64), *pdf[c]]).astype(np.int64)
    return _Docs(flat("terms"), flat("units"), np.repeat(np.arange(len(pdf)), size), len(pdf))


def _slices(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """A batch in runs of documents of about ``CELLS`` cells, so that a task's
    arrays (cells x topics) do not grow with the batch."""
    ends = pdf["terms"].map(len).to_numpy().cumsum()
    cuts = np.flatnonzero(np.diff(ends // CELLS)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(pdf)], strict=True):
        if b > a:
            yield pdf.iloc[a:b].reset_index(drop=True)


def _add_by_term(total: np.ndarray, term: np.ndarray, got: np.ndarray) -> None:
    """``total[term] += got`` with repeated terms added up (whole numbers)."""
    if len(term):
        order = np.argsort(term, kind="stable")
        at = term[order]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        total[at[first]] += np.add.reduceat(got[order], first, axis=0)


def _start(docs: _Docs, seed: np.ndarray, k: int) -> np.ndarray:
    x = (seed[docs.doc][:, None] + 65537 * (docs.term[:, None] + 1) + 40503 * np.arange(1, k + 1)[None, :]) % PRIME
    x = (x * x + 11) % PRIME
    x = (x * 48271 + 7) % PRIME
    x = 1 + (x * x + 3) % PRIME
    return np.rint(docs.units[:, None] * (x / x.sum(axis=1)[:, None])).astype(np.int64)


def _step(docs: _Docs, by_doc: np.ndarray, by_term: np.ndarray) -> np.ndarray:
    """Weighted shares (cells x topics) from document counts and the
    smoothed, normalised term counts: whole numbers, as floats."""
    k = by_term.shape[1]
    share = by_term[docs.term]
    share *= (by_doc / UNIT + (alpha(k) - 1.0))[docs.doc]
    share /= share.sum(axis=1)[:, None]
    share *= docs.units[:, None]
    return np.rint(share, out=share)


def _smoothed(counts: np.ndarray) -> np.ndarray:
    """(N_wk + eta - 1) / (N_k + W (eta - 1)) of counts in units."""
    return (counts / UNIT + (ETA - 1.0)) / (counts.sum(axis=0) / UNIT + len(counts) * (ETA - 1.0))


def _sums_by_term(docs: _Docs, got: np.ndarray, size: int) -> np.ndarray:
    """(size x topics) sums of a block's shares; whole numbers, far below 2**53."""
    k = got.shape[1]
    at = (docs.term[:, None] * k + np.arange(k)).ravel()
    return np.bincount(at, got.ravel(), size * k).astype(np.int64).reshape(size, k)


def _term_sums(k: int, size: int, keep: Callable[[pd.DataFrame, _Docs, np.ndarray], None] | None):
    """Term counts of the start over pandas batches; ``keep`` is handed every
    run of documents with its counts."""
    def run(batches: Iterator[pd.DataFrame]) -> np.ndarray:
        total = np.zeros((size, k), np.int64)
        for pdf in (part for batch in batches for part in _slices(batch)):
            docs = _docs(pdf)
            got = _start(docs, pdf["seed"].to_numpy(), k)
            _add_by_term(total, docs.term, got)
            if keep is not None:
                keep(pdf, docs, docs.sums(got))
        return total
    return run


# ---------------------------------------------------------------- blocks

# A block's row (``ids`` first); the last row of a task has the ``total`` of its blocks instead.
_BLOCK = ("seeds", "sizes", "terms", "units", "held")


def _block_schema(cells_: DataFrame, id_col: str) -> str:
    kind = cells_.schema[id_col].dataType.simpleString()
    return f"ids array<{kind}>, {', '.join(f'{c} binary' for c in _BLOCK)}, task bigint, total binary"


def _block_row(ids: pa.Array, *data: np.ndarray) -> pa.RecordBatch:
    columns = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
    columns += [pa.array([d.tobytes()], pa.binary()) for d in data]
    return pa.RecordBatch.from_arrays([*columns, pa.array([None], pa.int64()), pa.array([None], pa.binary())],
                                      names=["ids", *_BLOCK, "task", "total"])


def _total_row(kind: pa.DataType, total: np.ndarray) -> pa.RecordBatch:
    from pyspark import TaskContext

    columns = [pa.array([None], pa.list_(kind)), *[pa.array([None], pa.binary()) for _ in _BLOCK]]
    columns += [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["ids", *_BLOCK, "task", "total"])


def _narrow(whole: np.ndarray, *kinds: type) -> np.ndarray:
    """Whole numbers from 0 as the first of ``kinds`` that holds them."""
    most = whole.max(initial=0)
    return whole.astype(next(t for t in kinds if most <= np.iinfo(t).max))


def _opened(batch: pa.RecordBatch, i: int) -> tuple[_Docs, np.ndarray]:
    """A block's documents and their counts."""
    sizes, terms, units, held = (batch.column(c)[i].as_buffer() for c in ("sizes", "terms", "units", "held"))
    sizes = np.frombuffer(sizes, np.int32)
    n = int(sizes.sum())
    term = np.frombuffer(terms, np.uint16 if terms.size == 2 * n else np.int32).astype(np.int64)
    unit = np.frombuffer(units, np.int32 if units.size == 4 * n else np.int64).astype(np.int64)
    held = np.frombuffer(held, np.int64)
    return _Docs(term, unit, np.repeat(np.arange(len(sizes)), sizes), len(sizes)), held.reshape(len(sizes), -1)


def _first_blocks(k: int, size: int, id_col: str):
    """Documents to blocks with the start's counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kind = np.zeros((size, k), np.int64), pa.null()
        for batch in batches:
            ids, made = batch.column(id_col), []
            kind = ids.type
            total += _term_sums(k, size, lambda *run, made=made: made.append(run))([batch.to_pandas()])
            at = 0
            for pdf, docs, held in made:
                sizes = np.bincount(docs.doc, minlength=docs.n).astype(np.int32)
                yield _block_row(ids.slice(at, docs.n), pdf["seed"].to_numpy().astype(np.int64), sizes,
                                 _narrow(docs.term, np.uint16, np.int32), _narrow(docs.units, np.int32, np.int64), held)
                at += docs.n
        if total.any():
            yield _total_row(kind, total)
    return run


def _next_blocks(by_term: np.ndarray):
    """Blocks with the counts that follow from ``by_term``."""
    size, k = by_term.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kind = np.zeros((size, k), np.int64), pa.null()
        for batch in batches:
            fresh = []
            for i in range(batch.num_rows):
                docs, held = _opened(batch, i)
                got = _step(docs, held, by_term)
                fresh.append(docs.sums(got).tobytes())
                total += _sums_by_term(docs, got, size)
            kind = batch.schema.field("ids").type.value_type
            yield batch.set_column(batch.schema.get_field_index("held"), "held", pa.array(fresh, pa.binary()))
        if total.any():
            yield _total_row(kind, total)
    return run


def _documents(id_col: str):
    """Blocks to one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = lambda ends, flat: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
        for batch in batches:
            for i in range(batch.num_rows):
                docs, held = _opened(batch, i)
                sizes = np.frombuffer(batch.column("sizes")[i].as_buffer(), np.int32)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, pa.array(np.frombuffer(batch.column("seeds")[i].as_buffer(), np.int64)),
                     lists(ends, pa.array(docs.term.astype(np.int32))), lists(ends, pa.array(docs.units)),
                     lists(np.arange(docs.n + 1) * held.shape[1], pa.array(held.ravel()))],
                    names=[id_col, "seed", "terms", "units", "held"])
    return run


# ---------------------------------------------------------------- fitting


@dataclass
class Topics:
    """Counts of a fit, in units: terms x topics, and the documents' table
    (id, seed, terms, units, held) whose ``held`` are the last round's."""

    counts: np.ndarray
    docs: DataFrame
    id_col: str

    def shares(self) -> DataFrame:
        """(id, topic, share): every document's counts over their sum, null for
        a document without weight."""
        total = F.aggregate("held", F.lit(0).cast("long"), lambda a, x: a + x)
        share = F.transform("held", lambda x: F.when(total > 0, x / total))
        return self.docs.select(self.id_col, F.posexplode(share).alias("topic", "share"))


def _written(blocks: DataFrame) -> DataFrame:
    """The blocks, read from where they are written in the shared folder."""
    spark: SparkSession = blocks.sparkSession
    path = scratch_path(spark, "topic-counts")
    blocks.write.parquet(path)
    return spark.read.parquet(path)


def fit(cells_: DataFrame, size: int, k: int, max_iter: int, id_col: str = "doc_id") -> Topics:
    """EM over ``cells``'s rows with terms 0 .. ``size`` - 1, ``max_iter``
    rounds. One job per round; a round's blocks are kept until the next stand."""
    schema = _block_schema(cells_, id_col)

    def kept(blocks: DataFrame) -> tuple[DataFrame, np.ndarray]:
        blocks = blocks.persist()
        totals = blocks.where("total is not null").select("task", "total")
        return blocks, add_rows(totals, size * k, partitions(blocks), np.int64).reshape(size, k)

    data, counts = kept(cells_.mapInArrow(_first_blocks(k, size, id_col), schema))
    for i in range(1, max_iter + 1):
        fresh = data.where("total is null").mapInArrow(_next_blocks(_smoothed(counts)), schema)
        fresh, counts = kept(_written(fresh) if i % REFRESH == 0 else fresh)
        data.unpersist()
        data = fresh
    blocks = data if max_iter and max_iter % REFRESH == 0 else _written(data)
    data.unpersist()
    kinds = ", ".join(f"`{c}` {cells_.schema[c].dataType.simpleString()}" for c in (id_col, "seed", "terms", "units"))
    docs = blocks.where("total is null").mapInArrow(_documents(id_col), f"{kinds}, held array<bigint>")
    return Topics(counts, docs, id_col)


# ---------------------------------------------------------------- description


def top_terms(model: Topics, vocab: list[str], n: int) -> list[tuple[int, int, int, str, float]]:
    """(topic, rank, term_index, term, weight): each topic's ``n`` heaviest
    terms, weight = N_wk / N_k; ties go to the smaller term index."""
    total = model.counts.sum(axis=0)
    out = []
    for j in range(model.counts.shape[1]):
        order = np.lexsort((np.arange(len(vocab)), -model.counts[:, j]))[:n]
        out += [(j, r, int(w), vocab[w], float(model.counts[w, j] / max(1, total[j]))) for r, w in enumerate(order)]
    return out


def topic_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "topic int, rank int, term_index int, term string, weight double")


def coherence(docs: DataFrame, tops: DataFrame) -> DataFrame:
    """(topic, coherence): UMass coherence of each topic's terms,
    sum over ranks i > j of ln((D(i, j) + 1) / D(j)), with D the number of
    documents that hold both terms (or the one).

    ``docs`` holds ``terms array<int>`` per document; ``tops`` is
    ``topic_rows``. One aggregate counts all pairs of listed terms: it has at
    most (topics x terms per topic)^2 / 2 groups, summed map-side.
    """
    listed = sorted({r["term_index"] for r in tops.select("term_index").collect()})
    present = F.array_sort(F.array_intersect("terms", F.array(*[F.lit(t) for t in listed])))
    pairs = F.flatten(F.transform("held", lambda a: F.transform(
        F.filter("held", lambda b: b >= a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    counted = (docs.select(present.alias("held")).select(F.inline(pairs)).groupBy("a", "b")
               .agg(F.count(F.lit(1)).alias("d")))
    one = tops.select("topic", F.col("rank").alias("j"), F.col("term_index").alias("wj"))
    two = tops.select("topic", F.col("rank").alias("i"), F.col("term_index").alias("wi"))
    wanted = (one.join(two, "topic").where("i > j")
              .select("topic", "wj", F.least("wi", "wj").alias("a"), F.greatest("wi", "wj").alias("b")))
    alone = counted.where("a = b").select(F.col("a").alias("wj"), F.col("d").alias("dj"))
    return (wanted.join(counted, ["a", "b"], "left").join(alone, "wj")
            .groupBy("topic").agg(F.sum(F.log((F.coalesce("d", F.lit(0)) + 1) / F.col("dj"))).alias("coherence")))
