"""EM topics: one round against plain Python, any partitioning, coherence."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from maillens.operators import lda as LDA

K, WORDS = 3, 12


def corpus(n=60):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        terms = sorted(rnd.sample(range(WORDS), rnd.randrange(0, 7)))
        rows.append((i, terms, [float(rnd.randrange(1, 5)) for _ in terms]))
    return rows


IDF = [0.3 + 0.1 * i for i in range(WORDS)]


def cells(spark, rows, parts):
    df = spark.createDataFrame(rows, "doc_id long, terms array<int>, n array<double>").repartition(parts)
    return LDA.cells(df, IDF)


def plain(spark, rows, rounds):
    """(term counts, document counts) by loops over single cells."""
    from maillens.operators.selection import bucket

    seed = {r.doc_id: r.b % LDA.PRIME for r in spark.createDataFrame([(i,) for i, _, _ in rows], "doc_id long")
            .select("doc_id", bucket(F.col("doc_id"), LDA.SALT).alias("b")).collect()}
    weights = {(d, t): int(math.floor(n * IDF[t] * LDA.UNIT + 0.5)) for d, ts, ns in rows
               for t, n in zip(ts, ns, strict=True)}

    def start(d, t, j):
        x = (seed[d] + 65537 * (t + 1) + 40503 * (j + 1)) % LDA.PRIME
        x = (x * x + 11) % LDA.PRIME
        x = (x * 48271 + 7) % LDA.PRIME
        return 1 + (x * x + 3) % LDA.PRIME

    share = {c: [start(*c, j) for j in range(K)] for c in weights}
    for r in range(rounds + 1):
        got = {c: [round(weights[c] * (s / sum(share[c]))) for s in share[c]] for c in weights}
        by_term = [[sum(g[j] for (_, t), g in got.items() if t == w) for j in range(K)] for w in range(WORDS)]
        by_doc = {d: [sum(g[j] for (e, _), g in got.items() if e == d) for j in range(K)] for d, _, _ in rows}
        if r < rounds:
            total = [sum(x[j] for x in by_term) for j in range(K)]
            share = {(d, t): [(by_term[t][j] / LDA.UNIT + LDA.ETA - 1) / (total[j] / LDA.UNIT + WORDS * (LDA.ETA - 1))
                              * (by_doc[d][j] / LDA.UNIT + LDA.alpha(K) - 1) for j in range(K)] for d, t in weights}
    return by_term, by_doc


def test_rounds_equal_plain_loops(spark):
    rows = corpus()
    for rounds in (0, 1, 7):                     # 7: past a refresh of the document counts
        model = LDA.fit(cells(spark, rows, 3), WORDS, K, rounds)
        want, docs = plain(spark, rows, rounds)
        assert model.counts.tolist() == want
        assert {r.doc_id: list(r.held) for r in model.docs.collect()} == docs


def test_topics_are_the_same_on_any_partitions(spark):
    rows = corpus(200)
    got = [LDA.fit(cells(spark, rows, n), WORDS, K, 6).counts for n in (2, 32, 40)]
    assert (got[0] == got[1]).all() and (got[0] == got[2]).all()
    assert got[0].sum() > 0


def test_shares_and_top_terms(spark):
    rows = corpus()
    model = LDA.fit(cells(spark, rows, 4), WORDS, K, 3)
    shares = {}
    for r in model.shares().collect():
        shares.setdefault(r.doc_id, []).append(r.share)
    assert len(shares) == len(rows)
    for d, terms, _ in rows:
        assert (shares[d] == [None] * K) if not terms else math.isclose(sum(shares[d]), 1.0)
    tops = LDA.top_terms(model, [f"w{i}" for i in range(WORDS)], 4)
    assert len(tops) == 4 * K
    for j in range(K):
        ranked = sorted(range(WORDS), key=lambda w: (-model.counts[w, j], w))[:4]
        assert [t[2] for t in tops if t[0] == j] == ranked


def test_coherence_equals_brute_force(spark):
    rows = corpus(120)
    model = LDA.fit(cells(spark, rows, 4), WORDS, K, 3)
    tops = LDA.top_terms(model, [f"w{i}" for i in range(WORDS)], 4)
    got = {r.topic: r.coherence for r in LDA.coherence(model.docs, LDA.topic_rows(spark, tops)).collect()}
    sets = [set(t) for _, t, _ in rows]
    for j in range(K):
        words = [t[2] for t in tops if t[0] == j]
        want = sum(math.log((sum({a, b} <= s for s in sets) + 1) / sum(b in s for s in sets))
                   for i, a in enumerate(words) for b in words[:i])
        assert math.isclose(got[j], want, rel_tol=1e-9)


def test_planted_topics_are_found(spark):
    """Documents of one of three disjoint vocabularies each, long enough to outweigh alpha."""
    rnd = random.Random(3)
    rows = [(i, sorted(rnd.sample(range(4 * (i % 3), 4 * (i % 3) + 4), 3)), [300.0] * 3) for i in range(150)]
    model = LDA.fit(cells(spark, rows, 5), WORDS, K, 30)
    block = np.array([[model.counts[4 * b:4 * b + 4, j].sum() for b in range(3)] for j in range(K)])
    assert sorted(block.argmax(axis=1).tolist()) == [0, 1, 2]


def test_documents_in_slices_give_the_same_counts(spark, monkeypatch):
    import pandas as pd

    pdf = pd.DataFrame({"seed": range(60), "terms": [t for _, t, _ in corpus()],
                        "units": [[LDA.UNIT] * len(t) for _, t, _ in corpus()]})
    whole = LDA._term_sums(K, WORDS, None)([pdf])
    monkeypatch.setattr(LDA, "CELLS", 10)
    parts = list(LDA._slices(pdf))
    assert len(parts) > 5 and sum(map(len, parts)) == len(pdf)
    assert max(sum(map(len, p["terms"])) for p in parts) < 10 + 7
    assert (LDA._term_sums(K, WORDS, None)([pdf]) == whole).all()


def test_a_cell_is_worked_on_once_a_round(monkeypatch):
    """A round's blocks hold the document counts the next one starts from."""
    import pyarrow as pa
    import pyspark

    class Context:
        get = classmethod(lambda cls: cls)
        partitionId = staticmethod(lambda: 0)  # noqa: N815

    monkeypatch.setattr(pyspark, "TaskContext", Context)
    monkeypatch.setattr(LDA, "CELLS", 50)
    rows = corpus()
    batch = pa.RecordBatch.from_arrays(
        [pa.array([i for i, _, _ in rows]), pa.array(range(60)), pa.array([t for _, t, _ in rows], pa.list_(pa.int32())),
         pa.array([[LDA.UNIT << 12] * len(t) for _, t, _ in rows], pa.list_(pa.int64()))],
        names=["doc_id", "seed", "terms", "units"])
    step, seen = LDA._step, []
    monkeypatch.setattr(LDA, "_step", lambda docs, *a: seen.append(len(docs.term)) or step(docs, *a))
    state = list(LDA._first_blocks(K, WORDS, "doc_id")([batch]))
    counts = np.frombuffer(state[-1].column("total")[0].as_py(), np.int64).reshape(WORDS, K)
    assert len(state) > 4 and counts.sum() > 0
    n_cells = sum(len(t) for _, t, _ in rows)
    for i in range(7):
        state = list(LDA._next_blocks(LDA._smoothed(counts))(state[:-1]))
        counts = np.frombuffer(state[-1].column("total")[0].as_py(), np.int64).reshape(WORDS, K)
        assert sum(seen) == (i + 1) * n_cells
    docs = pa.Table.from_batches(LDA._documents("doc_id")(state[:-1])).to_pylist()
    assert [(d["doc_id"], d["terms"]) for d in docs] == [(i, t) for i, t, _ in rows]
    assert np.array([d["held"] for d in docs]).sum(axis=0).tolist() == counts.sum(axis=0).tolist()
    assert {u for d in docs for u in d["units"]} == {LDA.UNIT << 12}
