"""Scaling parity with Spark ML; LDA output shape."""

import numpy as np
from pyspark.sql import functions as F

from maillens.operators import features as FE

SF = "/root/testdata/sf0.001"


def test_standardize_matches_ml_scaler(spark):
    from pyspark.ml.feature import StandardScaler

    rows = [(i, float(i % 7), float((i * 3) % 11), 5.0) for i in range(40)]   # c: zero variance
    df = spark.createDataFrame(rows, "k int, a double, b double, c double")
    ours = {r.k: (r.a, r.b, r.c) for r in FE.standardize(df, ["a", "b", "c"]).collect()}
    vec = FE.assemble(df, ["a", "b", "c"])
    for with_mean in (True, False):
        model = StandardScaler(inputCol="features", outputCol="s", withMean=with_mean,
                               withStd=True).fit(vec)
        lib = {r.k: r.s.toArray() for r in model.transform(vec).collect()}
        mine = ours if with_mean else {
            r.k: (r.a, r.b, r.c)
            for r in FE.standardize(df, ["a", "b", "c"], with_mean=False).collect()}
        for k, v in lib.items():
            np.testing.assert_allclose(mine[k], v, rtol=1e-12, atol=1e-12)
    assert all(v[2] == 0.0 for v in ours.values())


def test_fit_on_training_part_only(spark):
    df = spark.createDataFrame([(1.0, True), (3.0, True), (100.0, False)], "a double, tr boolean")
    out = FE.standardize(df, ["a"], fit_on=df.where("tr")).collect()
    assert [round(r.a, 6) for r in out] == [-0.707107, 0.707107, 69.296465]


def test_lda_topics_shape(spark):
    from maillens.operators import terms as TM
    from maillens.operators import topics as TP

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    words = TM.tokenize(docs)
    vocab = TM.vocabulary(TM.term_stats(words), 200)
    counted = TM.count_model(vocab).transform(words)
    feats = TM.fit_idf(counted).transform(counted).select("doc_id", "features").persist()
    model = TP.fit_lda(feats, k=3, max_iter=5)
    tbl = TM.vocabulary_table(spark, vocab)
    desc = TP.describe(model, tbl).orderBy("topic").collect()
    assert [r.topic for r in desc] == [0, 1, 2]
    for r in desc:
        assert len(r.topic_desc) == 10 and set(r.topic_desc) <= set(vocab)
        assert list(r.termWeights) == sorted(r.termWeights, reverse=True)
        assert [vocab[i] for i in r.termIndices] == list(r.topic_desc)
    terms = TP.topic_terms(model, tbl)
    assert terms.count() == 30
    assert terms.agg(F.max("rank")).first()[0] == 9


def test_null_labels_go_to_side_output(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 0.0)], "k int, label double")
    ok, rejected = FE.split_by_label(df)
    assert sorted(r.k for r in ok.collect()) == [1, 3]
    assert [r.k for r in rejected.collect()] == [2]


def test_prepared_rejects_non_binary_labels(spark):
    import pytest

    from maillens.plans.classification import prepared
    df = spark.createDataFrame([(1, 2.0, 0, 1.0)], "key long, label double, part int, a double")
    with pytest.raises(ValueError):
        prepared(df, ["a"])


def test_prepared_rejects_null_labels(spark):
    import pytest

    from maillens.plans.classification import prepared
    df = spark.createDataFrame([(1, None, 0, 1.0)], "key long, label double, part int, a double")
    with pytest.raises(ValueError):
        prepared(df, ["a"])


def test_long_form_equals_flattened_vectors(spark):
    from maillens.operators import terms as TM

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    words = TM.tokenize(docs).persist()
    vocab = TM.vocabulary(TM.term_frequencies(words), 300)
    counted = TM.count_model(vocab).transform(words)
    model = TM.fit_idf(counted)
    vectors = model.transform(counted)
    tbl = TM.vocabulary_table(spark, vocab)
    flat = {(r.doc_id, r.term): r.v for r in
            TM.flatten_vector(vectors, "doc_id", "features", tbl, "v").collect()}
    long = {(r.doc_id, r.term): r.tfidf for r in
            TM.tfidf_long(words, TM.idf_table(spark, vocab, model), vocab).collect()}
    assert flat == long
    cnt = {(r.doc_id, r.term): r.n for r in
           TM.flatten_vector(vectors, "doc_id", "raw_features", tbl, "n").collect()}
    assert cnt == {(r.doc_id, r.term): float(r.n) for r in
                   TM.term_counts_long(words, vocab).collect()}
    stats = TM.ranked_stats(words, 300)
    assert [r.term for r in stats] == vocab
    rows = TM.idf_rows(stats, words.count())
    assert [r[2:] for r in rows] == [(r.df, r.idf) for r in TM.idf_table(spark, vocab, model).collect()]
    for df in (TM.term_stats(words), TM.term_counts_long(words, vocab), TM.tfidf_textbook(words, stats, 5)):
        assert "hashpartitioning(doc_id" not in df._jdf.queryExecution().executedPlan().toString()


def test_topics_do_not_depend_on_file_splits(spark):
    from maillens.operators import terms as TM
    from maillens.operators import topics as TP

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    words = TM.tokenize(docs)
    vocab = TM.vocabulary(TM.term_frequencies(words), 100)
    counted = TM.count_model(vocab, output_col="features").transform(words).select("doc_id", "features")
    got = []
    for n in (2, 5):
        data = TP.fixed_layout(counted.repartition(n), partitions=3).persist()
        got.append([(r.topic, list(r.termIndices)) for r in
                    TP.topic_table(TP.fit_lda(data, k=3, max_iter=3)).orderBy("topic").collect()])
    assert got[0] == got[1]


def test_doc_features_count_before_the_join(spark, tmp_dir):
    """Texts were shuffled for the join and read once per character class."""
    import contextlib
    import io
    import re

    from maillens.sources import fixtures as fx

    texts = ["Ab 09.,\n@*#", "", None, "é😀Z z١Ａ\x00.", "x" * 70_000 + " 5"]
    docs = [(i, t, 7 * i) for i, t in enumerate(texts)] + [(1, "a.", 9), (None, "b", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_dir}/documents.parquet")
    labels = [(i, i % 2) for i in range(len(texts))] + [(4, 1), (99, 0), (None, 1)]
    spark.createDataFrame(labels, "doc_id long, quality long").write.parquet(f"{tmp_dir}/labels.parquet")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = fx.doc_features(spark, tmp_dir)
        found = sorted(map(tuple, df.collect()))
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            df.explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)

    def counts(t):
        return [None] * 9 if t is None else [len(t), *[sum(c in chars for c in t) for _, chars in fx.COUNTED_CLASSES]]

    expected = [(d, q, n, *counts(t)) for d, t, n in docs for i, q in labels if d == i is not None]
    assert sorted(expected) == found
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan.getvalue())
    assert moved and not any("text#" in m for m in moved)


def test_class_counts_of_a_slice(spark):
    import pyarrow as pa

    from maillens.sources import fixtures as fx

    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["AAA", None, "b.1"]}).slice(1)
    (out,) = fx._count_classes(iter([batch]))
    assert out.to_pylist()[0]["n_lower"] is None
    assert [out.to_pylist()[1][c] for c in ("doc_id", "n_upper", "n_lower", "n_digit", "n_stop")] == [3, 0, 1, 1, 1]
