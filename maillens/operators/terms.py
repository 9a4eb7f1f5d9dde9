"""Term statistics, vocabulary, count vectors and TF-IDF.

Long form ``(doc_id, term, value)`` is the distributed representation;
ML vectors (``CountVectorizerModel`` / ``IDF``) are produced for the topic
model. The only driver round trips are bounded by parameters: the
vocabulary (``size`` terms) and the document count (one number).
"""

from __future__ import annotations

import math

from pyspark.ml.feature import IDF, CountVectorizerModel, IDFModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillens.functions.text import clean_text, round6
from maillens.operators.joins import small_side

VOCAB_SIZE = 1000
IDF_SCHEMA = "term_index int, term string, df long, idf double"


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             stopwords: tuple[str, ...] | None = None) -> DataFrame:
    """(id, words): cleaned tokens per document (F5..F9); null text = ''."""
    return docs.select(F.col(id_col), clean_text(F.col(text_col), stopwords).alias("words"))


def exploded_terms(words: DataFrame, id_col: str = "doc_id", *extra) -> DataFrame:
    """(id, extra..., term): one row per token.

    ``explode_outer`` + a null filter gives the rows of ``explode`` but
    keeps the optimizer from inferring ``size(words) > 0`` below the
    generator, which would evaluate the whole cleaning expression twice.
    """
    return (words.select(id_col, *extra, F.explode_outer("words").alias("term"))
            .where(F.col("term").isNotNull()))


def term_stats(words: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(term, tf, df): corpus count and document frequency of every term.

    Every document gives one (term, 1, 0) per token and one (term, 0, 1) per
    distinct term; one aggregate keyed by term adds them, summed map-side, so
    what crosses the network is one row per task and term.
    """
    entry = lambda tf, df: lambda t: F.struct(t.alias("term"), F.lit(tf).alias("tf"), F.lit(df).alias("df"))
    both = F.concat(F.transform("words", entry(1, 0)), F.transform(F.array_distinct("words"), entry(0, 1)))
    return (words.select(F.inline(both)).groupBy("term")
            .agg(F.sum("tf").cast("bigint").alias("tf"), F.sum("df").cast("bigint").alias("df")))


def term_frequencies(words: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(term, tf): corpus counts only, one aggregate keyed by term
    (map-side combined); enough to rank the vocabulary."""
    return (exploded_terms(words, id_col).groupBy("term")
            .agg(F.count(F.lit(1)).alias("tf")))


def vocabulary(stats: DataFrame, size: int = VOCAB_SIZE) -> list[str]:
    """The ``size`` most frequent terms of ``stats(term, tf, ...)``; ties by
    term, so the choice is repeatable (``CountVectorizer`` breaks ties by
    partitioning).

    A top-k: every task keeps its best ``size`` rows, the driver merges
    them, so at most ``size`` terms per task travel.
    """
    top = stats.orderBy(F.desc("tf"), F.asc("term")).limit(size).select("term")
    return [r.term for r in top.collect()]


def vocabulary_table(spark, vocab: list[str]) -> DataFrame:
    """(term_index, term) for a vocabulary list."""
    return spark.createDataFrame(list(enumerate(vocab)), "term_index int, term string")


def count_model(vocab: list[str], input_col: str = "words",
                output_col: str = "raw_features") -> CountVectorizerModel:
    return CountVectorizerModel.from_vocabulary(vocab, inputCol=input_col,
                                                outputCol=output_col)


def fit_idf(vectors: DataFrame, input_col: str = "raw_features",
            output_col: str = "features") -> IDFModel:
    """Spark's IDF: ln((N + 1) / (df + 1)); N counts empty documents too."""
    return IDF(inputCol=input_col, outputCol=output_col).fit(vectors)


def idf_table(spark, vocab: list[str], model: IDFModel) -> DataFrame:
    """(term_index, term, df, idf) of a fitted IDF model (vocabulary-sized)."""
    rows = [(i, t, int(d), float(v)) for i, (t, d, v) in
            enumerate(zip(vocab, model.docFreq, model.idf.toArray()))]
    return spark.createDataFrame(rows, IDF_SCHEMA)


def idf_rows(stats: list, n_docs: int) -> list[tuple]:
    """(term_index, term, df, idf) from ranked (term, tf, df) rows:
    ln((N + 1) / (df + 1)), the value that ``IDF`` fits, without its pass."""
    return [(i, r["term"], int(r["df"]), math.log((n_docs + 1.0) / (r["df"] + 1.0)))
            for i, r in enumerate(stats)]


def ranked_stats(words: DataFrame, size: int = VOCAB_SIZE) -> list:
    """The vocabulary's (term, tf, df) rows in rank order (at most ``size``)."""
    return term_stats(words).orderBy(F.desc("tf"), F.asc("term")).limit(size).collect()


def tfidf_long(words: DataFrame, idf_tbl: DataFrame, vocab: list[str],
               id_col: str = "doc_id") -> DataFrame:
    """(id, term, n, tfidf): the non-zero cells of ``IDFModel.transform``
    (raw count x idf, the same double product) in long form. Counts stay
    inside each document's row; only the IDF table (vocabulary-sized, size
    checked) is joined."""
    cells = term_cells(words, vocab, id_col)
    idf = small_side(idf_tbl.select("term_index", "term", "idf"))
    return (cells.join(idf, "term_index")
            .select(id_col, "term", "n", (F.col("n") * F.col("idf")).alias("tfidf")))


def term_cells(words: DataFrame, vocab: list[str], id_col: str = "doc_id", *extra: str) -> DataFrame:
    """(id, extra..., term_index, n): the cells of the count vectors, read
    from each document's own sparse vector (no shuffle)."""
    parts = count_vectors(words, vocab, id_col, *extra).withColumnRenamed("terms", "term_index")
    return parts.select(id_col, *extra, F.inline(F.arrays_zip("term_index", "n")))


def count_vectors(words: DataFrame, vocab: list[str], id_col: str = "doc_id", *extra: str) -> DataFrame:
    """(id, extra..., terms array<int>, n array<double>): each document's
    sparse count vector as plain arrays."""
    counted = count_model(vocab, output_col="_cells").transform(words.select(id_col, *extra, "words"))
    cells = F.unwrap_udt("_cells")
    return counted.select(id_col, *extra, cells["indices"].alias("terms"), cells["values"].alias("n"))


def flatten_vector(df: DataFrame, id_col: str, vec_col: str, vocab_tbl: DataFrame,
                   value_name: str) -> DataFrame:
    """(id, term, value) for the non-zero cells of a vector column.

    Densifies every vector (rows x vector size): for inspection and
    tests on small data; ``term_counts_long`` / ``tfidf_long`` give the
    same cells at scale."""
    cells = df.select(F.col(id_col),
                      F.posexplode(vector_to_array(F.col(vec_col))).alias("term_index", "v"))
    cells = cells.where(F.col("v") != 0)
    return (cells.join(small_side(vocab_tbl), "term_index")
            .select(id_col, "term", F.col("v").alias(value_name)))


def term_counts_long(words: DataFrame, vocab: list[str], id_col: str = "doc_id") -> DataFrame:
    """(id, term, n) for vocabulary terms, without vectors in the result."""
    tbl = small_side(vocabulary_table(words.sparkSession, vocab))
    return term_cells(words, vocab, id_col).join(tbl, "term_index").select(id_col, "term", "n")


def tfidf_textbook(words: DataFrame, stats: list, n_docs: int, id_col: str = "doc_id") -> DataFrame:
    """(id, term, tfidf) with tf = count / tokens in the document and
    idf = ln(N / df), over the vocabulary's ranked (term, tf, df) rows (the
    README's formula)."""
    spark = words.sparkSession
    rows = [(i, r["term"], int(r["df"])) for i, r in enumerate(stats)]
    tbl = small_side(spark.createDataFrame(rows, "term_index int, term string, df long"))
    cells = term_cells(words.withColumn("doc_len", F.size("words")), [r["term"] for r in stats],
                       id_col, "doc_len")
    value = (F.col("n") / F.col("doc_len")) * F.log(F.lit(float(n_docs)) / F.col("df"))
    return cells.join(tbl, "term_index").select(id_col, "term", round6(value).alias("tfidf"))
