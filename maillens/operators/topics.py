"""Topic model (LDA) on TF-IDF vectors and its description in words.

LDA is Spark ML's (``optimizer='em'`` by default, as the topic script;
``'online'`` as an option). Term ids are mapped to words by a broadcast
join with the vocabulary table (bounded by the vocabulary size), not by
a Python UDF over a driver-side list.
"""

from __future__ import annotations

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the topic script.
N_TOPICS = 25
SEED = 123
TERMS_PER_TOPIC = 10
PARTITIONS = 32      # of the fit's input; the topics depend on it


def fit_lda(features: DataFrame, k: int = N_TOPICS, seed: int = SEED,
            optimizer: str = "em", max_iter: int = 20,
            features_col: str = "features") -> LDAModel:
    """Fit on a cached input (EM reads it every iteration). EM's result
    depends on the input's partitioning, see ``fixed_layout``; it shuffles
    the document-term graph each iteration, so very large corpora should
    take ``optimizer="online"``."""
    return LDA(k=k, seed=seed, optimizer=optimizer, maxIter=max_iter,
               featuresCol=features_col).fit(features)


def fixed_layout(features: DataFrame, id_col: str = "doc_id",
                 partitions: int = PARTITIONS) -> DataFrame:
    """Rows placed and ordered by a hash of their id, so that a fit gives the
    same topics however the input files are split."""
    return features.repartition(partitions, id_col).sortWithinPartitions(id_col)


def topic_table(model: LDAModel, max_terms: int = TERMS_PER_TOPIC) -> DataFrame:
    """(topic, termIndices, termWeights), computed once (for an EM model
    each ``describeTopics`` call is a distributed computation)."""
    described = model.describeTopics(maxTermsPerTopic=max_terms)
    rows = described.collect()   # k rows of max_terms entries: bounded
    return described.sparkSession.createDataFrame(
        rows, "topic int, termIndices array<int>, termWeights array<double>")


def topic_terms(model: LDAModel | DataFrame, vocab_tbl: DataFrame,
                max_terms: int = TERMS_PER_TOPIC) -> DataFrame:
    """(topic, rank, term_index, term, weight): top terms of every topic."""
    topics = model if isinstance(model, DataFrame) else topic_table(model, max_terms)
    cells = topics.select(
        "topic",
        F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "tw"))
    cells = cells.select("topic", "rank", F.col("tw.termIndices").alias("term_index"),
                         F.col("tw.termWeights").alias("weight"))
    return (cells.join(F.broadcast(vocab_tbl), "term_index")
            .select("topic", "rank", "term_index", "term", "weight"))


def describe(model: LDAModel, vocab_tbl: DataFrame,
             max_terms: int = TERMS_PER_TOPIC) -> DataFrame:
    """(topic, termIndices, termWeights, topic_desc): the script's table
    with the words added. Groups hold ``max_terms`` rows each."""
    topics = topic_table(model, max_terms)
    terms = topic_terms(topics, vocab_tbl)
    words = (terms.groupBy("topic")
             .agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_w"))
             .select("topic", F.transform("_w", lambda s: s["term"]).alias("topic_desc")))
    return topics.join(words, "topic")
