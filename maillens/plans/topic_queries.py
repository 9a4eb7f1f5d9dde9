"""Topic queries: EM topics on the TF-IDF cells of the corpus, their words,
coherence and the documents' shares, each with a DuckDB twin that runs the
same rounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from maillens.functions.text import round6
from maillens.operators import lda as LDA
from maillens.operators import terms as TM
from maillens.operators import topics as TP
from maillens.plans.registry import query
from maillens.plans.text_queries import _r6, _text_sql, corpus_words, n_documents
from maillens.plans.topic_oracle import topic_ctes

ROUNDS = 20      # Spark ML's default number of iterations


def fitted(spark, sf_dir, k=TP.N_TOPICS, rounds=ROUNDS):
    """(model, vocabulary list): one pass for the term statistics, one for the
    count vectors, then the rounds over the written cells."""
    words = corpus_words(spark, sf_dir)
    stats = TM.ranked_stats(words)
    vocab = [r["term"] for r in stats]
    idf = [r[3] for r in TM.idf_rows(stats, n_documents(spark, sf_dir))]
    cells = LDA.cells(TM.count_vectors(words, vocab), idf)
    return LDA.fit(cells, len(vocab), k, rounds), vocab


def _tops(spark, sf_dir):
    model, vocab = fitted(spark, sf_dir)
    return model, LDA.topic_rows(spark, LDA.top_terms(model, vocab, TP.TERMS_PER_TOPIC))


def _sql(body):
    return _text_sql(body, *topic_ctes(TP.N_TOPICS, ROUNDS, TP.TERMS_PER_TOPIC))


_WEIGHTS = f"list({_r6('weight')} order by rank)"


@query("topics", sql=_sql(
    f'select topic, list(term_index order by rank) "termIndices", {_WEIGHTS} "termWeights", '
    "list(term order by rank) topic_desc from tops group by 1"))
def q_topics(spark, sf_dir):
    """25 topics: term ids, weights and words of the top 10 terms."""
    _, tops = _tops(spark, sf_dir)
    cells = F.array_sort(F.collect_list(F.struct("rank", "term_index", "weight", "term")))
    per = tops.groupBy("topic").agg(cells.alias("c"))         # 10 rows a group
    return per.select("topic", F.col("c.term_index").alias("termIndices"),
                      F.transform("c", lambda x: round6(x["weight"])).alias("termWeights"),
                      F.col("c.term").alias("topic_desc"))


@query("topic_terms", sql=_sql(f"select topic, rank, term_index, term, {_r6('weight')} weight from tops"))
def q_topic_terms(spark, sf_dir):
    """Top 10 words of every topic in long form (topic, rank, term, weight)."""
    _, tops = _tops(spark, sf_dir)
    return tops.withColumn("weight", round6(F.col("weight")))


@query("topic_coherence", sql=_sql(
    "select topic, " + _r6("sum(ln((coalesce(d, 0) + 1) / dj))") + " coherence from ("
    "select x.topic, x.term_index wj, y.term_index wi from tops x join tops y on x.topic = y.topic and y.rank > x.rank) "
    "left join (select a.w wj, b.w wi, count(*) d from cell a join cell b using (doc_id) "
    "where a.w in (select term_index from tops) and b.w in (select term_index from tops) group by all) using (wj, wi) "
    "join (select w wj, count(*) dj from cell group by 1) using (wj) group by 1"))
def q_topic_coherence(spark, sf_dir):
    """UMass coherence of every topic's top 10 words."""
    model, tops = _tops(spark, sf_dir)
    return LDA.coherence(model.docs, tops).withColumn("coherence", round6(F.col("coherence")))


@query("topic_shares", sql=_sql(
    f"select doc_id, (j - 1)::INTEGER topic, {_r6('n / sum(n) over (partition by doc_id)')} share from held "
    "qualify sum(n) over (partition by doc_id) > 0"))
def q_topic_shares(spark, sf_dir):
    """Share of every topic in every document that has vocabulary words."""
    model, _ = fitted(spark, sf_dir)
    return model.shares().where("share is not null").withColumn("share", round6(F.col("share")))
