"""Queries of the text stage: cleaning, term statistics, TF-IDF."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from maillens.functions.text import default_stopwords, round6
from maillens.operators import terms as TM
from maillens.plans.registry import query
from maillens.sources.tables import read_table

# ---------------------------------------------------------------- Spark side


def corpus(spark, sf_dir):
    """The document corpus (doc_id, text): every document, whole text."""
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def corpus_words(spark, sf_dir):
    return TM.tokenize(corpus(spark, sf_dir))


def vocab_frame(spark, sf_dir, size=TM.VOCAB_SIZE, words=None):
    """(term_index, term, tf): top ``size`` terms, lazily (no collect)."""
    stats = TM.term_frequencies(words if words is not None else corpus_words(spark, sf_dir))
    top = stats.orderBy(F.desc("tf"), F.asc("term")).limit(size)
    # The window runs over at most ``size`` rows (after the top-k).
    w = Window.orderBy(F.desc("tf"), F.asc("term"))
    return top.select((F.row_number().over(w) - 1).cast("int").alias("term_index"),
                      "term", "tf")


def tfidf_vectors(spark, sf_dir, size=TM.VOCAB_SIZE):
    """(vectors with raw_features and features, vocabulary list, IDF model)
    for the topic model; the IDF model holds the counted df of the terms."""
    words = corpus_words(spark, sf_dir)
    vocab = TM.vocabulary(TM.term_frequencies(words), size)
    counted = TM.count_model(vocab).transform(words)
    idf = TM.fit_idf(counted)
    return idf.transform(counted), vocab, idf


def n_documents(spark, sf_dir):
    return corpus(spark, sf_dir).count()


# ---------------------------------------------------------------- oracle side

_WS = ("[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
       "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+")
_STOP = "[" + ", ".join("'" + w + "'" for w in sorted(set(default_stopwords()))) + "]"
_WORDS = (
    "select doc_id, list_filter(list_transform("
    f"regexp_split_to_array(coalesce(text, ''), '{_WS}'), "
    "lambda x: lower(regexp_replace(x, '[^a-zA-Z0-9]', '', 'g'))), "
    f"lambda x: length(x) > 2 and not list_contains({_STOP}, x)) words from documents"
)
_PER_DOC = ("select doc_id, term, count(*) n from "
            "(select doc_id, unnest(words) term from words) group by 1, 2")
_STATS = "select term, sum(n)::BIGINT tf, count(*) df from per_doc group by 1"
_VOCAB = (f"select (row_number() over (order by tf desc, term) - 1)::INTEGER term_index, "
          f"term, tf from stats order by tf desc, term limit {TM.VOCAB_SIZE}")


def _r6(x: str) -> str:
    return f"round(({x}) * 1000000.0) / 1000000.0"


def _text_sql(body: str, *extra: tuple[str, str]) -> str:
    ctes = [("words", _WORDS), ("per_doc", _PER_DOC), ("stats", _STATS),
            ("vocab", _VOCAB), *extra]
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in ctes) + "\n" + body


# ---------------------------------------------------------------- queries


@query("clean_text", sql=_text_sql(
    "select doc_id, len(words)::INTEGER n_words, array_to_string(words, ' ') words_text "
    "from words"))
def q_clean_text(spark, sf_dir):
    """Cleaned tokens per document (whitespace split, ASCII alnum, lower,
    length > 2, no stop words)."""
    return corpus_words(spark, sf_dir).select(
        "doc_id", F.size("words").alias("n_words"),
        F.array_join("words", " ").alias("words_text"))


@query("term_stats", sql=_text_sql("select * from stats"))
def q_term_stats(spark, sf_dir):
    """Corpus count and document frequency per term."""
    return TM.term_stats(corpus_words(spark, sf_dir))


@query("vocabulary", sql=_text_sql("select * from vocab"))
def q_vocabulary(spark, sf_dir):
    """Top 1000 terms by corpus count, ties by term (CountVectorizer input)."""
    return vocab_frame(spark, sf_dir)


@query("term_counts", sql=_text_sql(
    "select doc_id, term, n::DOUBLE n from per_doc join vocab using (term)"))
def q_term_counts(spark, sf_dir):
    """Counts of the vocabulary terms per document, (doc_id, term, n): the
    cells of the count vectors, in long form."""
    words = corpus_words(spark, sf_dir)
    return TM.term_counts_long(words, TM.vocabulary(TM.term_frequencies(words)))


_N = "(select count(*) from documents)"


@query("idf", sql=_text_sql(
    f"select term, df, {_r6(f'ln(({_N} + 1.0) / (df + 1.0))')} idf "
    "from vocab join stats using (term)"))
def q_idf(spark, sf_dir):
    """Fitted IDF per vocabulary term: ln((N + 1) / (df + 1))."""
    stats = TM.ranked_stats(corpus_words(spark, sf_dir))
    table = spark.createDataFrame(TM.idf_rows(stats, n_documents(spark, sf_dir)), TM.IDF_SCHEMA)
    return table.select("term", "df", round6(F.col("idf")).alias("idf"))


@query("tfidf", sql=_text_sql(
    f"select doc_id, term, {_r6(f'n * ln(({_N} + 1.0) / (df + 1.0))')} tfidf "
    "from per_doc join vocab using (term) join stats using (term)"))
def q_tfidf(spark, sf_dir):
    """TF-IDF (raw count x fitted IDF) as (doc_id, term, tfidf): the cells
    of the TF-IDF vectors, in long form."""
    words = corpus_words(spark, sf_dir)
    stats = TM.ranked_stats(words)
    table = spark.createDataFrame(TM.idf_rows(stats, n_documents(spark, sf_dir)), TM.IDF_SCHEMA)
    flat = TM.tfidf_long(words, table, [r["term"] for r in stats])
    return flat.select("doc_id", "term", round6(F.col("tfidf")).alias("tfidf"))


@query("tfidf_textbook", sql=_text_sql(
    f"select doc_id, term, {_r6(f'(n / len(words)) * ln({_N}::DOUBLE / vdf)')} tfidf "
    "from per_doc join words using (doc_id) "
    "join (select term, count(*) vdf from per_doc join vocab using (term) group by 1) "
    "using (term)"))
def q_tfidf_textbook(spark, sf_dir):
    """TF-IDF as the README states it: count / length x ln(N / df)."""
    words = corpus_words(spark, sf_dir)
    return TM.tfidf_textbook(words, TM.ranked_stats(words), n_documents(spark, sf_dir))


@query("tokens", sql=_text_sql(
    "select doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), "
    f"'{_WS}'), lambda x: x <> ''))::INTEGER n_tokens from documents"))
def q_tokens(spark, sf_dir):
    """Whitespace tokens per document before cleaning (Python split rule)."""
    from maillens.functions.text import tokens
    toks = F.filter(tokens(F.col("text")), lambda w: w != "")
    return corpus(spark, sf_dir).select("doc_id", F.size(toks).alias("n_tokens"))
