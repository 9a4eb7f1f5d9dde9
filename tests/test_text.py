"""Native text cleaning vs the plain Python form of the topic stage."""

import re

from pyspark.sql import functions as F

from maillens.functions.text import (
    clean_text,
    clean_text_per_token,
    default_stopwords,
    reference_stopwords,
)


def python_clean(text, stop):
    words = text.split()
    out = [re.sub("[^a-zA-Z0-9]", "", w) for w in words]
    stop = [w.lower() for w in stop]
    return [w.lower() for w in out if len(w) > 2 and w.lower() not in stop]


TEXTS = [
    "The quick, brown fox -- jumps over the lazy dog's back!!",
    "  leading and trailing blanks  ",
    "nbsp\xa0between\x1fwords\x1cand em space　ideo",
    "Accénted wörds ünïcode ÉLAN naïve",
    "yourself yourselves YOURSELF Yourselves",
    "",
    "repeat repeat repeat REPEAT",
    "tabs\tand\nnewlines\r\nand\x0bvt\x0cff",
]


def test_clean_text_equals_python(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    for fn in (clean_text, clean_text_per_token):
        for stop in (default_stopwords(), reference_stopwords()):
            got = {r.id: r.w for r in df.select("id", fn(F.col("text"), stop)
                                                .alias("w")).collect()}
            for i, t in enumerate(TEXTS):
                assert got[i] == python_clean(t, stop), (fn.__name__, i, t)


def test_reference_quirk_keeps_two_words():
    assert "yourselfyourselves" in reference_stopwords()
    assert "yourself" not in reference_stopwords()
    assert {"yourself", "yourselves"} <= set(default_stopwords())


def test_null_text_is_empty(spark):
    df = spark.createDataFrame([(None,)], "text string")
    assert df.select(clean_text(F.col("text")).alias("w")).first().w == []


def test_one_pass_equals_per_token_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    diff = docs.where(clean_text(F.col("text")) != clean_text_per_token(F.col("text")))
    assert diff.count() == 0
