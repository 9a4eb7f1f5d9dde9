"""Text cleaning as one native Spark expression (no Python UDF).

``clean_text(text)`` = split on whitespace, keep only ASCII letters and
digits of each token, lower-case, keep tokens longer than 2 characters
that are not stop words. Repeated tokens stay (term counts need them).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stop-word list of the topic stage, in its order.
STOPWORDS = (
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and",
    "any", "are", "arent", "as", "at", "be", "because", "been", "before", "being",
    "below", "between", "both", "but", "by", "can", "cant", "come", "could",
    "couldnt", "d", "did", "didn", "do", "does", "doesnt", "doing", "dont", "down",
    "during", "each", "few", "finally", "for", "from", "further", "had", "hadnt",
    "has", "hasnt", "have", "havent", "having", "he", "her", "here", "hers",
    "herself", "him", "himself", "his", "how", "i", "if", "in", "into", "is",
    "isnt", "it", "its", "itself", "just", "ll", "m", "me", "might", "more",
    "most", "must", "my", "myself", "no", "nor", "not", "now", "o", "of", "off",
    "on", "once", "only", "or", "other", "our", "ours", "ourselves", "out", "over",
    "own", "r", "re", "s", "said", "same", "she", "should", "shouldnt", "so",
    "some", "such", "t", "than", "that", "thats", "the", "their", "theirs", "them",
    "themselves", "then", "there", "these", "they", "this", "those", "through",
    "to", "too", "under", "until", "up", "very", "was", "wasnt", "we", "were",
    "werent", "what", "when", "where", "which", "while", "who", "whom", "why",
    "will", "with", "wont", "would", "y", "you", "your", "yours", "yourself",
    "yourselves",
)
# Fixed value: the custom list of the topic stage (one empty word).
CUSTOM_STOPWORDS = ("",)

# Whitespace as Python's ``str.split()`` sees it: Unicode white space plus
# the four information separators U+001C..U+001F.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
MIN_LENGTH = 3
# Characters kept by the one-pass cleaner: ASCII letters, digits, whitespace.
KEEP_PATTERN = r"(?U)[^a-zA-Z0-9\s\x1c-\x1f]"


def reference_stopwords() -> tuple[str, ...]:
    """The list exactly as the topic script built it: a missing comma
    joined the last two words into one ('yourselfyourselves')."""
    return STOPWORDS[:-2] + ("yourselfyourselves",) + CUSTOM_STOPWORDS


def default_stopwords() -> tuple[str, ...]:
    return STOPWORDS + CUSTOM_STOPWORDS


def tokens(text: Column) -> Column:
    """Whitespace tokens (leading/trailing blanks give empty tokens that
    the length filter of ``clean_text`` drops)."""
    return F.split(F.coalesce(text, F.lit("")), WHITESPACE)


def clean_text(text: Column, stopwords: tuple[str, ...] | None = None,
               min_length: int = MIN_LENGTH) -> Column:
    """array<string> of cleaned, lower-cased tokens in text order.

    Equal to cleaning token by token, in one regex pass over the text:
    dropping every character that is neither an ASCII letter or digit nor
    whitespace leaves each whitespace-separated token cleaned in place
    (no token is merged or split, fully dropped tokens vanish and would
    fail the length test anyway).
    """
    stop = sorted({w.lower() for w in (stopwords if stopwords is not None
                                       else default_stopwords())})
    kept = F.regexp_replace(F.coalesce(text, F.lit("")), KEEP_PATTERN, "")
    words = F.split(F.lower(kept), WHITESPACE)
    return F.filter(words, lambda w: (F.length(w) >= min_length) & ~w.isin(stop))


def clean_text_per_token(text: Column, stopwords: tuple[str, ...] | None = None,
                         min_length: int = MIN_LENGTH) -> Column:
    """The same result token by token (the topic stage's literal form)."""
    stop = sorted({w.lower() for w in (stopwords if stopwords is not None
                                       else default_stopwords())})
    cleaned = F.transform(tokens(text),
                          lambda w: F.lower(F.regexp_replace(w, "[^a-zA-Z0-9]", "")))
    return F.filter(cleaned, lambda w: (F.length(w) >= min_length) & ~w.isin(stop))


def round6(c: Column) -> Column:
    """Round to 6 decimals as ``round(x * 1e6) / 1e6`` (same bits in the
    SQL oracle, which rounds halves away from zero as well)."""
    return F.round(c * F.lit(1_000_000.0)) / F.lit(1_000_000.0)
