"""Secret scan with a random forest that removes false positives.

Candidates are runs of 12 or more key characters that hold a digit or a
capital behind a small letter or start with 16 capitals, and every value that
directly follows a secret's name and ``=`` or ``:``, whatever its length and
characters (in quotes up to the closing one, else up to a blank or quote, less
closing punctuation). Labelled findings teach the forest: known key formats
and quoted or assigned values with a digit or mixed case behind a secret's
name are positive; host names, mail addresses, plain numbers, dates, single
unquoted words and runs made of dictionary words are negative; the rest is
unlabelled. The forest sees none of these patterns, only the candidate's
length, its character transitions and classes, how much of it dictionary
words cover, how path-like it is, and the words and marks around it.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillens.llm.common import matches, staged

SAMPLE = 20_000         # labelled findings of each class that the forest is fitted on, about
TREES, DEPTH = 24, 6
SEED = 11
_KEY = "[A-Za-z0-9_/+=.-]"

# Fixed word lists.
_DICTIONARY = ("the|and|that|tion|ing|ent|ment|com|org|net|www|http|html|mail|example|page|file|image|index|"
               "version|release|user|data|test|name|date|time|item|license|copyright|public|general|post|"
               "article|news|blog|home|site|src|lib|bin|usr|var|tmp|doc|docs|img|css|json|xml|pdf|jpg|png")
_NAMES = ("token", "password", "passwd", "pwd", "secret", "key", "apikey", "auth", "bearer", "credential", "credentials")
_PLAIN = ("page", "version", "isbn", "order", "item", "figure", "line", "chapter", "id", "number", "no", "card", "phone")

_MIXED = f"{_KEY.replace('a-z', '')}*+[a-z]{_KEY.replace('A-Z', '')}*+[A-Z]"   # a capital behind a small letter
_RUN = rf"(?<!{_KEY})(?={_KEY}{{12}})(?={_KEY}*[0-9]|{_MIXED}|[A-Z]{{16}}){_KEY}{{12,}}+"
_BEHIND = rf"(?<![A-Za-z])(?i:{'|'.join(_NAMES)})[\"']?\s{{0,3}}[=:]{{1,2}}\s{{0,3}}"
_NAMED = rf"(?<!{_KEY})(?=(?:[A-Za-z_-]*[_-])?(?i:{'|'.join(_NAMES)})=)"
# A quoted value; a run that no password character follows; any other value; any other run.
_CANDIDATE = "|".join((
    rf"(?<=\")(?<={_BEHIND}\")[^\"\n]+(?=\")", rf"(?<=')(?<={_BEHIND}')[^'\n]+(?=')",
    rf"{_RUN}(?![!#$%^*~?|\\])",
    rf"(?<=[=:]\s{{0,3}}[\"']?)(?![=:])(?<={_BEHIND}[\"']?)[^\s\"']*[^\s\"',;)\]}}]",
    rf"(?!{_NAMED}){_RUN}"))


def _found(text: Column) -> Column:
    """Candidates of a text. Only behind a secret's name can any but the run
    pattern match or the run pattern be kept back, and few texts hold one."""
    low = F.lower(text)
    named = F.lit(False)
    for name in sorted(_NAMES):
        if not any(other != name and other in name for other in _NAMES):
            named = named | F.contains(low, F.lit(name))
    named = named & low.rlike(rf"(?:{'|'.join(_NAMES)})[\"']?\s{{0,3}}[=:]")
    return F.when(named, matches(text, _CANDIDATE)).otherwise(matches(text, _RUN))


def _transitions(text: Column) -> Column:
    """Changes between small letters, capitals, digits and other characters."""
    shape = F.translate(text, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_/+=.-",
                        "a" * 26 + "A" * 26 + "0" * 10 + "." * 6)
    return F.length(F.regexp_replace(shape, r"(.)\1*", "$1")) - 1


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, value, value_sha256, features, label): every candidate of
    ``docs(doc_id, text)``; positions in code points, end exclusive; label 1,
    0 or null (unlabelled)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.explode(_found(text)).alias("m")).select(
        "doc_id", "m.start", "m.end", F.col("m.text").alias("value"), "m.before", "m.after")
    value, before = F.col("value"), F.col("before")
    name = F.lower(F.regexp_extract(before, r"([A-Za-z]+)[^A-Za-z]*$", 1))
    # A name and "=" directly before the value are part of the run itself.
    own = F.lower(F.regexp_extract(value, r"^([A-Za-z_-]+)=", 1))
    name = F.when(own != "", F.regexp_extract(own, "([a-z]+)$", 1)).otherwise(name)
    body = F.regexp_replace(value, "^[A-Za-z_-]+=", "")
    n = F.greatest(F.length(body), F.lit(1))
    share = lambda pattern: F.length(F.regexp_replace(body, pattern, "")) / n
    assigned = (own != "") | before.rlike(r"[=:]\s*[\"']?$")
    covered = 1 - F.length(F.regexp_replace(F.lower(body), f"(?:{_DICTIONARY})", "")) / n
    features = {
        "length": n, "transitions": _transitions(body), "transition_rate": _transitions(body) / n,
        "digits": share("[^0-9]"), "capitals": share("[^A-Z]"), "small": share("[^a-z]"),
        "hex": share("[^0-9a-f]"), "covered": covered,
        "slashes": n * share("[^/]"), "dots": n * share("[^.]"),
        "in_path": (before.rlike(r"(?:://|[/@\\])$")).cast("double"),
        "assigned": assigned.cast("double"), "quoted": before.rlike("[\"']$").cast("double"),
        "secret_name": name.isin(*_NAMES).cast("double"), "plain_name": name.isin(*_PLAIN).cast("double"),
        "letter_behind": F.col("after").rlike("[A-Za-z@]").cast("double")}
    positive = body.rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$") | body.rlike("^gh[pousr]_[0-9A-Za-z]{36}$") | (
        assigned & name.isin(*_NAMES) & body.rlike("[A-Za-z]")
        & (body.rlike("[0-9]|[A-Z]{16}") | (body.rlike(f"^{_MIXED}") & (n >= 12))))
    negative = (body.rlike("^[0-9.-]+$") | body.rlike(r"\.(?:com|org|net|html?)\b") | before.rlike(r"(?:://|@)$")
                | (F.col("after") == "@") | (covered > 0.5)
                | (body.rlike("^[A-Z]?[a-z]+[.:!?]*$") & ~before.rlike("[\"']$")))
    return rows.select("doc_id", "start", "end", "value", F.sha2("value", 256).alias("value_sha256"),
                       *[v.cast("double").alias(f"f_{k}") for k, v in features.items()],
                       F.when(positive, 1.0).when(negative, 0.0).alias("label"))


def fit(found: DataFrame) -> RandomForestClassificationModel | None:
    """Forest on the labelled findings, about ``SAMPLE`` of each class drawn by
    the hash of their values; None unless both classes occur."""
    known = found.where("label is not null")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    draw = F.pmod(F.xxhash64(F.lit(SEED), "value_sha256", "doc_id", "start"), F.lit(1 << 20))
    rate = F.when(F.col("label") == 1, min(1 << 20, -(-(SAMPLE << 20) // counts[1.0]))).otherwise(
        min(1 << 20, -(-(SAMPLE << 20) // counts[0.0])))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features",
                                    labelCol="label", cacheNodeIds=False)
    return forest.fit(_assembled(known.where(draw < rate)).select("features", "label"))


def _assembled(found: DataFrame) -> DataFrame:
    names = [c for c in found.columns if c.startswith("f_")]
    return VectorAssembler(inputCols=names, outputCol="features").transform(found)


def scan(docs: DataFrame) -> DataFrame:
    """Findings of ``docs(doc_id, text, ...)``: ``doc_id, start, end,
    value_sha256, score, is_secret``, one row per candidate.

    ``score`` is the forest's probability of a secret; ``is_secret`` is
    false for the false positives it removes (score below 0.5). Without
    labelled findings of both classes nothing is removed (score null). Null
    and empty texts have no findings; repeated rows repeat theirs; other
    columns are ignored; an empty table gives an empty one.
    """
    # Values are hashed before anything is written: no secret in clear text is left behind.
    found, _ = staged(candidates(docs.select("doc_id", "text")).drop("value"), "findings")
    model = fit(found)
    if model is None:
        scored = found.withColumn("score", F.lit(None).cast("double"))
    else:
        scored = model.transform(_assembled(found)).withColumn(
            "score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select("doc_id", "start", "end", "value_sha256", "score",
                         (F.coalesce("score", F.lit(1.0)) >= 0.5).alias("is_secret"))
