"""A corpus pipeline: raw documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``; the last returns the kept documents
as token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maillens.llm import decontam, langid, logtree, mergedrop, superminhash
from maillens.llm.common import release, staged, table

#: Here a line recurs from three documents on, whatever its length: pairs of copies
#: must reach the near-duplicate stage whole (it then takes one of them).
LINES = ((3, 3),)
KEPT = 0.999           # share of rightly predicted held-out documents that reach the least score


def least_score(docs: DataFrame, model: langid.ByteCnn) -> float | None:
    """The score that ``KEPT`` of the labelled held-out documents reach which
    the model predicts right; None where there are none."""
    held = docs.where(langid.is_held_out() & F.col("lang").isNotNull())
    right = langid.predict(held, model, ["lang"]).where("lang_pred = lang")
    return right.agg(F.percentile_approx("score", 1 - KEPT, 100_000)).first()[0]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without text or letters go,
    and those that score below ``least_score``, unless their label says the
    same language (without any learned language or score, nothing else goes).
    Rows are judged one by one, repeated ones alike; columns named like the
    operator's own (``lang_pred``, ``score``) are not part of ``documents``."""
    model = langid.learn(docs)
    scored = langid.predict(docs, model)
    if not model.langs:
        return scored.where(F.col("text").rlike(r"\p{L}")).select(*docs.columns)
    least = least_score(docs, model) or 0.0
    told = (F.col("score") >= least) | F.col("lang").eqNullSafe(F.col("lang_pred"))
    return scored.where((F.col("lang_pred") != langid.UNKNOWN) & told).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring template lines are cut out of the texts; a document that
    consisted of nothing else goes. ``n_chars`` follows the text. Rows that
    repeat a doc_id count as one document; a null text or doc_id stays."""
    cut = logtree.drop_recurring_lines(docs, LINES)
    left = cut.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return left.withColumn("n_chars", n_chars).select(*docs.columns) if "n_chars" in docs.columns else (
        left.select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group stays, the smallest doc_id;
    rows that repeat a doc_id stay or go together, rows without one stay."""
    extra, _ = staged(superminhash.near_duplicates(docs).where("not kept").select("doc_id").distinct(), "extra")
    return docs.join(extra, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go; rows that repeat a doc_id go
    together, rows without one, and without text, stay."""
    found = decontam.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding restores its text (a
    null text has null ids and is lossless); repeated rows repeat."""
    back = mergedrop.encode(docs.select("doc_id", "lang", "source", "text"), back=True)
    return back.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminate), ("tokens", tokens)]

#: Neither the trained language model nor SuperMinHash can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; a stage's
    table goes when the next one stands."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, done = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if path is not None:
            release(spark, path)
        path = done
    return docs
