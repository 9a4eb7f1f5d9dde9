"""The registered queries of the training-data operators.

Every query applies its operator, with the parameters named in its module,
to a whole table. ``ORACLE`` holds DuckDB SQL where SQL can say the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from maillens.llm import (
    chat,
    crosstok,
    decontam,
    hardneg,
    imatch,
    langid,
    logtree,
    mergedrop,
    pii,
    secrets,
    superminhash,
    tokencount,
    urls,
)
from maillens.llm.common import table
from maillens.llm.oracle import ORACLE

Build = Callable[[SparkSession, str], DataFrame]


def op1_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with merge-dropout, decoded and compared."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = mergedrop.encode(docs, back=True)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.sha2("decoded", 256).alias("decoded_sha256"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of every text and of its edited form."""
    found = imatch.fingerprints(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
                        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op3_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret candidate of the documents with the forest's verdict."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    base = pii.listing("base", pii.BASE)
    return found.select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(pii.BASE)],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, pii.listing("added", pii.ADDED)), ",").alias("spans"),
        F.size("added").cast("long").alias("n_added"))


def op5_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_url_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op7_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in documents."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"""select -1L conv_id, 0L turn, 'user' role, '{hard}' text
                          union all select -1L, 1L, 'assistant', '{hard}'""")
    read = chat.read_back(chat.windows(turns.unionByName(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    per = read.select("conv_id", "start", F.size("turns").alias("n"), said.alias("said"),
                      F.array_join("losses", "").alias("loss"), "n_chars")
    listed = per.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("start", "said", "loss"))).alias("parts"),
        F.sum("n_chars").cast("long").alias("formatted_chars"))
    loss = F.array_join(F.transform("parts", lambda p: p["loss"]), "")
    return listed.select(
        "conv_id", "n_turns",
        F.sha2(F.array_join(F.transform("parts", lambda p: p["said"]), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars")


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its recurring template lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return logtree.drop_recurring_lines(docs).select("doc_id", "n_lines", "n_dropped", "text")


def op11_spill_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizations of every document aligned, with pair counts."""
    found = crosstok.align(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector."""
    rows = table(spark, sf_dir, "embeddings").where(
        "label is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    rows = rows.select("vec_id", F.expr("if(vec_id % 7 = 0, (bigint(label) + 1) % 10, label)").cast("int").alias("label"),
                       F.expr("transform(embedding, x -> floor(256 * double(x)))").alias("vector"))
    return hardneg.mine(rows, F.expr("vec_id % 50 = 0"))


def op13_rank_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return tokencount.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline, from documents to token ids."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Build] = {f.__name__: f for f in (
    op1_merge_dropout, op2_imatch, op3_secret_forest, op4_weak_pii, op5_superminhash, op6_url_words,
    op7_containment, op8_byte_cnn, op9_chat_windows, op10_line_templates, op11_spill_alignment,
    op12_angular_negatives, op13_rank_rounds, pipeline)}
