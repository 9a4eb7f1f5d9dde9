"""Line dedup with a fixed-depth log-template tree.

A line is parsed like a log message: tokens are the fields between blanks,
a token that holds a digit is a variable field ``<*>`` (unless such fields
outweigh the constant ones: rows of numbers are compared as they are). The
tree has one level for the token count and one for each of the ``DEPTH``
leading tokens. A leaf holds any number of templates: behind the leading
tokens, one field (or two neighbouring ones, where the line is long enough
for them to be at most ``VARIABLE`` of it) is variable where at least two
different lines of the leaf agree in everything else. A line takes its variant
with most lines (then the narrower, then the first one); without one it is a
template of its own. What else shares the leaf changes nothing.

A template recurs from ``needed`` documents on: short lines meet by chance, so
the shorter the line the more. Its first document (smallest doc_id) keeps the
line, all others lose it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillens.llm.common import bound, release, rows_of, staged

DEPTH = 3           # leading tokens in the tree
VARIABLE = 0.3      # share of the tokens behind them that may be variable words
#: Documents from which on a line of at least so many tokens recurs.
RECURS = ((51, 2), (3, 3), (1, 10))

_MASK = "<*>"
ONE, TWO = (next(n for n in range(1, 100) if w <= VARIABLE * n) for w in (1, 2))   # open tokens for one or two fields


def needed(tokens: Column, recurs: tuple[tuple[int, int], ...] = RECURS) -> Column:
    out = F.lit(None).cast("int")
    for least, docs in reversed(recurs):
        out = F.when(tokens >= least, docs).otherwise(out)
    return out


def _form(line: Column) -> Column:
    """The line with variable fields masked, or as it is."""
    def chosen(ts: Column) -> Column:
        masked = F.size(F.filter(ts, lambda t: t == _MASK))
        return F.when(2 * masked > F.size(ts), line).otherwise(F.array_join(ts, " "))

    fields = F.transform(F.split(line, " ", -1), lambda t: F.when(t.rlike("[0-9]"), _MASK).otherwise(t))
    return F.when(line.rlike("[0-9]"), bound(fields, chosen)).otherwise(line)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, pos, tokens, leaf, body, form) of every line that is not empty."""
    line = (docs.where("doc_id is not null and text is not null")
            .select("doc_id", F.xxhash64("text").alias("row_key"),
                    F.posexplode(F.split("text", "\n", -1)).alias("pos", "raw"))
            .select("doc_id", "row_key", "pos", F.trim("raw").alias("line")).where("line != ''")
            .withColumn("tokens", F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1))
    return (line.withColumn("form", _form(F.col("line")))
            .select("doc_id", "row_key", "pos", "tokens",
                    F.xxhash64("tokens", F.substring_index("form", " ", DEPTH)).alias("leaf"),
                    F.xxhash64("form").alias("body"), "form"))


def _variants(form: Column) -> Column:
    """The line with one open field, or two neighbouring ones, masked: array of
    (key, width, at). A line's hash is the xor of its fields' hashes, so a variant
    costs the same however long the line is."""
    def listed(hashes: Column) -> Column:
        star = lambda p: F.xxhash64(p, F.lit(_MASK))
        at = lambda p: F.get(hashes, p).bitwiseXOR(star(p))
        places = lambda last: F.sequence(F.lit(DEPTH), F.size(hashes) - last)
        entry = lambda key, width, p: F.struct(key.alias("key"), F.lit(width).alias("width"), p.alias("at"))

        def with_total(total: Column) -> Column:
            one = F.transform(places(1), lambda p: entry(total.bitwiseXOR(at(p)), 1, p))
            two = F.transform(places(2), lambda p: entry(total.bitwiseXOR(at(p)).bitwiseXOR(at(p + 1)), 2, p))
            none = F.array().cast("array<struct<key:bigint,width:int,at:int>>")
            n = F.size(hashes) - DEPTH
            return F.concat(F.when(n >= ONE, one).otherwise(none), F.when(n >= TWO, two).otherwise(none))

        return bound(F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(h)), with_total)

    return bound(F.transform(F.split(form, " ", -1), lambda t, i: F.xxhash64(i, t)), listed)


def _members(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(leaf, body, tail): the variant of every line that has one."""
    leaves = (lines.where(F.col("tokens") >= DEPTH + ONE).groupBy("leaf")
              .agg(F.min("body").alias("b0"), F.max("body").alias("b1"),
                   F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"))
              .where("b0 < b1 and d0 < d1").select("leaf"))
    # Only lines of leaves that hold different lines are read as text again.
    texts = (rows_of(_lines(docs), leaves, "leaf").groupBy("leaf", "body").agg(F.max("form").alias("form")))
    variants, path = staged(texts.select("leaf", "body", F.inline(_variants(F.col("form")))), "line-variants")
    shared = (variants.groupBy("leaf", "key").agg(F.count("*").alias("lines")).where("lines > 1"))
    best = F.max_by("key", F.struct("lines", -F.col("width"), -F.col("at")))
    members, _ = staged(variants.join(shared, ["leaf", "key"]).groupBy("leaf", "body").agg(best.alias("tail")),
                        "members")
    release(docs.sparkSession, path)
    return members


def drop_recurring_lines(docs: DataFrame, recurs: tuple[tuple[int, int], ...] = RECURS) -> DataFrame:
    """``docs`` with recurring template lines taken out of ``text``; ``recurs``
    lists (least tokens, documents), longest first, shorter lines always stay.

    Adds ``n_lines`` and ``n_dropped`` (long) after the input's columns
    (columns of those names are replaced); needs ``doc_id`` and ``text``, other
    columns pass through unchanged. Null texts and empty texts stay as they
    are with 0 dropped (a null has 0 lines); a row without doc_id is neither
    counted nor changed; rows that repeat a doc_id count as one document, so
    repeated rows never make a template recur. Ties cannot occur: the first
    document is the smallest doc_id, and every line of the template that
    this document has stays. Empty lines always stay. An empty table gives an
    empty one.
    """
    docs = docs.drop("n_lines", "n_dropped")
    lines, line_path = staged(
        _lines(docs).select("doc_id", "row_key", "pos", "tokens", "leaf", "body"), "lines")
    members = _members(docs, lines)
    keyed = (lines.join(members, ["leaf", "body"], "left")
             .select("doc_id", "row_key", "pos", "tokens", "leaf", F.coalesce("tail", "body").alias("tail")))
    per_doc = keyed.groupBy("leaf", "tail", "doc_id").agg(F.max("tokens").alias("tokens"))
    # A table of its own: next to a plain exchange Spark can split the lines of
    # a template that a third of the documents share.
    recurring, _ = staged(
        per_doc.groupBy("leaf", "tail")
        .agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"), F.max("tokens").alias("tokens"))
        .where(F.col("n_docs") >= needed(F.col("tokens"), recurs)).select("leaf", "tail", "first_doc"), "recurring")
    gone, _ = staged(
        keyed.join(recurring, ["leaf", "tail"]).where("doc_id != first_doc")
        .select(F.col("doc_id").alias("gone_id"), F.col("row_key").alias("gone_key"), "pos")
        .groupBy("gone_id", "gone_key").agg(F.collect_set("pos").alias("gone")), "gone")
    release(docs.sparkSession, line_path)
    # The text travels through the join as its lines, so they are split once.
    split = docs.select(F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row"),
                        F.col("doc_id").alias("id"), F.xxhash64("text").alias("row_key"),
                        F.split("text", "\n", -1).alias("parts"))
    joined = split.join(gone, (F.col("id") == F.col("gone_id"))
                        & (F.col("row_key") == F.col("gone_key")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("parts")).otherwise(
        F.transform(stay, lambda i: F.get(F.col("parts"), i)))
    return joined.select(
        *[F.array_join(kept, "\n").alias("text") if c == "text" else F.col(f"row.`{c}`")
          for c in docs.columns],
        F.coalesce(F.size("parts"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
