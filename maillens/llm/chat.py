"""Chat formatting in budgeted, turn-aligned windows.

A turn is rendered as ``<|role|>``, a line end, its text, ``</s>`` and a line
end. Control strings inside a text (``<s>``, ``</s>``, ``[INST]``,
``[/INST]``, ``<|``) get a backslash behind their first character, and one
more where such backslashes already stand there, so reading back takes one
off again and restores every text.

A window holds at most ``BUDGET`` tokens, everything counted. Every window
but the one that holds it repeats the conversation's first system turn
(unless that takes over half the budget: then none does), then the turns
directly before it that start within ``HISTORY`` tokens; half of what is left
is the conversation's cell. Prefix sums of turn tokens place the turns: a turn
belongs to the cell in which it ends, a turn larger than a cell stands alone.
A window of such a turn repeats history only if that fits the budget, and the
system turn only if that fits; a turn that is larger than the budget stands
in a window of its own size. The loss mask covers the assistant texts of
a window's own turns; repeated ones are masked out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from maillens.llm.common import staged

BUDGET = 4096           # tokens of a window
HISTORY = 256           # tokens repeated before a window's own turns
CELL = (BUDGET - HISTORY) // 2      # of a conversation without a system turn
TARGET = "assistant"
SYSTEM = "system"
END = "</s>\n"

_CONTROL = r"(?=/?s>|\||/?INST\])"
_NO_CONV = -(1 << 63)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[]\\*+)" + _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[]\\*)\\" + _CONTROL, "$1")


_ROLE_CODES = (("%", "%25"), ("|", "%7C"), ("<", "%3C"))


def escape_role(role: Column) -> Column:
    for char, code in _ROLE_CODES:
        role = F.replace(role, F.lit(char), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for char, code in reversed(_ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(char))
    return role


def token_count(text: Column) -> Column:
    """Four UTF-8 bytes a token, and four tokens for the turn's marks."""
    return (F.ceil(F.octet_length(text) / 4) + 4).cast("long")


def _ordered(turns: DataFrame) -> DataFrame:
    """The turns in a written table, dealt into ranges of (conversation, turn,
    role, text): ``stretch`` is a turn's range, so a conversation of any length,
    and with any turn numbers, lies in many."""
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_CONV)).alias("conv"),
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("raw"))
    rows = rows.withColumn("body", escape(F.col("raw"))).withColumn("row", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange("conv", "turn", "role", "raw", "row")
    return staged(ranged.withColumn("stretch", F.spark_partition_id())
                  .withColumn("tokens", token_count(F.col("body"))), "ordered-turns")[0]


def _systems(ordered: DataFrame) -> DataFrame:
    """(conv, system_row, system_tokens): the first system turn of each
    conversation that has one."""
    first = F.min(F.struct("turn", "raw", "row", "tokens"))
    return (ordered.where(F.col("role") == SYSTEM).groupBy("conv").agg(first.alias("s"))
            .select("conv", F.col("s.row").alias("system_row"), F.col("s.tokens").alias("system_tokens")))


def _placed(ordered: DataFrame) -> DataFrame:
    """Turns with prefix sums: ``at`` (tokens before), ``part``, ``cell``, and
    ``kept``, the tokens of the system turn that windows repeat."""
    kept = F.when(F.col("system_tokens") <= BUDGET // 2, F.col("system_tokens")).otherwise(0)
    rows = ordered.join(_systems(ordered), "conv", "left").withColumn("kept", F.coalesce(kept, F.lit(0)))
    rows = rows.withColumn("room", F.floor((BUDGET - HISTORY - F.col("kept")) / 2))
    rows = rows.withColumn("big", (F.col("tokens") > F.col("room")).cast("long"))
    # Two levels: sums of stretches, then inside a stretch.
    sums = rows.groupBy("conv", "stretch").agg(F.sum("tokens").alias("t"), F.sum("big").alias("b"))
    before = W.partitionBy("conv").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("conv", "stretch", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"),
                       F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"))
    inner = (W.partitionBy("conv", "stretch").orderBy("turn", "role", "raw", "row")
             .rowsBetween(W.unboundedPreceding, 0))
    rows = (rows.select("*", F.sum("tokens").over(inner).alias("t1"), F.sum("big").over(inner).alias("b1"))
            .join(sums, ["conv", "stretch"]))
    end = F.col("t0") + F.col("t1")
    n_big = F.col("b0") + F.col("b1") - F.col("big")
    return rows.select(
        "conv", "role", "body", "tokens", "kept", (F.col("row") == F.col("system_row")).alias("system"),
        (end - F.col("tokens")).alias("at"), (2 * n_big + F.col("big")).alias("part"),
        F.when(F.col("big") == 1, 0).otherwise(F.floor((end - 1) / F.col("room"))).cast("long").alias("cell"))


def windows(turns: DataFrame) -> DataFrame:
    """Formatted windows of ``turns(conv_id, turn, role, text, ...)``.

    Returns ``conv_id, start`` (tokens of the conversation before the
    window's own turns), ``text, repeated`` (turns repeated in front),
    ``n_tokens, loss``: an array of (start, end) code point spans of ``text``.

    Null texts and roles are empty; turns follow their number (nulls first),
    equal numbers by role and text, repeated rows all stay; rows without
    conv_id form one conversation with a null id; other columns are ignored;
    an empty table gives an empty one. Turns are never cut; ``n_tokens`` is at
    most ``BUDGET`` but for a single turn that is larger.
    """
    placed, _ = staged(_placed(_ordered(turns)), "turns")
    spans = placed.groupBy("conv", "part", "cell").agg(
        F.min("at").alias("start"), F.sum("tokens").alias("own"), F.max("kept").alias("kept"))
    own = placed.join(spans, ["conv", "part", "cell"]).select(
        "conv", "start", F.lit(2).alias("kind"), "at", "role", "body", "tokens")
    first = placed.where("system").select("conv", F.struct("at", "role", "body", "tokens", "part", "cell").alias("s"))
    system = (spans.join(first, "conv")
              .where((F.col("s.part") != F.col("part")) | (F.col("s.cell") != F.col("cell")))
              .where((F.col("s.at") < F.col("start")) & (F.col("kept") > 0) & (F.col("own") + F.col("kept") <= BUDGET))
              .select("conv", "start", F.lit(0).alias("kind"), "s.at", "s.role", "s.body", "s.tokens"))
    # A turn is history of the windows that start within HISTORY tokens behind
    # its own start: both fall into the same or neighbouring strips.
    strip = F.floor(F.col("start") / HISTORY)
    reach = spans.where(F.col("own") + F.col("kept") + HISTORY <= BUDGET).select(
        "conv", "start", F.explode(F.array(strip, strip - 1)).alias("strip"))
    past = (placed.select("conv", "at", "role", "body", "tokens", F.floor(F.col("at") / HISTORY).alias("strip"))
            .join(reach, ["conv", "strip"])
            .where((F.col("at") < F.col("start")) & (F.col("at") >= F.col("start") - HISTORY))
            .join(first.select("conv", F.col("s.at").alias("system_at")), "conv", "left")
            .where(F.col("system_at").isNull() | (F.col("system_at") != F.col("at")))
            .select("conv", "start", F.lit(1).alias("kind"), "at", "role", "body", "tokens"))
    parts = own.unionByName(system).unionByName(past)
    head = F.concat(F.lit("<|"), escape_role(F.col("role")), F.lit("|>\n"))
    parts = parts.select("conv", "start", "kind", "at", "tokens", head.alias("head"), "body",
                         ((F.col("kind") == 2) & (F.col("role") == TARGET)).alias("target"))
    inner = (W.partitionBy("conv", "start").orderBy("kind", "at").rowsBetween(W.unboundedPreceding, 0))
    size = F.length("head") + F.length("body") + len(END)
    parts = parts.select("*", (F.sum(size).over(inner) - len(END)).alias("end"))
    span = F.struct((F.col("end") - F.length("body")).alias("start"), F.col("end").alias("end"))
    listed = parts.groupBy("conv", "start").agg(
        F.array_sort(F.collect_list(F.struct("kind", "at", F.concat("head", "body", F.lit(END)).alias("text")))).alias("all"),
        F.array_sort(F.collect_list(F.when(F.col("target"), span))).alias("loss"),
        F.sum((F.col("kind") < 2).cast("long")).alias("repeated"), F.sum("tokens").alias("n_tokens"))
    return listed.select(
        F.when(F.col("conv") != _NO_CONV, F.col("conv")).alias("conv_id"), "start",
        F.array_join(F.transform("all", lambda p: p["text"]), "").alias("text"),
        "repeated", "n_tokens", "loss")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, start, turns, losses, n_chars): a window's own turns as
    (role, text), the texts under its loss mask, and its length, taken from
    the formatted text alone."""
    pieces = F.split("text", END, -1)
    mine = F.slice(pieces, (F.col("repeated") + 1).cast("int"),
                   F.greatest(F.size(pieces) - 1 - F.col("repeated").cast("int"), F.lit(0)))
    close = lambda t: F.instr(t, "|>\n")
    turns = F.transform(mine, lambda t: F.struct(
        unescape_role(F.substring(t, F.lit(3), close(t) - 3)).alias("role"),
        unescape(F.substring(t, close(t) + 3, F.length(t))).alias("text")))
    losses = F.transform("loss", lambda s: unescape(
        F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("conv_id", "start", turns.alias("turns"), losses.alias("losses"),
                            F.length("text").cast("long").alias("n_chars"))
