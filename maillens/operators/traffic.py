"""Who wrote to whom: per-person mail counts.

Inputs
------
``messages(msg_id, sender, to_list)``: ``to_list`` is the comma-joined
recipient string of one mail (an address listed twice counts twice; an
empty list is one empty recipient, which matches nobody).

``people(email, poi, ...)``: the person table (insiders) with a boolean
person-of-interest flag.

While the person table is small enough to broadcast (size checked), every
count is restricted to the persons *before* the shuffle, and the partial
hash aggregate combines map-side. A larger person table meets the mails only
after they are aggregated to (sender, recipient, n) or to one row per
address. Either way a sender or recipient that holds a third of all mails
ships one row per task and partner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillens.functions.mail import RECIPIENT_SEPARATOR
from maillens.operators.joins import DEFAULT_BROADCAST_BYTES, bytes_at_most, hint, semi_join

COUNT_COLUMNS = ("n_sent", "n_received", "n_from_poi", "n_to_poi")


def recipient_list(to_list: F.Column) -> F.Column:
    """The recipient string split on commas (no trimming, as stored)."""
    return F.split(to_list, RECIPIENT_SEPARATOR)


def exploded_recipients(messages: DataFrame) -> DataFrame:
    """(msg_id, sender, pos, recipient): one row per listed recipient.

    ``posexplode_outer`` keeps a mail with a null list as one row with
    null position, so per-mail counts can use ``pos = 0 or pos is null``.
    """
    return messages.select(
        "msg_id", "sender",
        F.posexplode_outer(recipient_list(F.col("to_list"))).alias("pos", "recipient"),
    )


def recipients_of(messages: DataFrame) -> DataFrame:
    """(email): one row per listed recipient (an empty list gives one ''),
    via ``explode_outer`` + null filter so the split is not repeated in an
    inferred ``size(...) > 0`` filter below the generator."""
    return (messages.select(F.explode_outer(recipient_list(F.col("to_list"))).alias("email"))
            .where(F.col("email").isNotNull()))


def poi_list(people: DataFrame) -> DataFrame:
    """E-mail addresses of persons of interest."""
    return people.where(F.col("poi")).select("email")


def insider_messages(messages: DataFrame, people: DataFrame) -> DataFrame:
    """Mails whose sender is one of ``people`` (semi join, not a list)."""
    return semi_join(messages, people, "sender", "email")


def mails_sent(messages: DataFrame, people: DataFrame, small: bool | None = None) -> DataFrame:
    """(email, n_sent) for persons that sent at least one mail."""
    return _count_of(messages.select(F.col("sender").alias("email")), people, "n_sent", small)


def mails_received(messages: DataFrame, people: DataFrame, small: bool | None = None) -> DataFrame:
    """(email, n_received): recipient occurrences per person."""
    return _count_of(recipients_of(messages), people, "n_received", small)


def _count_of(rows: DataFrame, people: DataFrame, name: str, small: bool | None) -> DataFrame:
    """Rows per person of ``rows(email)``: persons first when they can be
    broadcast, else one row per address first."""
    small = people_are_small(people) if small is None else small
    if small:
        rows = semi_join(rows, people, "email", "email", small=True)
    counts = rows.groupBy("email").agg(F.count(F.lit(1)).alias(name))
    return counts if small else semi_join(counts, people, "email", "email", small=False, aggregated=True)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(sender, recipient, n) of (sender, recipient) rows."""
    return rows.groupBy("sender", "recipient").agg(F.count(F.lit(1)).alias("n"))


def _weighted(rows: DataFrame, small: bool) -> DataFrame:
    """(sender, recipient, n): single rows for a broadcast, else aggregated."""
    return rows.select("sender", "recipient", F.lit(1).alias("n")) if small else pair_counts(rows)


def people_are_small(people: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """One bounded probe of the person table. Every table broadcast below
    (POI list, person keys, per-person counts) has at most as many rows and
    little more per row, so this single decision covers them all."""
    return bytes_at_most(people.select("email"), max_bytes)


def _poi_flag(df: DataFrame, people: DataFrame, on: str, flag: str,
              small: bool | None = None) -> DataFrame:
    small = people_are_small(people) if small is None else small
    poi = hint(poi_list(people).distinct(), small).select(
        F.col("email").alias("__poi"), F.lit(True).alias(flag))
    return (df.join(poi, df[on] == poi["__poi"], "left")
            .drop("__poi")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def sent_to_poi(messages: DataFrame, people: DataFrame, small: bool | None = None) -> DataFrame:
    """(email, n_to_poi): POI recipient occurrences over a person's mails.

    Every person that sent a mail has a row; zero when none went to a POI.
    """
    small = people_are_small(people) if small is None else small
    rows = _weighted(exploded_recipients(messages), small)
    if small:
        rows = semi_join(rows, people, "sender", "email", small=True)
    rows = _poi_flag(rows, people, "recipient", "to_poi", small)
    counts = (rows.groupBy(F.col("sender").alias("email"))
              .agg(F.sum(F.when(F.col("to_poi"), F.col("n")).otherwise(0)).cast("bigint").alias("n_to_poi")))
    return counts if small else semi_join(counts, people, "email", "email", small=False, aggregated=True)


def mails_to_poi(messages: DataFrame, people: DataFrame, small: bool | None = None) -> DataFrame:
    """(email, n_mails_to_poi): mails of a person with at least one POI
    recipient. A mail counts once, so it is
    reduced to (msg_id, sender) before it is counted by sender."""
    small = people_are_small(people) if small is None else small
    rows = exploded_recipients(messages).select("msg_id", "sender", "recipient")
    hits = semi_join(rows, poi_list(people), "recipient", "email", small=small)
    hits = (hits.groupBy("msg_id", "sender").agg(F.lit(1).alias("one"))
            .groupBy(F.col("sender").alias("email")).agg(F.count("one").alias("n_mails_to_poi")))
    senders = mails_sent(messages, people, small).select("email")
    return (senders.join(hits, "email", "left")
            .select("email", F.coalesce("n_mails_to_poi", F.lit(0)).cast("bigint").alias("n_mails_to_poi")))


def received_from_poi(messages: DataFrame, people: DataFrame, small: bool | None = None) -> DataFrame:
    """(email, n_from_poi): recipient occurrences of a person in mails
    sent by a POI; only persons with at least one such mail."""
    small = people_are_small(people) if small is None else small
    rows = _weighted(exploded_recipients(messages).where(F.col("recipient").isNotNull()), small)
    rows = semi_join(rows, poi_list(people), "sender", "email", small=small, aggregated=True)
    if small:
        rows = semi_join(rows, people, "recipient", "email", small=True)
    counts = (rows.groupBy(F.col("recipient").alias("email"))
              .agg(F.sum("n").cast("bigint").alias("n_from_poi")))
    return counts if small else semi_join(counts, people, "email", "email", small=False, aggregated=True)


def recipients_by_sender(messages: DataFrame, people: DataFrame) -> DataFrame:
    """The grouped recipient lists of each person, as a multiset in long
    form (sender, recipient, n) -- never one collected list per sender."""
    small = people_are_small(people)
    if small:
        return pair_counts(exploded_recipients(semi_join(messages, people, "sender", "email", small=True)))
    return semi_join(pair_counts(exploded_recipients(messages)), people, "sender", "email", small=False, aggregated=True)


def message_count(messages: DataFrame) -> DataFrame:
    return messages.agg(F.count(F.lit(1)).alias("n_messages"))


def traffic_counts(messages: DataFrame, people: DataFrame,
                   small: bool | None = None) -> DataFrame:
    """All four counts from the message-line form (one scan of the messages).

    A mail's first recipient row also stands for the mail itself. Result:
    (email, n_sent, n_received, n_from_poi, n_to_poi) for every person with
    any traffic.
    """
    rows = exploded_recipients(messages)
    first = ((F.col("pos") == 0) | F.col("pos").isNull()).cast("int")
    return _counts(rows.select("sender", "recipient", first.alias("mails"),
                               F.col("recipient").isNotNull().cast("int").alias("n")), people, small)


def traffic_counts_long(senders: DataFrame, recipients: DataFrame, people: DataFrame,
                        small: bool | None = None) -> DataFrame:
    """``traffic_counts`` from long-form input: ``senders(msg_id, sender)``
    (one row per mail) and ``recipients(msg_id, sender, recipient)`` (one
    row per listed recipient, as a mail store or a join delivers them).

    No per-mail list is ever assembled, so a mail with a huge recipient
    list is spread over tasks like any other rows.
    """
    none = F.lit(None).cast("string")
    mails = senders.select("sender", none.alias("recipient"), F.lit(1).alias("mails"), F.lit(0).alias("n"))
    rows = recipients.select("sender", "recipient", F.lit(0).alias("mails"), F.lit(1).alias("n"))
    return _counts(mails.unionByName(rows), people, small)


def _counts(rows: DataFrame, people: DataFrame, small: bool | None) -> DataFrame:
    """The four counts from ``rows(sender, recipient, mails, n)``.

    Every row contributes to its sender (mails, recipients that are POI) and
    to its recipient (receipts, receipts from POI); both contributions go
    through one semi join on the persons and one aggregate. When persons are
    not broadcast, rows are first aggregated by (sender, recipient) and the
    contributions by address, so no join sees single mails.
    """
    small = people_are_small(people) if small is None else small
    if not small:
        rows = rows.groupBy("sender", "recipient").agg(F.sum("mails").alias("mails"), F.sum("n").alias("n"))
    rows = _poi_flag(rows, people, "recipient", "to_poi", small)
    rows = _poi_flag(rows, people, "sender", "from_poi", small)
    zero = F.lit(0).cast("bigint")
    when = lambda flag: F.when(F.col(flag), F.col("n")).otherwise(0).cast("bigint")
    contrib = rows.select(F.inline(F.array(
        F.struct(F.col("sender").alias("email"), F.col("mails").cast("bigint").alias("sent"),
                 zero.alias("received"), zero.alias("from_poi"), when("to_poi").alias("to_poi")),
        F.struct(F.col("recipient").alias("email"), zero.alias("sent"),
                 F.col("n").cast("bigint").alias("received"), when("from_poi").alias("from_poi"),
                 zero.alias("to_poi")))))
    totals = [F.sum(c).cast("bigint").alias(f"n_{c}") for c in ("sent", "received", "from_poi", "to_poi")]
    if small:
        return semi_join(contrib, people, "email", "email", small=True).groupBy("email").agg(*totals)
    return semi_join(contrib.groupBy("email").agg(*totals), people, "email", "email", small=False, aggregated=True)


def insider_features_long(senders: DataFrame, recipients: DataFrame, people: DataFrame,
                          how: str = "left") -> DataFrame:
    """``insider_features`` from long-form mail input."""
    small = people_are_small(people)
    counts = traffic_counts_long(senders, recipients, people, small)
    return attach_counts(people, counts, how, small)


def attach_counts(people: DataFrame, counts: DataFrame, how: str = "left",
                  small: bool | None = None) -> DataFrame:
    """People columns, then the four counts, then ``poi`` last.

    ``how='left'`` keeps every person (zero for no traffic); ``'inner'``
    keeps persons present in all four count tables of the reference
    (sent >= 1, received >= 1, received from a POI >= 1).
    """
    people_cols = [c for c in people.columns if c != "poi"]
    if how == "inner":
        counts = counts.where((F.col("n_sent") > 0) & (F.col("n_received") > 0)
                              & (F.col("n_from_poi") > 0))
        joined = people.join(hint(counts, small), "email", "inner")
    elif how == "left":
        joined = people.join(hint(counts, small), "email", "left")
    else:
        raise ValueError("how must be 'left' or 'inner'")
    return joined.select(
        *people_cols,
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in COUNT_COLUMNS],
        "poi",
    )


def insider_features(messages: DataFrame, people: DataFrame, how: str = "left") -> DataFrame:
    """The person table with n_sent, n_received, n_from_poi, n_to_poi."""
    small = people_are_small(people)
    return attach_counts(people, traffic_counts(messages, people, small), how, small)


def sent_received_inner(messages: DataFrame, people: DataFrame) -> DataFrame:
    """Persons with sent and received mail: (email, n_sent, n_received)."""
    return (mails_sent(messages, people)
            .join(mails_received(messages, people), "email", "inner"))


def poi_traffic_inner(messages: DataFrame, people: DataFrame) -> DataFrame:
    """Persons with POI traffic: (email, n_from_poi, n_to_poi)."""
    return (received_from_poi(messages, people)
            .join(sent_to_poi(messages, people), "email", "inner"))
