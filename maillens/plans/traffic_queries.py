"""Queries of the mail aggregation stage (who wrote to whom)."""

from __future__ import annotations

from pyspark.sql import functions as F

from maillens.operators import traffic as T
from maillens.operators.joins import semi_join
from maillens.plans.registry import query
from maillens.sources import fixtures as fx
from maillens.sources import store as ST
from maillens.sources.scratch import materialize
from maillens.sources.tables import read_table

_PEOPLE = "select email from insiders"
_POI = "select email from insiders where poi"
_EXPLODED = "select msg_id, sender, unnest(string_split(to_list, ',')) r from messages"


def _w(body: str, *extra: tuple[str, str]) -> str:
    return fx.with_fixtures(body, "messages", "insiders", extra=dict(extra))


@query("messages", sql=fx.with_fixtures("select * from messages", "messages"))
def q_messages(spark, sf_dir):
    """The derived message table (msg_id, sender, to_list)."""
    return fx.messages(spark, sf_dir)


@query("insiders", sql=fx.with_fixtures("select * from insiders", "insiders"))
def q_insiders(spark, sf_dir):
    """The person table with financial features and POI flag."""
    return fx.insiders(spark, sf_dir)


@query("poi_list", sql=_w(_POI))
def q_poi_list(spark, sf_dir):
    """E-mail addresses of persons of interest."""
    return T.poi_list(fx.insiders(spark, sf_dir))


@query("insider_messages",
       sql=_w(f"select * from messages where sender in ({_PEOPLE})"))
def q_insider_messages(spark, sf_dir):
    """Mails sent by a person of the table (left-semi join)."""
    return T.insider_messages(fx.messages(spark, sf_dir), fx.insiders(spark, sf_dir))


@query("message_count", sql=_w("select count(*) n_messages from messages"))
def q_message_count(spark, sf_dir):
    """Number of mails."""
    return T.message_count(fx.messages(spark, sf_dir))


@query("mails_sent", sql=_w(
    f"select sender email, count(*) n_sent from messages "
    f"where sender in ({_PEOPLE}) group by 1"))
def q_mails_sent(spark, sf_dir):
    """Mails sent per person."""
    return T.mails_sent(fx.messages(spark, sf_dir), fx.insiders(spark, sf_dir))


@query("mails_received", sql=_w(
    f"select r email, count(*) n_received from ({_EXPLODED}) "
    f"where r in ({_PEOPLE}) group by 1"))
def q_mails_received(spark, sf_dir):
    """Recipient occurrences per person."""
    return T.mails_received(fx.messages(spark, sf_dir), fx.insiders(spark, sf_dir))


@query("sent_to_poi", sql=_w(
    f"select e.sender email, count(p.email) n_to_poi from ({_EXPLODED}) e "
    f"left join ({_POI}) p on e.r = p.email "
    f"where e.sender in ({_PEOPLE}) group by 1"))
def q_sent_to_poi(spark, sf_dir):
    """POI recipient occurrences over each person's mails."""
    return T.sent_to_poi(fx.messages(spark, sf_dir), fx.insiders(spark, sf_dir))


@query("mails_to_poi", sql=_w(
    f"select e.sender email, "
    f"count(distinct case when p.email is not null then e.msg_id end) n_mails_to_poi "
    f"from ({_EXPLODED}) e left join ({_POI}) p on e.r = p.email "
    f"where e.sender in ({_PEOPLE}) group by 1"))
def q_mails_to_poi(spark, sf_dir):
    """Mails of each person with at least one POI recipient."""
    return T.mails_to_poi(fx.messages(spark, sf_dir), fx.insiders(spark, sf_dir))


@query("received_from_poi", sql=_w(
    f"select r email, count(*) n_from_poi from ({_EXPLODED}) "
    f"where sender in ({_POI}) and r in ({_PEOPLE}) group by 1"))
def q_received_from_poi(spark, sf_dir):
    """Receipts of each person in mails sent by a POI."""
    return T.received_from_poi(fx.messages(spark, sf_dir), fx.insiders(spark, sf_dir))


@query("recipients_by_sender", sql=_w(
    f"select sender, r recipient, count(*) n from ({_EXPLODED}) "
    f"where sender in ({_PEOPLE}) group by 1, 2"))
def q_recipients_by_sender(spark, sf_dir):
    """Grouped recipients per sending person, as (sender, recipient, n)."""
    return T.recipients_by_sender(fx.messages(spark, sf_dir), fx.insiders(spark, sf_dir))


_SENT = f"select sender email, count(*) n_sent from messages where sender in ({_PEOPLE}) group by 1"
_RECV = (f"select r email, count(*) n_received from ({_EXPLODED}) "
         f"where r in ({_PEOPLE}) group by 1")
_FROM_POI = (f"select r email, count(*) n_from_poi from ({_EXPLODED}) "
             f"where sender in ({_POI}) and r in ({_PEOPLE}) group by 1")
_TO_POI = (f"select e.sender email, count(p.email) n_to_poi from ({_EXPLODED}) e "
           f"left join ({_POI}) p on e.r = p.email where e.sender in ({_PEOPLE}) group by 1")
_COUNT_CTES = (("sent", _SENT), ("recv", _RECV), ("from_poi", _FROM_POI), ("to_poi", _TO_POI))


@query("sent_received_inner", sql=_w(
    "select email, n_sent, n_received from sent join recv using (email)", *_COUNT_CTES))
def q_sent_received_inner(spark, sf_dir):
    """Inner join of mails sent and received on e-mail."""
    return T.sent_received_inner(fx.messages(spark, sf_dir), fx.insiders(spark, sf_dir))


@query("poi_traffic_inner", sql=_w(
    "select email, n_from_poi, n_to_poi from from_poi join to_poi using (email)",
    *_COUNT_CTES))
def q_poi_traffic_inner(spark, sf_dir):
    """Inner join of POI traffic in both directions on e-mail."""
    return T.poi_traffic_inner(fx.messages(spark, sf_dir), fx.insiders(spark, sf_dir))


_FEATURE_COLS = ", ".join(f"i.{c}" for c in fx.FEATURE_COLUMNS)


def _insider_features_sql(how: str) -> str:
    join = "left join" if how == "left" else "join"
    counts = ", ".join(f"coalesce({t}.{c}, 0)::BIGINT {c}" for t, c in (
        ("sent", "n_sent"), ("recv", "n_received"),
        ("from_poi", "n_from_poi"), ("to_poi", "n_to_poi")))
    return _w(
        f"select i.name, i.email, {_FEATURE_COLS}, {counts}, i.poi from insiders i "
        f"{join} sent using (email) {join} recv using (email) "
        f"{join} from_poi using (email) {join} to_poi using (email)",
        *_COUNT_CTES)


@query("insider_features", sql=_insider_features_sql("left"))
def q_insider_features(spark, sf_dir):
    """Flagship: every person with n_sent, n_received, n_from_poi, n_to_poi.

    Runs on the long form of the mails (one row per recipient straight
    from the join), so no recipient list is built anywhere in the plan."""
    return T.insider_features_long(fx.message_senders(spark, sf_dir),
                                   fx.message_recipients(spark, sf_dir),
                                   fx.insiders(spark, sf_dir))


@query("insider_features_lists", sql=_insider_features_sql("left"))
def q_insider_features_lists(spark, sf_dir):
    """The same table from the message-line model (comma-joined lists),
    counted in one scan of the messages."""
    return T.insider_features(fx.messages(spark, sf_dir), fx.insiders(spark, sf_dir))


@query("insider_features_inner", sql=_insider_features_sql("inner"))
def q_insider_features_inner(spark, sf_dir):
    """Persons present in all four count tables (reference's inner joins)."""
    return T.insider_features(fx.messages(spark, sf_dir), fx.insiders(spark, sf_dir),
                              how="inner")


@query("traffic_counts", sql=_w(
    "select email, coalesce(n_sent, 0)::BIGINT n_sent, "
    "coalesce(n_received, 0)::BIGINT n_received, "
    "coalesce(n_from_poi, 0)::BIGINT n_from_poi, coalesce(n_to_poi, 0)::BIGINT n_to_poi "
    "from (select email from sent union select email from recv) a "
    "left join sent using (email) left join recv using (email) "
    "left join from_poi using (email) left join to_poi using (email)", *_COUNT_CTES))
def q_traffic_counts(spark, sf_dir):
    """The fused one-pass count table (persons with any traffic)."""
    return T.traffic_counts(fx.messages(spark, sf_dir), fx.insiders(spark, sf_dir))



# ---------------------------------------------------------------- a hot sender

_HOT = ("select msg_id, case when msg_id % 3 = 0 then 'u1@x.com' else sender end sender, to_list from messages")


def hot_messages(spark, sf_dir):
    """The mails with one sender who holds over a third of them."""
    m = fx.messages(spark, sf_dir)
    return m.withColumn("sender", F.when(F.col("msg_id") % 3 == 0, "u1@x.com").otherwise(F.col("sender")))


@query("hot_sender_messages", sql=_w(f"select * from ({_HOT}) where sender in ({_PEOPLE})"))
def q_hot_sender_messages(spark, sf_dir):
    """Mails of persons with a hot sender and a person table that is not
    broadcast: the sender's rows are salted, no other key is copied."""
    return semi_join(hot_messages(spark, sf_dir), fx.insiders(spark, sf_dir), "sender", "email", small=False)


@query("hot_sender_counts", sql=_w(
    "select email, coalesce(n_sent, 0)::BIGINT n_sent, coalesce(n_received, 0)::BIGINT n_received, "
    "coalesce(n_from_poi, 0)::BIGINT n_from_poi, coalesce(n_to_poi, 0)::BIGINT n_to_poi "
    "from (select email from sent union select email from recv) a "
    "left join sent using (email) left join recv using (email) "
    "left join from_poi using (email) left join to_poi using (email)",
    *((n, q.replace("from messages", f"from ({_HOT})")) for n, q in _COUNT_CTES)))
def q_hot_sender_counts(spark, sf_dir):
    """The four counts with a hot sender and without any broadcast person table."""
    return T.traffic_counts(hot_messages(spark, sf_dir), fx.insiders(spark, sf_dir), small=False)


# ---------------------------------------------------------------- bucketed mail store

BUCKETS = 16


@query("insider_features_store", sql=_insider_features_sql("left"))
def q_insider_features_store(spark, sf_dir):
    """The flagship over a mail store bucketed by message key: mails and
    recipients meet without a shuffle."""
    senders, recipients = mail_store(spark, sf_dir)
    joined = recipients.join(senders, "msg_id").select("msg_id", "sender", "recipient")
    return T.insider_features_long(senders, joined, fx.insiders(spark, sf_dir))


def mail_store(spark, sf_dir, buckets: int = BUCKETS):
    """(senders, recipients) tables of the store, written once."""
    items = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("msg_id"), fx.address(F.col("l_suppkey")).alias("recipient"))
    out = []
    for name, rows, source in (("mail_senders", fx.message_senders(spark, sf_dir), "orders"),
                               ("mail_recipients", items, "lineitem")):
        path = materialize(spark, name, fx.source_paths(sf_dir, source),
                           lambda p, rows=rows: ST.write_bucketed(rows, p, "msg_id", buckets))
        out.append(ST.read_bucketed(spark, path, rows.schema, "msg_id", buckets))
    return out
