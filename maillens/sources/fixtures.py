"""Tables derived from the given Parquet data, in the shapes the jobs read.

Each derived table exists twice: as a Spark DataFrame (what the library
computes on) and as DuckDB SQL (used only by the correctness oracle).

* ``messages(msg_id, sender, to_list)``: one mail per order; the sender is
  derived from the customer key, the recipients from the supplier keys of
  the order's line items, comma-joined in sorted order (``''`` if none).
* ``insiders(name, email, f02..f15, poi)``: 17 columns, like the financial
  table of persons: every customer, some feature cells null.
* ``raw_mails(msg_id, raw)``: ``messages`` rendered as RFC-822 text with a
  folded ``To`` header and the body of document ``msg_id % N`` (N documents);
  the order key picks an odd form for half of them (no From, multipart,
  repeated To, a line that is no header, CRLF, ...).
* ``mime_mails(msg_id, raw)``: every document as a mail whose MIME form goes by
  ``doc_id % 6``: multiparts with and without delimiters, nested ones, a message
  in a message, quoted-printable and base64, three charsets; every fifth in CRLF.
* ``doc_features(doc_id, label, 10 counts)``: a labelled learning table
  whose size grows with ``documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maillens.sources.tables import read_table, table_path

# Fixed values of the derived tables.
FEATURE_INDEXES = tuple(range(2, 16))   # f02 .. f15
POI_EVERY = 8              # c_custkey % 8 = 0 marks a person of interest

FEATURE_COLUMNS = tuple(f"f{i:02d}" for i in FEATURE_INDEXES)


def address(key) -> F.Column:
    return F.concat(F.lit("u"), key, F.lit("@x.com"))


def source_paths(sf_dir: str, *tables: str) -> list[str]:
    """Paths of the given tables that a derived table reads."""
    return [table_path(sf_dir, t) for t in tables]


def messages(spark: SparkSession, sf_dir: str, first: int | None = None) -> DataFrame:
    """The mails (``first``: only those with the smallest keys)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    if first is not None:
        orders = orders.orderBy("o_orderkey").limit(first)
    items = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    # Join and aggregate share the order-key partitioning: one shuffle each side.
    return (
        orders.join(items, orders.o_orderkey == items.l_orderkey, "left")
        .groupBy("o_orderkey", "o_custkey")
        .agg(F.array_join(F.array_sort(F.collect_list(address(F.col("l_suppkey")))), ",")
             .alias("to_list"))
        .select(F.col("o_orderkey").alias("msg_id"),
                address(F.col("o_custkey")).alias("sender"),
                "to_list")
    )


def message_senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(msg_id, sender): one row per mail, without its recipient list."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.select(F.col("o_orderkey").alias("msg_id"),
                         address(F.col("o_custkey")).alias("sender"))


def message_recipients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(msg_id, sender, recipient): the same mails in long form, one row
    per listed recipient, no list is ever built (a mail without items has
    no row here; ``message_senders`` still holds it)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return orders.join(items, orders.o_orderkey == items.l_orderkey).select(
        F.col("o_orderkey").alias("msg_id"), address(F.col("o_custkey")).alias("sender"),
        address(F.col("l_suppkey")).alias("recipient"))


def insiders(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    feats = [
        F.when((key + i) % 5 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("c_acctbal") * i + (key * i) % 97).alias(f"f{i:02d}")
        for i in FEATURE_INDEXES
    ]
    return c.select(
        F.concat(F.lit("Name "), key).alias("name"),
        F.concat(F.lit("u"), key, F.lit("@x.com")).alias("email"),
        *feats,
        (key % POI_EVERY == 0).alias("poi"),
    )


# Forms of the raw mails by ``msg_id % FORM_KEYS`` (None: all other keys).
FORM_KEYS = 16
CRLF_KEY = 7
_HEAD = "Message-ID: <{id}>\nFrom: {from}\n"
MAIL_FORMS = {
    None: _HEAD + "To: {to}\nSubject: m{id}\n\n",
    0: "Message-ID: <{id}>\nTo: {to}\nSubject: m{id}\n\n",
    1: _HEAD + "To: {to}\nContent-Type: multipart/mixed; boundary=\"zz{id}\"\n\n",
    2: _HEAD + "To: {to}\nContent-Type:\n\tmultipart/alternative;\n boundary=b{id}\n\n",
    3: _HEAD + "To: {to}\nTo: later@x.com\n\n",
    4: _HEAD + "X-To: other@x.com\nTo: {to}\nSubject: m{id}\n\n",
    5: "\n" + _HEAD + "To: {to}\n\n",
    6: _HEAD + "this line is no header\nTo: {to}\n\n",
    8: _HEAD + "To: {to}\n \nno header either\n\n",
}


def raw_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = messages(spark, sf_dir)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    # Bodies cycle through the whole document table (ids are 0..N-1), so
    # every document becomes mail text. N is one number from the scan; the
    # join is left to the planner (sort-merge at scale, uniform keys).
    n_docs = docs.count()
    joined = msgs.join(docs, (msgs.msg_id % F.lit(max(n_docs, 1))) == docs.doc_id, "left")
    to = F.replace(F.col("to_list"), F.lit(","), F.lit(",\n\t"))

    def form(template: str) -> F.Column:
        mail = F.lit(template)
        for mark, value in (("{id}", F.col("msg_id").cast("string")), ("{from}", F.col("sender")), ("{to}", to)):
            mail = F.replace(mail, F.lit(mark), value)
        return F.concat(mail, F.coalesce(F.col("text"), F.lit("")))

    raw = form(MAIL_FORMS[None])
    for key, template in MAIL_FORMS.items():
        if key is not None:
            raw = F.when(F.col("msg_id") % FORM_KEYS == key, form(template)).otherwise(raw)
    crlf = F.col("msg_id") % FORM_KEYS == CRLF_KEY
    return joined.select("msg_id", F.when(crlf, F.replace(raw, F.lit("\n"), F.lit("\r\n"))).otherwise(raw).alias("raw"))


# Forms of the MIME mails by ``doc_id % 6``; {qp} and {b64} are the encoded text.
_MIME_HEAD = "From: u{id}@x.com\nMIME-Version: 1.0\n"
MIME_FORMS = {
    0: _MIME_HEAD + "Content-Type: multipart/mixed; boundary=\"zz{id}\"\n\n{text}",
    1: _MIME_HEAD + "Content-Type: multipart/mixed; boundary=\"b+{id}?\"\n\nbefore\n--b+{id}?\n"
       "Content-Type: text/plain; charset=utf-8\n\n{text}\n--b+{id}?  \n"
       "Content-Type: text/html; charset=\"UTF-8\"\nContent-Transfer-Encoding: base64\n\n{b64}\n--b+{id}?\n"
       "Content-Type: application/octet-stream\nContent-Transfer-Encoding: base64\n\nAAEC\n--b+{id}?--\nbehind\n",
    2: _MIME_HEAD + "Content-Type:\n\tmultipart/mixed;\n boundary=o{id}\n\n--o{id}\n"
       "Content-Type: multipart/alternative; boundary=o{id}x\n\n--o{id}x\n\n{text}\n--o{id}x\n"
       "Content-Type: text/html; charset=utf-8\nContent-Transfer-Encoding: Quoted-Printable\n\n{qp}\n--o{id}x--\n"
       "--o{id}\nContent-Type: text/plain; charset=iso-8859-1\nContent-Transfer-Encoding: quoted-printable\n\n"
       "caf=E9 {id} =3D soft=\n break \t\nend\n--o{id}--\n",
    3: _MIME_HEAD + "Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: quoted-printable\n\n{qp}",
    4: _MIME_HEAD + "Content-Type: message/rfc822\n\nFrom: v{id}@x.com\n"
       "Content-Type: multipart/mixed; boundary=q{id}\n\n--q{id}\nContent-Type: text/plain; charset=windows-1252\n"
       "Content-Transfer-Encoding: quoted-printable\n\n=80 {id} =93quoted=94\n--q{id}\n\n{text}\nno end",
    5: _MIME_HEAD + "Content-Transfer-Encoding: base64\n\n{b64}",
}


def mime_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    wrapped = F.regexp_replace(F.base64(F.encode(text, "UTF-8")), "(.{76})", "$1\n")
    every_byte = F.regexp_replace(F.regexp_replace(F.hex(text), "(..)", "=$1"), "((?:=..){24})", "$1=\n")

    def form(template: str) -> F.Column:
        mail = F.lit(template)
        for mark, value in (("{id}", F.col("doc_id").cast("string")), ("{qp}", every_byte), ("{b64}", wrapped),
                            ("{text}", text)):
            if mark in template:
                mail = F.replace(mail, F.lit(mark), value)
        return mail

    raw = F.lit(None).cast("string")
    for key, template in MIME_FORMS.items():
        raw = F.when(F.col("doc_id") % len(MIME_FORMS) == key, form(template)).otherwise(raw)
    return docs.select(F.col("doc_id").alias("msg_id"), F.when(
        F.col("doc_id") % 5 == 0, F.replace(raw, F.lit("\n"), F.lit("\r\n"))).otherwise(raw).alias("raw"))


# Character classes counted per document (fixed values).
DIGITS = "0123456789"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
COUNTED_CLASSES = (
    ("n_digit", DIGITS),
    ("n_upper", UPPER),
    ("n_lower", LOWER),
    ("n_line", "\n"),
    ("n_blank", " "),
    ("n_stop", "."),
    ("n_comma", ","),
    ("n_mark", "@*#"),
)
DOC_FEATURE_COLUMNS = ("n_chars", "n_len") + tuple(n for n, _ in COUNTED_CLASSES)


# (256, classes): 1 where a byte belongs to a class. All classes are ASCII, whose
# bytes occur in UTF-8 as these characters only.
_MEMBER = np.array([[chr(b) in chars for _, chars in COUNTED_CLASSES] for b in range(128)]
                   + [[False] * len(COUNTED_CLASSES)] * 128, np.int64)


def _count_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text``, the last column, becomes one count per class (null text: null):
    one pass over its bytes."""
    for batch in batches:
        text = batch.column(batch.num_columns - 1).cast(pa.large_binary())
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        seen = np.zeros((len(text), len(COUNTED_CLASSES)), np.int64)
        for i, (start, end) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            seen[i] = np.bincount(data[start:end], minlength=256) @ _MEMBER
        null = text.is_null().to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *[pa.array(np.ascontiguousarray(c), mask=null) for c in seen.T]],
            names=[*batch.schema.names[:-1], *[name for name, _ in COUNTED_CLASSES]])


def doc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted before the join, so that it moves counts and no texts."""
    d = read_table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", F.length("text").cast("bigint").alias("n_len"), "text")
    counted = d.drop("text").schema
    for name, _ in COUNTED_CLASSES:
        counted = counted.add(name, "long")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return d.mapInArrow(_count_classes, counted).join(lab, "doc_id").select(
        "doc_id", "label", *DOC_FEATURE_COLUMNS)


# ---------------------------------------------------------------- oracle SQL

def _insiders_sql() -> str:
    feats = ",\n       ".join(
        f"case when (c_custkey + {i}) % 5 = 0 then null "
        f"else c_acctbal * {i} + (c_custkey * {i}) % 97 end f{i:02d}"
        for i in FEATURE_INDEXES
    )
    return (
        "select concat('Name ', c_custkey) name, concat('u', c_custkey, '@x.com') email,\n"
        f"       {feats},\n"
        f"       c_custkey % {POI_EVERY} = 0 poi\n"
        "from customer"
    )


def _raw_mails_sql() -> str:
    def form(template: str) -> str:
        text = "'" + template.replace("\n", "' || chr(10) || '").replace("\t", "' || chr(9) || '") + "'"
        for mark, value in (("{id}", "msg_id::varchar"), ("{from}", "sender"), ("{to}", "folded")):
            text = f"replace({text}, '{mark}', {value})"
        return f"{text} || coalesce(text, '')"

    cases = "\n".join(f"when msg_id % {FORM_KEYS} = {k} then {form(t)}"
                      for k, t in MAIL_FORMS.items() if k is not None)
    return f"""
select msg_id, case when msg_id % {FORM_KEYS} = {CRLF_KEY} then replace(r, chr(10), chr(13) || chr(10)) else r end raw
from (select msg_id, case {cases} else {form(MAIL_FORMS[None])} end r
      from (select msg_id, sender, text, replace(to_list, ',', concat(',', chr(10), chr(9))) folded
            from messages left join documents
            on msg_id % (select greatest(count(*), 1) from documents) = doc_id))"""


def _mime_mails_sql() -> str:
    wrapped = "regexp_replace(base64(encode(t)), '(.{76})', '\\1' || chr(10), 'g')"
    every_byte = ("regexp_replace(regexp_replace(hex(t), '(..)', '=\\1', 'g'), '((?:=..){24})', "
                  "'\\1=' || chr(10), 'g')")

    def form(template: str) -> str:
        text = "'" + template.replace("\n", "' || chr(10) || '").replace("\t", "' || chr(9) || '") + "'"
        for mark, value in (("{id}", "doc_id::varchar"), ("{qp}", every_byte), ("{b64}", wrapped), ("{text}", "t")):
            if mark in template:
                text = f"replace({text}, '{mark}', {value})"
        return text

    cases = " ".join(f"when doc_id % {len(MIME_FORMS)} = {k} then {form(t)}" for k, t in MIME_FORMS.items())
    return (f"select doc_id msg_id, case when doc_id % 5 = 0 then replace(r, chr(10), chr(13) || chr(10)) else r end raw "
            f"from (select doc_id, case {cases} end r from (select doc_id, coalesce(text, '') t from documents))")


_DUCK_CLASSES = {
    "n_digit": "[^0-9]", "n_upper": "[^A-Z]", "n_lower": "[^a-z]",
    "n_line": "[^\\n]", "n_blank": "[^ ]", "n_stop": "[^.]",
    "n_comma": "[^,]", "n_mark": "[^@*#]",
}

SQL = {
    "messages": f"""
select o_orderkey msg_id, concat('u', o_custkey, '@x.com') sender,
       coalesce(string_agg(r, ',' order by r) filter (where r is not null), '') to_list
from (select o_orderkey, o_custkey,
             case when l_suppkey is not null
                  then concat('u', l_suppkey, '@x.com') end r
      from orders left join lineitem on o_orderkey = l_orderkey)
group by 1, 2""",
    "insiders": _insiders_sql(),
    "raw_mails": _raw_mails_sql(),
    "mime_mails": _mime_mails_sql(),
    "doc_features": "select d.doc_id, quality label, n_chars, length(text)::BIGINT n_len,\n  "
    + ",\n  ".join(
        f"length(regexp_replace(text, '{rx}', '', 'g'))::BIGINT {name}"
        for name, rx in _DUCK_CLASSES.items())
    + "\nfrom documents d join labels l on d.doc_id = l.doc_id",
}

# Order matters: later fixtures may read earlier ones.
_DEPENDS = {"raw_mails": ("messages",)}


def with_fixtures(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding the named fixtures (and their inputs), then ``body``.

    ``extra`` adds further named CTEs after the fixtures, in order.
    """
    ordered: list[str] = []

    def add(n: str) -> None:
        for dep in _DEPENDS.get(n, ()):
            add(dep)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    ctes = [f"{n} as ({SQL[n]})" for n in ordered]
    ctes += [f"{n} as ({q})" for n, q in (extra or {}).items()]
    if not ctes:
        return body
    return "with " + ",\n".join(ctes) + "\n" + body
