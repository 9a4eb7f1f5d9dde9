"""Bucketed store, results store, salted joins and MIME parts."""

import base64
import quopri
from email import message_from_string

import pytest
from pyspark.sql import functions as F

from maillens.operators import joins as J
from maillens.sources import mail as S
from maillens.sources import results as RS
from maillens.sources import store as ST


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_an_exchange(spark, tmp_dir):
    left = spark.range(300).select(F.col("id").alias("msg_id"), F.lit("a").alias("sender"))
    right = spark.range(900).select((F.col("id") % 310).alias("msg_id"), F.col("id").alias("n"))
    for name, df in (("l", left), ("r", right)):
        ST.write_bucketed(df, f"{tmp_dir}/{name}", "msg_id", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        a = ST.read_bucketed(spark, f"{tmp_dir}/l", left.schema, "msg_id", 4)
        b = ST.read_bucketed(spark, f"{tmp_dir}/r", right.schema, "msg_id", 4)
        joined = a.join(b, "msg_id")
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        want = left.join(right, "msg_id").count()
        assert joined.count() == want
        # another application: the files stand, the catalog does not know them
        for name in ("l", "r"):
            spark.sql(f"drop table {ST.table_name(f'{tmp_dir}/{name}')}")
        again = ST.read_bucketed(spark, f"{tmp_dir}/l", "msg_id bigint, sender string", "msg_id", 4).join(
            ST.read_bucketed(spark, f"{tmp_dir}/r", "msg_id bigint, n bigint", "msg_id", 4), "msg_id")
        assert "Exchange" not in plan_of(again) and again.count() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_runs_of_a_results_store(spark, tmp_dir, fmt):
    schema = "name string, errors array<double>, best struct<a:int,b:string>, n long"
    rows = [("x, \"y\"\nz", [0.5, None], (1, "q"), 3), ("", [], None, None), (None, None, (2, None), 4)]
    df = spark.createDataFrame(rows, schema)
    path = f"{tmp_dir}/store"
    RS.append_result(df.limit(1), path, "a", fmt)
    RS.append_result(df, path, "b", fmt)
    RS.append_result(df, path, "a", fmt)
    got = RS.read_results(spark, path, schema, fmt)
    key = lambda r: repr(r)
    flat = lambda d: sorted([(r["name"], r["errors"], tuple(r["best"]) if r["best"] else None, r["n"])
                             for r in d.collect()], key=key)
    for run in ("a", "b"):
        assert flat(got.where(F.col("run") == run)) == flat(df)
    assert got.count() == 6 and RS.read_results(spark, path, schema, fmt, ["b"]).count() == 3
    with pytest.raises(ValueError):
        RS.append_result(df.withColumn("run", F.lit(1)), path, "c", fmt)


def test_only_hot_keys_are_salted_and_copied(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), F.col("id") % 700)).alias("sender"), "id")
    keys = spark.createDataFrame([("hot",), ("k1",), ("k2",), ("none",)], "email string")
    hot = dict(J.hot_keys(rows, "sender", 30))
    assert set(hot) == {"hot"} and 10 <= hot["hot"] <= 12
    spread, copied = J.salted(rows, "sender", list(hot.items()), keys, "email")
    assert copied.where("email = 'hot'").count() == hot["hot"] and copied.count() == hot["hot"] + 3
    assert spread.where("sender != 'hot' and __salt != 0").count() == 0
    assert spread.where("sender = 'hot'").select("__salt").distinct().count() == hot["hot"]
    got = J.semi_join(rows, keys, "sender", "email", small=False)
    want = J.semi_join(rows, keys, "sender", "email", small=True)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    even = spark.range(100).select(F.col("id").cast("string").alias("sender"))
    assert J.hot_keys(even, "sender", 8) == [] and J.hot_keys(even.limit(0), "sender", 8) == []
    assert J.semi_join(even, keys, "sender", "email", small=False).count() == 0


def b64(s, charset="utf-8"):
    return base64.encodebytes(s.encode(charset)).decode()


def qp(s, charset="utf-8"):
    return quopri.encodestring(s.encode(charset)).decode()


MIME = [
    "From: a\n\nplain body\n",
    "From: a\nContent-Type: multipart/mixed; boundary=\"zz\"\n\nno delimiter here\n",
    "From: a\nContent-Type:\n\tmultipart/alternative;\n boundary=b1\n\npre\n--b1\nContent-Type: text/plain\n\none\n"
    "--b1\nContent-Type: text/html; charset=utf-8\nContent-Transfer-Encoding: quoted-printable\n\n"
    + qp("<p>héllo = wörld €</p> and a long line " * 5) + "\n--b1--\nepilogue\n",
    "From: a\nContent-Type: multipart/mixed; boundary=x\n\n--x\nContent-Type: multipart/alternative; boundary=xy\n\n"
    "--xy\n\ninner one\n\n--xy\nContent-Type: text/html\nContent-Transfer-Encoding: base64\n\n" + b64("inner two ∑ " * 20)
    + "--xy--\n\n--x\nContent-Type: text/plain; charset=\"iso-8859-1\"\nContent-Transfer-Encoding: quoted-printable\n\n"
    "caf=E9 =3D soft=\n break  \nend=\n--x--\n",
    "From: a\nContent-Type: multipart/mixed; boundary=\"a+b?c\"\n\n--a+b?c  \nContent-Type: application/pdf\n"
    "Content-Transfer-Encoding: base64\n\nAAAA\n--a+b?c\nContent-Type: text/plain; charset=windows-1252\n"
    "Content-Transfer-Encoding: quoted-printable\n\n=80 =93quoted=94\nno end delimiter\n",
    "From: a\nContent-Type: message/rfc822\n\nFrom: b\nContent-Type: multipart/mixed; boundary=q\n\n--q\n\ndeep\n--q--\n",
    "From: a\nContent-Type: weird\nContent-Transfer-Encoding: base64\n\n" + b64("text"),
    "From: a\nContent-Type: text/plain\nContent-Transfer-Encoding: quoted-printable\n\nx=ZZ y= z=4",
    "From: a\nContent-Type: multipart/mixed; boundary=m\n\n--m\n--m\n\ntwice\n--m\n\nsecond\n--m--",
    "From: a\nContent-Type: multipart/mixed; boundary=m\n\n" + "".join(f"--m\n\npart {i}\n" for i in range(12)) + "--m--\n",
    "",
]


def stdlib_leaves(raw):
    out = []

    def walk(m, path):
        if m.is_multipart():
            for i, p in enumerate(m.get_payload()):
                walk(p, f"{path}.{i + 1}" if path else str(i + 1))
            return
        kind, text = m.get_content_type(), None
        if kind.startswith(("text/", "multipart/")):
            text = m.get_payload()
            if str(m.get("content-transfer-encoding", "")).strip().lower() in ("base64", "quoted-printable"):
                text = m.get_payload(decode=True).decode(m.get_content_charset() or "utf-8", "replace")
        out.append((path, kind, text))

    walk(message_from_string(raw), "")
    return out


def test_mime_parts_equal_the_standard_library(spark):
    df = spark.createDataFrame(list(enumerate(MIME)) + [(99, None)], "i int, raw string")
    parts = S.mail_parts(df, "i")
    assert "Python" not in plan_of(parts)
    got = {}
    for r in parts.collect():
        got.setdefault(r.i, []).append((r.path, r.type, r.text))
    assert 99 not in got
    for i, raw in enumerate(MIME):
        assert got[i] == stdlib_leaves(raw), i
    shallow = S.mail_parts(df.where("i = 3"), "i", max_depth=1).collect()
    assert [(r.path, r.type) for r in shallow] == [("1", "multipart/alternative"), ("2", "text/plain")]


def test_decoded_multipart_bodies_are_native(spark):
    df = spark.createDataFrame([(0, MIME[3])], "i int, raw string")
    out = S.parse_mails(df, decode_multipart=True)
    assert "Python" not in plan_of(out)
    assert out.first().body == " ".join(t for _, _, t in stdlib_leaves(MIME[3])).replace("\n", " ")


def test_header_of_many_files_is_one_aggregate(spark, tmp_dir):
    import os

    for i in range(30):
        with open(os.path.join(tmp_dir, f"part-{i:02d}.txt"), "w") as fh:
            fh.write("" if i < 25 else f"head{i}\nline\n")
    assert [r[0] for r in S.first_line(spark, tmp_dir).collect()] == ["head25"]
    assert S.first_line(spark, tmp_dir).inputFiles() is not None
    empty = os.path.join(tmp_dir, "none")
    os.makedirs(empty)
    open(os.path.join(empty, "a.txt"), "w").close()
    assert S.first_line(spark, empty).collect() == []


def test_rounds_write_every_row_once_and_a_bucket_in_one_file(spark, tmp_dir):
    import glob

    rows = spark.createDataFrame([(i % 90 if i % 7 else None, f"t{i}") for i in range(400)], "k long, t string")
    path, seen = f"{tmp_dir}/rounds", []

    def part(turn):
        seen.append(rows.where(turn(F.col("k"))).withColumnRenamed("k", "msg_id"))
        return seen[-1]
    ST.write_bucketed_rounds(spark, part, path, "msg_id", 8, 3)
    got = ST.read_bucketed(spark, path, "msg_id long, t string", "msg_id", 8)
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, rows.collect()), key=key)
    assert len(seen) == 3 and sum(s.count() for s in seen) == 400 and all(s.count() for s in seen)
    files = glob.glob(f"{path}/*.parquet")
    assert len(files) == 8 and all(f.endswith(".zstd.parquet") for f in files)
    other = f"{tmp_dir}/other"
    ST.write_bucketed(rows.withColumnRenamed("k", "msg_id"), other, "msg_id", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = got.join(ST.read_bucketed(spark, other, "msg_id long, t string", "msg_id", 8), "msg_id")
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == rows.join(rows.select("k"), "k").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_layout_of_the_mail_store():
    from maillens.plans import mail_queries as Q

    assert Q.store_layout(0) == Q.store_layout(150_000) == (Q.BUCKETS, 1)
    for mails in (900_000, 9_000_000, 54_000_000):
        buckets, rounds = Q.store_layout(mails)
        assert rounds <= Q.ROUNDS and buckets >= Q.BUCKETS * rounds and buckets * Q.BUCKET_MAILS >= mails


def test_mails_are_compacted_without_a_tree_of_all(spark, tmp_dir, monkeypatch):
    import os

    from maillens.plans import mail_queries as Q
    from maillens.session import scratch_dir
    from tests.test_mail import mail_tables

    def files():
        return sum(len(f) for _, _, f in os.walk(scratch_dir(spark).removeprefix("file:")))

    monkeypatch.setattr(Q, "ROUND_MAILS", 150, raising=False)
    sf_dir, before = mail_tables(spark, tmp_dir), files()
    got = sorted(map(tuple, Q.q_compacted_mails(spark, sf_dir).collect()))
    assert files() - before < 100                    # of 300 mails
    assert got == sorted(map(tuple, Q.q_mail_scan(spark, sf_dir).collect())) and len(got) == 300
