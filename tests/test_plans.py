"""Plan checks: native paths stay in the JVM; filters reach the scan."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from maillens.functions.text import clean_text
from maillens.sources import mail as S

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_and_clean_are_native(spark):
    df = spark.createDataFrame([(1, "From: a\nTo: b\n\nx y z")], "id int, raw string")
    plan = plan_of(S.parse_mails(df).select("sender", clean_text(F.col("body")).alias("w")))
    assert "Python" not in plan


def test_raw_mails_use_every_document(spark):
    from maillens.sources import fixtures as fx
    raw = fx.raw_mails(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = raw.where(F.col("msg_id") % fx.FORM_KEYS != fx.CRLF_KEY)
    used = plain.join(docs, F.col("msg_id") % F.lit(docs.count()) == F.col("doc_id"))
    assert used.where(~F.col("raw").endswith(F.col("text"))).count() == 0
    assert used.select("doc_id").distinct().count() == docs.count()


def test_rows_to_table_from_dicts(spark):
    df = S.rows_to_table(spark, [{"email": "a@x", "n": 1}, Row(email="b@x", n=2)],
                         "email string, n long")
    assert sorted((r.email, r.n) for r in df.collect()) == [("a@x", 1), ("b@x", 2)]


def test_scan_reads_only_needed_columns(spark):
    from maillens.sources import fixtures as fx
    plan = plan_of(fx.message_recipients(spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in plan
