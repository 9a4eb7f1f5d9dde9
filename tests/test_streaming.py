"""Incremental extraction: each mail file is appended exactly once."""

import os
import tempfile

from maillens.streaming.extraction import extract_incrementally


def _mail(d, name, sender, to):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(f"From: {sender}\nTo: {to}\n\nbody of {name}\n")


def test_restart_without_a_named_checkpoint(spark):
    src = tempfile.mkdtemp(prefix="mails-")
    out = tempfile.mkdtemp(prefix="msgs-") + "/t"
    _mail(os.path.join(src, "a"), "1.", "a@x", "b@x")
    extract_incrementally(spark, src, out).awaitTermination()
    _mail(os.path.join(src, "b"), "1.", "b@x", "a@x")
    extract_incrementally(spark, src, out).awaitTermination()
    assert sorted(r.sender for r in spark.read.parquet(out).collect()) == ["a@x", "b@x"]


def test_incremental_extraction(spark):
    src = tempfile.mkdtemp(prefix="mails-")
    out = tempfile.mkdtemp(prefix="msgs-") + "/t"
    ck = tempfile.mkdtemp(prefix="ck-")
    _mail(os.path.join(src, "a", "inbox"), "1.", "a@x", "b@x")
    _mail(os.path.join(src, "b", "sent"), "1.", "b@x", "a@x, c@x")
    extract_incrementally(spark, src, out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    _mail(os.path.join(src, "c", "deep", "er"), "7.", "c@x", "a@x")
    extract_incrementally(spark, src, out, ck).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 3
    assert sorted(r.to_list for r in rows) == ["a@x", "a@x,c@x", "b@x"]
