"""Mail parsing vs the standard library parser; scans and sinks."""

import os
from email.parser import Parser

import pytest

from maillens.sources import mail as S

CASES = [
    "From: a@x\nTo: b@x, c@x\nSubject: s\n\nhello\nworld\n",
    "From: a@x\nTo: b@x,\n\tc@x,\n d@x\nSubject: folded\n\nbody",
    "From: a@x\nSubject: no to\n\nbody",
    "From: a@x\nTo:\nSubject: empty to\n\nbody",
    "From: a@x\nTo: first@x\nTo: second@x\n\nrepeated",
    "From: a@x\nX-To: wrong@x\nTo: right@x\n\nx-to first",
    "From: a@x\nSubject: s\n\nTo: body@x\nnot a header",
    "FROM: A@X\nTO: B@X\n\nupper case",
    "From: a@x\nTo: b@x",
    "From: a@x\r\nTo: b@x\r\n\r\ncrlf body\r\nline",
    "From: a@x\nTo: b@x, b@x\n\ntwice",
    "From: a@x\nTo: b@x\n\n*star*in*body*",
    "From: a@x\nno header here\nTo: b@x\n\nbody",
    "From: a@x\nTo: b@x\n \nno colon here\n\nbody",
    "From: a@x\nTo: b@x\nno colon",
    "From: a@x\nTo: b@x\nContent-Type: multipart/mixed\n\nno boundary",
]


def reference_fields(raw: str):
    msg = Parser().parsestr(raw)
    to = msg["to"]
    to = to.replace("\n", "").replace("\t", "").replace(" ", "") if to else ""
    return msg["from"], to, msg.get_payload().replace("\n", " ")


def test_parse_matches_stdlib(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "id int, raw string")
    got = {r.id: (r.sender, r.to_list, r.body, r.parse_ok)
           for r in S.parse_mails(df).collect()}
    for i, raw in enumerate(CASES):
        sender, to, body = reference_fields(raw.replace("\r\n", "\n"))
        assert got[i][:3] == (sender, to, body), (i, raw)
        assert got[i][3] is True


def test_missing_sender_and_multipart_are_flagged(spark):
    multi = ("From: a@x\nTo: b@x\nContent-Type: multipart/alternative; boundary=XX\n\n"
             "--XX\nContent-Type: text/plain\n\nplain part\n--XX--\n")
    folded = multi.replace("Content-Type: multipart", "Content-Type:\n\tmultipart", 1)
    blank_first = "\nFrom: a@x\nTo: b@x\n\nbody"
    rows = [(0, "To: b@x\n\nno sender"), (1, multi), (2, folded), (3, blank_first)]
    df = spark.createDataFrame(rows, "id int, raw string")
    got = {r.id: r for r in S.parse_mails(df).collect()}
    assert got[0].sender is None and got[0].parse_ok is False
    assert got[1].parse_ok is False and got[2].parse_ok is False
    assert got[3].sender is None and got[3].to_list == "" and got[3].parse_ok is False
    assert got[3].body == "From: a@x To: b@x  body"
    dec = {r.id: r for r in S.parse_mails(df, decode_multipart=True).collect()}
    assert dec[1].body.strip() == "plain part"


def test_mail_tree_scan(spark, tmp_dir):
    for i, raw in enumerate(CASES[:4]):
        d = os.path.join(tmp_dir, "user%d" % (i % 2), "inbox", "sub")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "%d." % i), "w") as f:
            f.write(raw)
    df = S.parse_mails(S.read_mail_tree(spark, tmp_dir))
    assert df.count() == 4
    assert {r.sender for r in df.collect()} == {"a@x"}


def test_message_lines_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame(list(enumerate(CASES)), "id int, raw string")
    parsed = S.parse_mails(df)
    path = os.path.join(tmp_dir, "lines")
    S.write_messages(parsed, path, mode="overwrite")
    S.write_messages(parsed, path, mode="append")
    back = S.read_messages(spark, path)
    assert back.count() == 2 * len(CASES)
    want = sorted((r.sender, r.to_list, r.body) for r in parsed.collect()) * 2
    assert sorted((r.sender, r.to_list, r.body) for r in back.collect()) == sorted(want)


def test_drop_header_drops_every_equal_line(spark, tmp_dir):
    path = os.path.join(tmp_dir, "one.txt")
    with open(path, "w") as f:
        f.write("h*h*h\na*b*c\nh*h*h\nd*e*f\n")
    got = [r.sender for r in S.read_messages(spark, path, header=True).collect()]
    assert sorted(got) == ["a", "d"]


def test_header_of_the_first_file_goes_and_no_other_line(spark, tmp_dir):
    path = os.path.join(tmp_dir, "many")
    os.makedirs(path)
    open(os.path.join(path, "a-empty.txt"), "w").close()
    lines = ["HDR*t*b"] + [f"s{i}*t*b{i}" for i in range(1000)]
    for k in range(4):   # four files in name order, the header leads the first
        with open(os.path.join(path, f"p{k}.txt"), "w") as f:
            f.write("\n".join(lines[k * 251:(k + 1) * 251]) + "\n")
    got = [r.sender for r in S.read_messages(spark, path, header=True).collect()]
    assert sorted(got) == sorted(f"s{i}" for i in range(1000))


def test_short_line_fields_are_null_not_errors(spark):
    df = spark.createDataFrame([("only",), ("a*b",), ("a*b*c*d",)], "value string")
    rows = S.split_message_lines(df).collect()
    assert [(r.sender, r.to_list, r.body) for r in rows] == [
        ("only", None, ""), ("a", "b", ""), ("a", "b", "c*d")]


def test_insider_csv_by_position(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ins.csv")
    header = ",".join(["who", "mail"] + [f"c{i}" for i in range(2, 16)] + ["flag"])
    row = ",".join(["Name 1", "u1@x.com"] + ["1.5"] * 14 + ["True"])
    with open(path, "w") as f:
        f.write(header + "\n" + row + "\n")
    r = S.read_insiders(spark, path).first()
    assert r.email == "u1@x.com" and r.poi is True and r.f02 == 1.5


@pytest.mark.parametrize("nested", [False, True])
def test_write_result(spark, tmp_dir, nested):
    df = spark.createDataFrame([(1, [1.0])] if nested else [(1, 1.0)],
                               "a int, b array<double>" if nested else "a int, b double")
    path = os.path.join(tmp_dir, "out")
    S.write_result(df, path)
    fmt = "json" if nested else "csv"
    assert any(f.endswith(fmt) for f in os.listdir(path))


def test_one_file_per_mail_and_each_expression_once(spark, tmp_dir):
    """The tree has a file per mail, equal mails too, and no process is started
    per file; a mail's header and newlines are worked out once."""
    path = os.path.join(tmp_dir, "tree")
    mails = [("a/b", "From: a@x\n\none"), ("a/b", "From: a@x\n\none"), ("c", "From: b@x\n\n\u00e9 two"), (None, None)]
    S.write_mail_tree(spark.createDataFrame(mails, "box string, raw string"), path, partitions=2)
    back = S.read_mail_tree(spark, path).collect()
    assert sorted(r.raw for r in back) == sorted((raw or "") + "\n" for _, raw in mails)
    assert sorted(d for d in os.listdir(path) if d[0] != "_" and d[0] != ".") == [
        "box=__HIVE_DEFAULT_PARTITION__", "box=a%2Fb", "box=c"]
    assert not any(f.endswith(".crc") for _, _, files in os.walk(os.path.join(path, "box=c")) for f in files)
    plan = S.parse_mails(spark.createDataFrame([("x",)], "raw string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(S.M.HEADER_LINES) == 1 and "translate(" not in plan


def test_compressed_lines_are_the_same_lines(spark, tmp_dir):
    parsed = S.parse_mails(spark.createDataFrame(list(enumerate(CASES)), "id int, raw string"))
    rows = []
    for name, codec in (("plain", None), ("packed", "lz4")):
        path = os.path.join(tmp_dir, name)
        S.write_messages(parsed, path, mode="overwrite", compression=codec)
        rows.append(sorted(tuple(r) for r in S.read_messages(spark, path).collect()))
        assert any(f.endswith(".lz4") for f in os.listdir(path)) == (codec == "lz4")
    assert rows[0] == rows[1]


def test_fields_around_their_separators(spark):
    lines = ["", "*", "a**", "*b*", "**c", "a*b", "\u00e9*\u00fc*x*y*", None]
    rows = S.split_message_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    want = [tuple((x.split("*", 2) + [None, None])[:3]) if x is not None else (None,) * 3 for x in lines]
    assert [tuple(r) for r in rows] == [(a, b, c or "") for a, b, c in want]


def test_a_tree_in_slices_gives_the_same_files(spark, tmp_dir, monkeypatch):
    """Never more files than a slice holds, and none at the end."""
    import tempfile

    import pyarrow as pa

    mails = [("a/b" if i % 3 else f"c{i % 7}", f"From: a{i}@x\n\n" + "\u00e9 text\r\n" * (i % 5)) for i in range(200)]
    mails += [(None, None), ("", "x"), ("a/b", mails[1][1])]
    rows = S.tree_rows(spark.createDataFrame(mails, "box string, raw string").repartition(3))
    path = os.path.join(tmp_dir, "tree")
    S.write_mail_tree(rows, path, raw_col="value")
    got = S.read_mail_tree(spark, rows)
    assert got.columns == ["path", "raw"]
    assert sorted(r.raw for r in got.collect()) == sorted(r.raw for r in S.read_mail_tree(spark, path).collect())

    monkeypatch.setattr(S, "SLICE_FILES", 16)
    monkeypatch.setattr(S, "SLICE_BYTES", 400)
    monkeypatch.setattr(S, "READ_BYTES", 100)
    monkeypatch.setattr(tempfile, "tempdir", tmp_dir)
    batches = [pa.RecordBatch.from_arrays([pa.array([b for b, _ in part], pa.string()),
                                           pa.array([t.encode() if t is not None else None for _, t in part], pa.binary())],
                                          names=["box", "value"]) for part in (mails[:90], [], mails[90:])]
    assert all(b.num_rows == 1 or sum(len(t) for t in b.column(1).to_pylist() if t) <= 400 for b in S._slices(batches))
    back, there = [], 0
    for batch in S._slices_there_and_back(batches):
        back += batch.column(1).to_pylist()
        trees = [d for d in os.listdir(tmp_dir) if d.startswith("mailtree-")]
        there = max(there, sum(len(f) for d in trees for _, _, f in os.walk(os.path.join(tmp_dir, d))))
    assert sorted(back) == sorted((t or "").encode() + b"\n" for _, t in mails)
    assert 1 < there <= 16 and not [d for d in os.listdir(tmp_dir) if d.startswith("mailtree-")]


def mail_tables(spark, folder, mails=300):
    """orders, lineitem and documents of their own, as the mail queries read them."""
    ids = spark.range(mails)
    for name, df in (("orders", ids.selectExpr("id o_orderkey", "id % 9 o_custkey")),
                     ("lineitem", spark.range(3 * mails).selectExpr(f"id % {mails - 5} l_orderkey", "id % 11 l_suppkey")),
                     ("documents", spark.range(40).selectExpr("id doc_id", "concat('line ', id, '\\nend') text"))):
        df.write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


def test_no_tree_of_all_mails_lies_on_disk(spark, tmp_dir):
    from maillens.plans import mail_queries as Q
    from maillens.session import scratch_dir

    def files():
        return sum(len(f) for _, _, f in os.walk(scratch_dir(spark).removeprefix("file:")))

    sf_dir, before = mail_tables(spark, tmp_dir), files()
    got = Q.q_mail_scan(spark, sf_dir).orderBy("msg_id").collect()
    assert files() - before < 100                    # of 300 mails
    want = [tuple(r) for r in Q.parsed_mails(spark, sf_dir).orderBy("msg_id").collect()]
    assert [(m, s, t, b.removesuffix(" "), ok) for m, s, t, b, ok in got] == [
        (m, s, t, b.removesuffix(" "), ok) for m, s, t, b, ok in want] and len(got) == 300
