"""Token alignment, hard negatives and token counts against brute force."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from maillens.llm import crosstok, hardneg, tokencount
from maillens.llm import queries as Q

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string"
LONG = " ".join(f"long{i} words" for i in range(8000))


def odd_texts():
    rnd = random.Random(2)
    return [None, "", " ", "▁x", "<s> </s><|endoftext|> a<|startoftext|>", "a\0b", "é漢字 ﬁ\r\n\n", "  lead", "ab" * 3000,
            "same text", "same text", LONG, "İΣς 'LL it's 1٢½", "a\x85b c\x1cd"] + [
        "".join(rnd.choice("abcdeé漢st①.  \n9-'<|>") for _ in range(70)) for _ in range(60)]


def odd(spark):
    return spark.createDataFrame([(i, t, "en") for i, t in enumerate(odd_texts())], DOC)


# ------------------------------------------------------------------ 11


def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(crosstok.A_PATH)
    a.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=crosstok.B_PATH)
    (_, va), (_, vb) = crosstok.load_a(crosstok.A_PATH), crosstok.load_b(crosstok.B_PATH)

    def spans(ids, voc):
        out, at = [], 0
        for i in ids:
            out.append((at, at + int(voc.size[i]), i))
            at = out[-1][1]
        return out

    rows, count = [], collections.Counter()
    for t in texts:
        ia, ib = (a.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)) if t else ([], [])
        if not t or {bytes(va.joined(ia)), bytes(vb.joined(ib))} != {(" " + t).encode()}:
            ia, ib = [], []
        sa, sb = spans(ia, va), spans(ib, vb)
        links, j = [], 0
        for lo, hi, i in sa:
            while j < len(sb) and sb[j][1] <= lo:
                j += 1
            k = j
            while k < len(sb) and sb[k][0] < hi:
                links.append((i, sb[k][2]))
                k += 1
        cuts = sorted({x[1] for x in sa} & {x[1] for x in sb})
        parts, x, y = [], 0, 0
        for c in cuts:
            ga, gb = [], []
            while x < len(sa) and sa[x][1] <= c:
                ga.append(str(sa[x][2]))
                x += 1
            while y < len(sb) and sb[y][1] <= c:
                gb.append(str(sb[y][2]))
                y += 1
            parts.append(",".join(ga) + "|" + ",".join(gb))
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        rows.append((len(ia), len(ib), len(cuts), links, digest))
        count.update(links)
    best = collections.Counter()
    for (_, i), n in count.items():
        best[i] = max(best[i], n)
    return [(na, nb, ng, len(ls), sum(count[p] == best[p[1]] for p in ls), sum(count[p] for p in ls), d)
            for na, nb, ng, ls, d in rows]


ALIGNED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(crosstok, "FAN", 2)
    monkeypatch.setattr(crosstok, "GROUP", 500)
    docs = odd(spark).withColumn("n_best", F.lit("clash")).repartition(7)
    got = {r.doc_id: tuple(r[c] for c in ALIGNED) for r in crosstok.align(docs).collect()}
    want = brute_alignment(odd_texts())
    assert [got[i] for i in range(len(want))] == want
    assert set(crosstok.align(docs).columns) == {"doc_id", "lang", *ALIGNED}


def test_alignment_query_on_a_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r[c] for c in ALIGNED) for r in Q.op11_spill_alignment(spark, SF).collect()}
    ids = sorted(texts)
    assert [got[i] for i in ids] == brute_alignment([texts[i] for i in ids])


def test_alignment_of_empty_tables_and_empty_texts(spark):
    assert crosstok.align(spark.createDataFrame([], DOC)).collect() == []
    rows = crosstok.align(spark.createDataFrame([(1, None, "x"), (1, "", "y"), (None, "a", "z")], DOC)).collect()
    assert sorted((r.lang, r.n_a, r.n_links, r.groups_sha256 == "") for r in rows) == [
        ("x", 0, 0, True), ("y", 0, 0, True), ("z", 1, 1, False)]


def test_runs_and_heads_merge_to_exact_counts(monkeypatch):
    """Several small run sets, frames of a few pairs, merged in any number."""
    monkeypatch.setattr(crosstok, "FRAME", 3)
    load = crosstok.load_a(crosstok.A_PATH), crosstok.load_b(crosstok.B_PATH)
    texts = [t for t in odd_texts()[:40] if t and len(t) < 100]
    heads, want = collections.defaultdict(list), collections.Counter()
    for a in range(0, len(texts), 7):
        block = crosstok.Block(texts[a:a + 7], load)
        x, y, _ = block.links()
        want.update(zip(y.tolist(), x.tolist(), strict=True))
        runs = crosstok.RunSet()
        runs.add(block)
        for radix, links, frames, body in runs.spill():
            docs_of, place, times = crosstok.unpack(body)
            assert links == times.sum() and docs_of.sum() == len(place)
            heads[radix].append(frames)
    got, top = {}, {}
    for radix, runs in heads.items():
        for key, count, best in crosstok.with_best(crosstok.merged(runs)):
            pairs = [(int(k) >> 17, int(k) & (1 << 17) - 1) for k in key]
            assert pairs == sorted(pairs) and all(crosstok.radix_of(np.array([b]))[0] == radix for b, _ in pairs)
            got.update(zip(pairs, count.tolist(), strict=True))
            top.update(zip(pairs, best.tolist(), strict=True))
    assert got == want
    for b in {b for b, _ in got}:
        high = max(n for (x, _), n in got.items() if x == b)
        assert all(top[p] == (n == high) for p, n in got.items() if p[0] == b)


def test_a_small_run_limit_changes_nothing(monkeypatch):
    """One task that spills after every block gives the same documents."""
    monkeypatch.setattr(crosstok, "RECORDS", 50)
    monkeypatch.setattr(crosstok, "text_blocks", lambda col: (
        (i, i + 1, None, None) for i in range(len(col))))
    texts = [t for t in odd_texts() if t is None or len(t) < 200]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    out = pa.Table.from_batches(crosstok._align(crosstok.A_PATH, crosstok.B_PATH, 1, [0], iter([batch]))).to_pylist()
    docs = [r for r in out if r["__radix"] is None]
    assert [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) for r in docs] == [w[:4] for w in brute_alignment(texts)]
    sets = {r["__set"] for r in out if r["__radix"] is not None}
    assert len(sets) > 5 and sum(r["__links"] for r in out if r["__radix"] is not None) == sum(
        r["n_links"] for r in docs)


# ------------------------------------------------------------------ 12


def brute_negatives(rows, anchors, k=5, m=3, low=50, high=95):
    """``rows`` are (vec_id, label, vector); Python integers."""
    out = []
    wide = max((len(v) for _, _, v in rows), default=0)
    pad = [(i, lab, [*v, *[0] * (wide - len(v))]) for i, lab, v in rows]
    for i, lab, v in pad:
        if not anchors(i):
            continue
        scored = [(max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(v, w, strict=True)))), j, other == lab)
                  for j, other, w in pad if j != i]
        scored.sort(key=lambda t: (-t[0], t[1]))
        for ps, p, _ in [t for t in scored if t[2]][:k]:
            fits = [(s, j) for s, j, same in scored if not same and low * ps <= 100 * s <= high * ps][:m]
            out += [(i, p, r + 1, j, ps, s) for r, (s, j) in enumerate(fits)]
    return sorted(out)


MINED = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(df, anchor):
    return sorted(tuple(r[c] for c in MINED) for r in hardneg.mine(df, anchor).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(hardneg, "BLOCK", 300)
    monkeypatch.setattr(hardneg, "WAVE", 9)
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(8, 16))
    rows = []
    for i in range(700):
        v = centres[rnd.integers(8)] * 60 + rnd.normal(size=16) * (25 if seed == 1 else 4)
        rows.append((i, int(rnd.integers(4)), [int(x) for x in np.floor(v)]))
    rows += [(1000 + i, 1, rows[50][2]) for i in range(90)]                 # copies of an anchor: ties
    rows += [(2000, 2, [0] * 16), (2010, 2, [5, 3]), (2020, 2, []), (2020, 3, [5, 3])]   # zero, short, repeated id
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>").repartition(3)
    assert mined(df, F.expr("vec_id % 10 = 0")) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_hard_negatives_with_sums_beyond_floating_point(spark):
    rnd = random.Random(4)
    rows = [(i, i % 2, [rnd.randrange(-2 ** 40, 2 ** 40) for _ in range(3)]) for i in range(60)]
    rows += [(60, 0, [2 ** 62, 1, 1]), (61, 1, [2 ** 62, 0, 1]), (62, 0, [2 ** 62, 2, 1]), (63, 1, [3, 0, 0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>")
    assert mined(df, F.expr("vec_id % 6 = 0")) == brute_negatives(rows, lambda i: i % 6 == 0)


def test_strip_bounds_hold():
    rnd = np.random.default_rng(7)
    x = [[int(v) for v in row] for row in rnd.normal(size=(500, 8)) * 100]
    x[3] = [0] * 8
    refs = hardneg._units(rnd.normal(size=(5, 8)))[0]
    rows = hardneg.Rows.of(list(range(500)), [0] * 500, x, refs)
    low, high = hardneg.Strips(rows).bounds(rows)
    got = hardneg.scores(rows.x, rows.x)
    strip = np.arange(500) // hardneg.STRIP
    assert (got >= low[:, strip]).all() and (got <= high[:, strip]).all()
    again = hardneg.Rows.unpack(rows.pack())
    assert (again.x == rows.x).all() and (again.angle == rows.angle).all() and (again.ids == rows.ids).all()


def test_hard_negatives_leave_out_odd_rows(spark):
    rows = [(0, 1, [3, 1]), (None, 1, [9, 9]), (2, None, [9, 9]), (3, 1, None), (4, 1, [None, 2]), (5, 1, [4, 0]),
            (6, 2, [2, 1]), (7, 2, [3, 0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>").withColumn("rank", F.lit("clash"))
    clean = [r for r in rows if None not in r and r[0] != 4]
    assert mined(df, F.expr("vec_id % 5 = 0")) == brute_negatives(clean, lambda i: i % 5 == 0) != []
    assert mined(df.where("vec_id < 0"), F.lit(True)) == []


def test_hard_negatives_query_reads_odd_components(spark, tmp_dir):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 3, [0.5, 0.25]), (50, 0, [0.5, 0.3]), (1, 4, [0.4, 0.2]), (2, 4, [nan, 0.2]), (3, 4, [inf, 0.2]),
            (4, 4, [0.4, None]), (5, None, [0.4, 0.2]), (6, 4, None), (8, 0, [-0.001, 0.9]), (9, 0, [0.3, 0.3]),
            (14, 2 ** 31 - 1, [0.3, 0.2])]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(
        f"{tmp_dir}/embeddings.parquet")
    got = sorted(tuple(r[c] for c in MINED) for r in Q.op12_angular_negatives(spark, tmp_dir).collect())
    floor = lambda x: int(np.floor(256 * float(np.float32(x))))
    clean = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [floor(x) for x in v]) for i, lab, v in rows
             if i not in (2, 3, 4, 5, 6)]
    assert got == brute_negatives(clean, lambda i: i % 50 == 0) != []


# ------------------------------------------------------------------ 13


def library_counts(texts, path=tokencount.MODEL):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    return [len(e.ids) for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_counts_are_the_library_s(spark):
    texts = odd_texts() + ["x" * 9000, "the" * 3000, "<|endoftext|><|EndOfText|> <|startoftext|>"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOC).withColumn("n_tokens", F.lit("clash"))
    got = sorted(map(tuple, tokencount.token_counts(df).drop("text", "lang").collect()))
    want = library_counts(texts)
    assert got == [(i, len((t or "").encode()), n, n > 2048)
                   for i, (t, n) in enumerate(zip(texts, want, strict=True))]
    assert any(r[3] for r in got)
    assert tokencount.token_counts(spark.createDataFrame([], DOC)).collect() == []


def test_token_counts_of_every_character():
    texts = [f"a{chr(x)}b {chr(x)}{chr(x)}'s1{chr(x)}" for x in range(0x20000) if not 0xD800 <= x < 0xE000]
    got = tokencount.Counter(tokencount.MODEL).count([t.encode() for t in texts])
    assert got.tolist() == library_counts(texts)


def test_rounds_equal_the_agenda():
    merges = tokencount.Merges(tokencount.MODEL)
    rnd = random.Random(6)
    words = ["".join(rnd.choice("aabcdeilnorst") for _ in range(rnd.randrange(1, 60))) for _ in range(800)]
    words += ["a" * n for n in range(1, 40)] + ["the" * 50]
    sym, size = merges.symbols(words)
    at = np.cumsum(size) - size
    assert merges.count(words).tolist() == [
        merges.agenda(sym[a:a + n].tolist()) for a, n in zip(at, size, strict=True)]


def test_token_counts_query_on_a_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in Q.op13_rank_rounds(spark, SF).collect()}
    want = library_counts([docs[i] for i in sorted(docs)])
    assert [got[i] for i in sorted(docs)] == [
        (len((docs[i] or "").encode()), n, n > 2048) for i, n in zip(sorted(docs), want, strict=True)]
