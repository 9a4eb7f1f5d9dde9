"""Mail traffic counts vs a plain Python brute force on edge cases."""

from collections import Counter

from maillens.operators import traffic as T

MSGS = [
    (1, "a@x", "b@x,c@x"),
    (2, "a@x", "b@x,b@x"),        # recipient listed twice counts twice
    (3, "b@x", ""),               # empty list: one empty recipient
    (4, "c@x", "a@x,p@x"),
    (5, "p@x", "a@x,b@x,zz@y"),   # POI sender; non-person recipient
    (6, "q@x", None),             # null list
    (7, "p@x", "p@x"),
    (8, "stranger@y", "a@x"),
]
PEOPLE = [("a@x", False), ("b@x", False), ("c@x", False), ("p@x", True),
          ("q@x", True), ("lonely@x", False)]   # lonely: no mail at all


def brute():
    people = {e for e, _ in PEOPLE}
    poi = {e for e, p in PEOPLE if p}
    sent, recv, from_poi, to_poi = Counter(), Counter(), Counter(), Counter()
    for _, s, to in MSGS:
        rec = to.split(",") if to is not None else []
        if s in people:
            sent[s] += 1
            to_poi[s] += sum(1 for r in rec if r in poi)
        for r in rec:
            if r in people:
                recv[r] += 1
                if s in poi:
                    from_poi[r] += 1
    return {e: (sent[e], recv[e], from_poi[e], to_poi[e]) for e in people}


def frames(spark):
    m = spark.createDataFrame(MSGS, "msg_id long, sender string, to_list string")
    p = spark.createDataFrame(PEOPLE, "email string, poi boolean")
    return m, p


def test_insider_features_left(spark):
    m, p = frames(spark)
    got = {r.email: (r.n_sent, r.n_received, r.n_from_poi, r.n_to_poi)
           for r in T.insider_features(m, p).collect()}
    assert got == brute()


def test_separate_operators_agree(spark):
    m, p = frames(spark)
    want = brute()
    sent = {r.email: r.n_sent for r in T.mails_sent(m, p).collect()}
    assert sent == {e: v[0] for e, v in want.items() if v[0] > 0}
    recv = {r.email: r.n_received for r in T.mails_received(m, p).collect()}
    assert recv == {e: v[1] for e, v in want.items() if v[1] > 0}
    frm = {r.email: r.n_from_poi for r in T.received_from_poi(m, p).collect()}
    assert frm == {e: v[2] for e, v in want.items() if v[2] > 0}
    top = {r.email: r.n_to_poi for r in T.sent_to_poi(m, p).collect()}
    assert top == {e: v[3] for e, v in want.items() if v[0] > 0}


def test_inner_variant_keeps_complete_rows(spark):
    m, p = frames(spark)
    got = {r.email for r in T.insider_features(m, p, how="inner").collect()}
    want = {e for e, v in brute().items() if v[0] > 0 and v[1] > 0 and v[2] > 0}
    assert got == want


def test_mails_to_poi_counts_mails(spark):
    m, p = frames(spark)
    got = {r.email: r.n_mails_to_poi for r in T.mails_to_poi(m, p).collect()}
    assert got["c@x"] == 1 and got["a@x"] == 0 and got["p@x"] == 1


def test_properties(spark):
    m, p = frames(spark)
    rows = T.traffic_counts(m, p.union(spark.createDataFrame(
        [("zz@y", False), ("stranger@y", False), ("", False)], "email string, poi boolean")))
    total_recv = sum(r.n_received for r in rows.collect())
    assert total_recv == sum(len(t.split(",")) for _, _, t in MSGS if t is not None)
    for r in T.insider_features(m, p).collect():
        assert r.n_from_poi <= r.n_received


def test_no_poi_gives_zero_poi_counts(spark):
    m, _ = frames(spark)
    p = spark.createDataFrame([(e, False) for e, _ in PEOPLE], "email string, poi boolean")
    for r in T.insider_features(m, p).collect():
        assert r.n_from_poi == 0 and r.n_to_poi == 0


def test_flagship_plan_is_broadcast_and_native(spark):
    m, p = frames(spark)
    plan = T.insider_features(m, p)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_long_form_equals_list_form(spark):
    m, p = frames(spark)
    senders = m.select("msg_id", "sender")
    rows = [(i, s, r) for i, s, t in MSGS if t is not None for r in t.split(",")]
    recips = spark.createDataFrame(rows, "msg_id long, sender string, recipient string")
    a = sorted(T.insider_features_long(senders, recips, p).collect())
    b = sorted(T.insider_features(m, p).collect())
    assert a == b


def test_large_person_table_path_with_a_hot_address(spark):
    """No broadcast: one sender and one recipient take part in a third of all mail."""
    msgs = [(i, "a@x" if i % 3 == 0 else f"s{i % 40}@x", "hot@x,p@x" if i % 3 == 0 else f"r{i % 25}@x,hot@x")
            for i in range(900)]
    m = spark.createDataFrame(msgs, "msg_id long, sender string, to_list string")
    people = [("a@x", False), ("hot@x", False), ("p@x", True), ("s1@x", True)] + [
        (f"r{i}@x", False) for i in range(25)]
    p = spark.createDataFrame(people, "email string, poi boolean")
    for run in (T.traffic_counts, T.mails_sent, T.mails_received, T.sent_to_poi, T.mails_to_poi,
                T.received_from_poi):
        big, small = run(m, p, small=False), run(m, p, small=True)
        assert sorted(big.collect()) == sorted(small.collect()), run.__name__
    plan = T.traffic_counts(m, p, small=False)._jdf.queryExecution().optimizedPlan().toString()
    # mails are aggregated to pairs below every join
    assert plan.index("Join") < plan.rindex("Aggregate [sender") and "broadcast" not in plan


def test_aggregated_counts_run_once_without_a_broadcast(spark, monkeypatch):
    """Rows that are one per key need no search for hot keys, which runs the plan once more."""
    from maillens.operators import joins as J

    def never(*args, **kw):
        raise AssertionError("an extra run")
    monkeypatch.setattr(J, "hot_keys", never)
    m, p = frames(spark)
    want = brute()
    got = {r.email: tuple(r)[1:] for r in T.traffic_counts(m, p, small=False).collect()}
    assert got == {e: c for e, c in want.items() if any(c)}
    assert {r.email: r.n_to_poi for r in T.sent_to_poi(m, p, small=False).collect()} == {
        e: c[3] for e, c in want.items() if c[0]}
    assert {r.email: r.n_from_poi for r in T.received_from_poi(m, p, small=False).collect()} == {
        e: c[2] for e, c in want.items() if c[2]}
    assert {r.email: r.n_received for r in T.mails_received(m, p, small=False).collect()} == {
        e: c[1] for e, c in want.items() if c[1]}
