"""Delivery, batching, snapshot and gate rules on small fixtures, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.ordered import asof_backward, fill_forward, number_rows, running_total
from ledgerline.operators import assemble, capture, checks, delivery, snapshot


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_ordered_helpers(spark, span):
    rng = random.Random(span)
    rows = [(k, at, rng.choice([None, rng.randrange(9)])) for k in "ab" for at in sorted(rng.sample(range(-50, 300), 40))]
    df = spark.createDataFrame(rows, "k string, at bigint, v bigint")
    numbered = {(r.k, r.at): r.n for r in number_rows(df, ["k"], "at", "n", span).collect()}
    totals = {(r.k, r.at): r.t for r in running_total(df, ["k"], "at", F.coalesce("v", F.lit(0)), "t", span).collect()}
    filled = {(r.k, r.at): r.f for r in fill_forward(df, ["k"], "at", "v", "f", span).collect()}
    for k in "ab":
        mine = [r for r in rows if r[0] == k]
        total, last = 0, None
        for i, (_, at, v) in enumerate(mine, 1):
            total, last = total + (v or 0), last if v is None else v
            assert (numbered[k, at], totals[k, at], filled[k, at]) == (i, total, last)
    # Without a span given, it is told from the rows: sparse keys and microseconds alike.
    wide = df.withColumn("at", F.col("at") * 1_000_000_007)
    assert {(r.k, r.at // 1_000_000_007): r.n for r in number_rows(wide, ["k"], "at", "n").collect()} == numbered
    right = spark.createDataFrame([("a", 10, "x"), ("a", 100, "y")], "k string, from_ bigint, name string")
    got = {(r.k, r.at): r.name for r in asof_backward(df, right, ["k"], "at", "from_", ["name"], span).collect()}
    assert got == {(k, at): None if k == "b" or at < 10 else "x" if at < 100 else "y" for k, at, _ in rows}


def test_deadline_batches_over_many_spans(spark, monkeypatch):
    """Sources of many spans, one that ends with a span: as walked one by one, and without a join over all entries a doubling step."""
    monkeypatch.setattr(delivery, "ROWS", 64)
    rng = random.Random(9)
    times = {"x": sorted(rng.sample(range(40_000), 3001)), "y": sorted(rng.sample(range(9000), 640))}
    kept = []
    monkeypatch.setattr(delivery, "stored", lambda df, name: kept.append((name, df.count())) or df.localCheckpoint())
    monkeypatch.setattr(delivery, "discard", lambda *tables: None)
    df = spark.createDataFrame([(s, t) for s in times for t in times[s]], "s string, at bigint")
    got = sorted(tuple(r) for r in delivery.deadline_batches(df, "s", "at", 4, 40).collect())
    want = []
    for s, ts in times.items():
        batch = []
        for i, t in enumerate(ts):
            batch.append(t)
            if len(batch) == 4 or t - batch[0] >= 40 or i + 1 == len(ts) or ts[i + 1] - t >= 40:
                want.append((s, batch[0], batch[-1], len(batch)))
                batch = []
    assert got == want
    assert max(n for name, n in kept if name in ("batch-steps", "batch-starts")) <= 4 * (3001 // 64 + 640 // 64 + 2)


@pytest.mark.parametrize("most,flush,seed", [(3, 10, 1), (50, 25, 2), (1, 5, 3), (1000, 1, 4)])
def test_deadline_batches(spark, most, flush, seed):
    rng = random.Random(seed)
    times = {s: sorted(rng.sample(range(600), 60)) for s in "xy"}
    df = spark.createDataFrame([(s, t) for s in times for t in times[s]], "s string, at bigint")
    got = sorted(tuple(r) for r in delivery.deadline_batches(df, "s", "at", most, flush).collect())
    want = []
    for s, ts in times.items():
        batch = []
        for i, t in enumerate(ts):
            batch.append(t)
            if len(batch) == most or t - batch[0] >= flush or i + 1 == len(ts) or ts[i + 1] - t >= flush:
                want.append((s, batch[0], batch[-1], len(batch)))
                batch = []
    assert got == sorted(want)


def test_order_faults(spark):
    kinds = "rows xid gtid rows xid rows xid gtid gtid rows xid".split()
    df = spark.createDataFrame([("s", i, k) for i, k in enumerate(kinds)], "source_uuid string, seq bigint, kind string")
    got = {(r.seq, r.reason) for r in assemble.order_faults(df).collect()}
    assert got == {(0, "rows_without_transaction"), (1, "terminator_without_transaction"), (5, "rows_without_transaction"), (6, "terminator_without_transaction"), (8, "gtid_within_open_transaction")}
    good = spark.createDataFrame([("s", i, k) for i, k in enumerate("gtid rows xid gtid xid gtid rows".split())], "source_uuid string, seq bigint, kind string")
    assert assemble.order_faults(good).isEmpty()


def test_xid_digest_is_of_the_framed_bytes(spark):
    import hashlib

    gtrid, bqual = "g" * 200, "é"
    got = spark.range(1).select(delivery.xid_digest(F.lit(7), F.lit(gtrid), F.lit(bqual)).alias("d")).first().d
    framed = b"".join(len(x).to_bytes(4, "little") + x for x in (gtrid.encode(), bqual.encode()))
    assert got == hashlib.sha256(b"xa.v1" + (7).to_bytes(4, "little") + framed).hexdigest()


def test_gate_thresholds_and_key_moves(spark):
    rows = [(i, op, k, n, "t") for i, (op, k, n) in enumerate([("insert", 5, 5), ("insert", 15, 15), ("update", 5, 5), ("update", 5, 15), ("update", 15, 5), ("update", 15, 25), ("delete", 11, 11), ("delete", 13, 13)])]
    df = spark.createDataFrame(rows, "seq int, op string, a int, b int, table string")
    images = snapshot.split_key_updates(df, "a", "b")

    def passed(cursor, delivered, done):
        cursors = spark.createDataFrame([("t", cursor, delivered, done)], "table string, pk_cursor int, delivered_pk int, done boolean")
        return sorted((r.seq, r.image_ix, r.op, r.k) for r in snapshot.gate(images, cursors).collect())

    assert passed(10, 12, False) == [(0, 0, "insert", 5), (2, 0, "update", 5), (3, 0, "delete", 5), (4, 1, "insert", 5), (6, 0, "delete", 11)]
    assert passed(None, None, False) == []
    assert len(passed(None, None, True)) == 11
    assert passed(None, 12, False) == [(3, 0, "delete", 5), (6, 0, "delete", 11)]


@pytest.mark.parametrize("seed", range(3))
def test_snapshot_woven_into_the_stream_gives_the_final_state_once(spark, seed):
    rng = random.Random(seed)
    base = {k: float(k) for k in range(0, 60, 2)}
    log = [(rng.choice(list(base)), seq, rng.choice(["insert", "update", "delete"]), float(1000 + seq)) for seq in range(150)]
    table = spark.createDataFrame(list(base.items()), "k bigint, v double")
    changes = spark.createDataFrame(log, "k bigint, seq bigint, op string, v double")
    received = snapshot.snapshot_then_stream(table, "k", ["v"], changes, 5, 149).collect()
    final = dict(base)
    for k, _, op, v in log:
        final.pop(k, None) if op == "delete" else final.__setitem__(k, v)
    state = {}
    for r in sorted(received, key=lambda r: (r.position, r.origin != "snapshot")):
        state.pop(r.k, None) if r.op == "delete" else state.__setitem__(r.k, r.v)
    assert state == final
    for k, v in final.items():
        assert sum(r.k == k and r.v == v and r.op != "delete" for r in received) == 1


@pytest.mark.parametrize("held", [range(0, 60, 2), range(0)])
def test_keys_outside_the_snapshotted_table_are_received(spark, held):
    rng = random.Random(7)
    base = {k: float(k) for k in held}
    log = [(rng.randrange(-10, 80), seq, rng.choice(["insert", "update", "delete"]), float(1000 + seq)) for seq in range(150)]
    table = spark.createDataFrame(list(base.items()), "k bigint, v double")
    changes = spark.createDataFrame(log, "k bigint, seq bigint, op string, v double")
    received = snapshot.snapshot_then_stream(table, "k", ["v"], changes, 5, 149).collect()

    def captured(k):  # six rows a chunk
        return 149 * (next((i for i in range(0, 30, 6) if k <= held[i + 5]), 24) // 6 + 1) // 5 if base else -1

    want = [(k, seq, op, v, "stream") for k, seq, op, v in log if seq > captured(k)]
    for k in {*base, *(r[0] for r in log)}:
        before = [r for r in log if r[0] == k and r[1] <= captured(k)]
        if before[-1][2] != "delete" if before else k in base:
            want.append((k, captured(k), "snapshot", before[-1][3] if before else base[k], "snapshot"))
    assert sorted(map(tuple, received)) == sorted(want)


def test_page_and_key_choice(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    page = snapshot.keyset_page(df, ["a", "b"], [1, 2], 5).collect()
    assert [(r.a, r.b) for r in page] == [(1, 3), (2, 0), (2, 1), (2, 2), (2, 3)] and not page[0].final_page
    rest = snapshot.keyset_page(df, ["a", "b"], [2, 3], 4).collect()
    assert len(rest) == 4 and rest[0].final_page
    assert snapshot.keyset_page(df, ["a", "b"], None, 16).first().final_page


def test_refused_values_fail_the_query(spark):
    for column in (snapshot.enum_value(F.lit(4), ["a", "b", "c"]), snapshot.set_value(F.lit(8), ["a", "b", "c"])):
        with pytest.raises(Exception, match="out_of_range"):
            spark.range(1).select(column).collect()


def test_prepared_transactions(spark):
    d = lambda rows, kind: spark.createDataFrame(rows, kind)
    got = delivery.resolve_prepared(d([("a",), ("b",), ("c",)], "digest string"), d([("a", "commit"), ("b", "rollback"), ("x", "commit"), ("y", "rollback"), ("z", "commit")], "digest string, verb string"), d([("x",)], "digest string"))
    assert {r.digest: r.outcome for r in got.collect()} == {"a": "committed", "b": "rolled_back", "c": "held", "x": "advanced", "y": "xa_rollback_without_prepare", "z": "xa_commit_without_prepare"}
    twice = delivery.resolve_prepared(d([("a",), ("a",)], "digest string"), d([("a", "commit"), ("a", "commit"), ("b", "commit"), ("b", "rollback")], "digest string, verb string"), d([("b",)] * 2, "digest string"))
    assert sorted(tuple(r) for r in twice.collect()) == [("a", "committed"), ("b", "conflicting_resolutions")]


def test_steps_of_a_digest_in_order(spark):
    log = [("p", 1), ("p", 1), ("c", 2), ("c", 3), ("c", 4), ("p", 5), ("p", 6), ("r", 7)]
    rows = [("d", {"p": "prepare", "c": "commit", "r": "rollback"}[v], "f", at, at, f"u:{n}", None) for at, (v, n) in enumerate(log)]
    steps = spark.createDataFrame(rows, "digest string, verb string, file string, at bigint, txn_ix bigint, gtid string, ts timestamp")
    got = [(r.outcome, r.prepare_gtid) for r in capture.resolve_steps(steps, spark.createDataFrame([("d",)], "digest string")).orderBy("at").collect()]
    assert got == [
        ("resolved", None), ("repeated", None), ("committed", "u:1"), ("advanced", None), ("xa_commit_without_prepare", None), ("held", None), ("xa_prepared_gtid_mismatch", None), ("rolled_back", "u:6"),
    ]


def test_checks_before_a_start(spark):
    d = lambda *rows: spark.createDataFrame(list(rows), "schema string, table string")
    catalog = spark.createDataFrame([("b", "y", "BASE TABLE"), ("a", "z", "BASE TABLE"), ("a", "v", "VIEW"), ("sys", "x", "BASE TABLE")], "schema string, table string, kind string")
    assert [tuple(r) for r in checks.base_tables(catalog).collect()] == [("a", "z"), ("b", "y")]
    assert [tuple(r) for r in checks.not_captured(d(("a", "z"), ("a", "q")), d(("a", "z"))).collect()] == [("a", "q")] and checks.not_captured(d(("a", "z")), None).isEmpty()
    assert sorted(tuple(r) for r in checks.drifted(d(("a", "z"), ("n", "n")), d(("a", "z"), ("o", "o"))).collect()) == [("n", "n", "configured"), ("o", "o", "stored")]
    assert checks.drifted(None, d(("a", "z"))).isEmpty()
    changes = spark.createDataFrame([(1, 2), (None, 2), (3, None)], "a int, b int")
    assert sorted(r.k for r in checks.distinct_keys(changes, "a", "b").collect()) == [1, 2, 3]
    assert checks.known_options({"a": 1}, ["a", "b"]) == {"a": 1}
    with pytest.raises(ValueError, match="^unknown_option$"):
        checks.known_options({"secret": 1}, ["a"])
