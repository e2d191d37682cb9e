"""What a stream carries from one delivery to the next: open and prepared transactions, chunks that wait, a merged mirror."""

import json
import random

import pytest
from pyspark.sql import functions as F
from test_capture import XID, file, gtid, prepared, query, rows, table, xa

from ledgerline.functions import gtid as sets
from ledgerline.operators import capture
from ledgerline.operators.delivery import xid_digest
from ledgerline.streaming.assembly import Assembler, CapturedPipeline, raw_events
from ledgerline.streaming.backfill import STATE, SnapshotStore
from ledgerline.streaming.delivery import Halt, Pipeline, Progress
from ledgerline.streaming.handoff import Handoff
from ledgerline.streaming.mirror import MergedMirror
from ledgerline.streaming.pool import Pool

CHANGES = "source_uuid string, gno bigint, op string, schema string, table string, k bigint, seq bigint, v bigint"


def points(progress):
    return {(r.source_uuid[-1], n) for r in progress.read().collect() for n in range(r.lo, r.hi + 1)}


# --- the pool -------------------------------------------------------------------------------------------------------


def test_a_version_counts_from_its_record_on(spark, tmp_path):
    progress = Progress(spark, f"{tmp_path}/p")
    pool = Pool(spark, f"{tmp_path}/pool", progress, {"a": "x int", "b": "y string"})

    def put(run, batch, x, record=True):
        pool.write(run, batch, {"a": spark.createDataFrame([(x,)], "x int"), "b": spark.createDataFrame([], "y string")})
        if record:
            progress.record(run, batch, spark.createDataFrame([("u", x, x)], "source_uuid string, lo bigint, hi bigint"))

    def now():
        tables, run = pool.read()
        return [r.x for r in tables["a"].collect()], run

    assert now() == ([], None)
    put("r", 0, 1)
    put("r", 1, 2, record=False)
    assert now() == ([1], "r")
    put("r", 1, 3)
    assert now() == ([3], "r")
    put("s", 0, 4)
    for k in range(4):
        put("s", k + 1, 10 + k)
    assert now() == ([13], "s") and len(pool._versions()) <= 4


def test_a_snapshot_state_that_was_cut_off_is_written_over(spark, tmp_path):
    store = SnapshotStore(spark, f"{tmp_path}/s")
    (tmp_path / "s" / "v0").mkdir(parents=True)
    (tmp_path / "s" / "v0" / "part-0.parquet").write_bytes(b"half")
    store.write(spark.createDataFrame([("s", "t", "f", 1, 2, 3, False)], STATE))
    assert [r.pk_cursor for r in store.read().collect()] == [1]


# --- whole and prepared transactions --------------------------------------------------------------------------------


def test_a_transaction_that_a_batch_cuts_is_delivered_whole(spark, tmp_path):
    log = [("u", n, i, "insert", 10 * n + i, i == 2) for n in range(1, 5) for i in range(3)]
    kind = "source_uuid string, gno bigint, change_ix int, op string, k int, last boolean"
    progress, got = Progress(spark, f"{tmp_path}/p"), []

    def sink(df, name):
        rows = [(r.gno, r.k) for r in df.collect()]
        got.append(rows)
        if len(got) == 3:
            raise OSError("killed")

    def run():
        for k, cut in enumerate(((0, 4), (4, 5), (5, 10), (10, 12))):
            Pipeline(progress, sink, end="last").deliver(spark.createDataFrame(log[slice(*cut)], kind), k)

    with pytest.raises(Halt, match="sink_error"):
        run()
    run()
    done = got[:2] + got[3:]
    assert sorted(x for rows in done for x in rows) == [(n, 10 * n + i) for n in range(1, 5) for i in range(3)]
    assert all(sum(g == n for g, _ in rows) in (0, 3) for rows in got for n in range(1, 5))
    assert points(progress) == {("u", n) for n in range(1, 5)}


def two_phase():
    def prepare(n, name, *ids):
        return [gtid(n), query(f"XA START {xa(name)}"), table(1, "a"), rows(1, *ids), query(f"XA END {xa(name)}"), prepared(name)]

    one = [*prepare(1, "x", 10, 11), *prepare(2, "y", 20), gtid(3), query("BEGIN"), table(1, "a"), rows(1, 30), rows(1, 31), XID, gtid(4), query("CREATE TABLE `n` (i INT)"), *prepare(5, "z", 50)]
    two = [gtid(6), query(f"XA COMMIT {xa('x')}"), gtid(7), query(f"XA ROLLBACK {xa('y')}"), gtid(8), query("XA COMMIT " + xa("old")), *prepare(9, "x", 90)]
    three = [gtid(10), query(f"XA COMMIT {xa('x')}"), gtid(11), query(f"XA COMMIT {xa('z')}")]
    return one, two, three


@pytest.mark.parametrize("cuts", [[], [3, 21]])
def test_prepares_wait_for_their_end_over_batches_and_restarts(spark, tmp_path, cuts):
    raw = raw_events(spark.createDataFrame([(f"f{i}", file(e)) for i, e in enumerate(two_phase())], "path string, content binary"))
    events = sorted((tuple(r) for r in raw.collect()), key=lambda r: r[:2])
    edges = [0, *cuts, len(events)] if cuts else [0, 22, 34, len(events)]
    known = spark.range(1).select(xid_digest(F.lit(7), F.lit("old"), F.lit("")).alias("digest"))
    progress, got, killed = Progress(spark, f"{tmp_path}/p"), {}, []

    def sink(df, name):
        got[name] = [(r.gno, r.op, r.after) for r in df.collect()]
        if name.startswith("run~1") and not killed:
            killed.append(1)
            raise OSError("killed")

    def flow():
        return CapturedPipeline(Pipeline(progress, sink), Assembler(spark, f"{tmp_path}/pool", progress, recovered=known))

    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        batch = spark.createDataFrame(events[a:b], raw.schema)
        try:
            flow().deliver(batch, k)
        except Halt:
            flow().deliver(batch, k)
    rows_of = sorted((n, json.loads(after)["id"]) for r in got.values() for n, op, after in r if op == "insert")
    assert rows_of == [(1, 10), (1, 11), (3, 30), (3, 31), (5, 50), (9, 90)]
    assert points(progress) == {("f", n) for n in range(1, 12)}
    whole = capture.placed_events(capture.told_events(raw))
    assert {(r.source_uuid[-1], r.gno) for r in capture.processed_points(whole, known).collect()} == points(progress)
    if cuts:
        return
    # Read again from the beginning under another name: nothing comes twice.
    got.clear()
    again = flow()
    again.pipeline.run = "other"
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        again.deliver(spark.createDataFrame(events[a:b], raw.schema), k)
    assert not [x for r in got.values() for x in r]


def test_the_ids_of_a_prepare_stay_open_until_its_end(spark, tmp_path):
    one, two, _ = two_phase()
    progress = Progress(spark, f"{tmp_path}/p")

    def deliver(k, name, events, **more):
        whole = Assembler(spark, f"{tmp_path}/pool", progress, **more)
        CapturedPipeline(Pipeline(progress, lambda df, _: None), whole).deliver(raw_events(spark.createDataFrame([(name, file(events))], "path string, content binary")), k)

    with pytest.raises(Halt, match="xa_prepared_pool_exhausted"):
        deliver(0, "f0", one, most_prepared=2)
    deliver(0, "f0", one, most_prepared=3)
    assert points(progress) == {("f", 3), ("f", 4)}
    with pytest.raises(Halt, match="xa_commit_without_prepare"):
        deliver(1, "f1", two)
    assert points(progress) == {("f", 3), ("f", 4)}
    with pytest.raises(Halt, match="xa_prepared_gtid_mismatch"):
        deliver(1, "f1", [gtid(20), query(f"XA START {xa('x')}"), prepared("x")])


# --- snapshot and stream --------------------------------------------------------------------------------------------


class Source:
    """A table and its log: what a server has, of which the stream has delivered a part."""

    def __init__(self, spark, rng, keys, changes):
        self.spark, self.log, self.at, self.start = spark, [], 0, {k: k for k in rng.sample(range(60), keys)}
        gno = {"a": 0, "b": 0}
        for seq in range(changes):
            u = rng.choice("ab")
            gno[u] += 1
            self.log.append((u, gno[u], rng.choice(["insert", "update", "update", "delete"]), "s", "t", rng.randrange(60), seq, 1000 + seq))

    def state(self, upto):
        now = dict(self.start)
        for *_, op, _, _, k, _, v in [(*r[:2], *r[2:]) for r in self.log[:upto]]:
            if op == "delete":
                now.pop(k, None)
            else:
                now[k] = v
        return now

    def read(self, schema, name):
        rows = [(k, self.at - 1, v) for k, v in self.state(self.at).items()]
        ids = self.spark.createDataFrame([r[:2] for r in self.log[: self.at]], "source_uuid string, gno bigint")
        return self.spark.createDataFrame(rows, "k bigint, seq bigint, v bigint"), sets.from_points(ids)


NAMES = "schema string, table string, fingerprint string"


@pytest.mark.parametrize("seed", range(2))
def test_chunks_and_changes_end_in_the_last_state(spark, tmp_path, seed):
    rng = random.Random(seed)
    source = Source(spark, rng, rng.choice([0, 9, 30]), 14)
    progress = Progress(spark, f"{tmp_path}/p")
    mirror = MergedMirror(f"{tmp_path}/m", "k bigint, v bigint", ["k"], "seq", progress, buckets=2, fan=4)
    fails, tried = {rng.randrange(1, 8)}, [0]

    def sink(df, name):
        mirror(df, name)
        tried[0] += 1
        if tried[0] in fails:
            raise OSError("killed after it wrote")

    def handoff():
        out = Handoff(Pipeline(progress, sink), str(tmp_path), source.read, CHANGES, size=8, chunks=2)
        out.begin(spark.createDataFrame([("s", "t", "f")], NAMES))
        return out

    sent = batch = 0
    while sent < len(source.log):
        source.at = min(len(source.log), max(source.at, sent) + rng.randrange(8))
        n = rng.randrange(2, 9)
        source.at = max(source.at, min(len(source.log), sent + n))  # a delivery has nothing that the server hasn't
        rows_ = spark.createDataFrame(source.log[sent : sent + n], CHANGES)
        for _ in range(2):
            try:
                handoff().deliver(rows_, batch)
                break
            except Halt:
                pass
        sent, batch = sent + n, batch + 1
    while handoff().advance():
        pass
    assert {r.k: r.v for r in mirror.state().collect()} == source.state(len(source.log))
    assert points(progress) == {r[:2] for r in source.log}


def test_an_update_between_read_and_record_of_a_chunk_survives(spark, tmp_path):
    source = Source(spark, random.Random(1), 0, 0)
    source.start, source.log = {1: 1, 2: 2}, [("a", 1, "update", "s", "t", 1, 0, 7), ("a", 2, "update", "s", "t", 1, 1, 8)]
    progress = Progress(spark, f"{tmp_path}/p")
    mirror = MergedMirror(f"{tmp_path}/m", "k bigint, v bigint", ["k"], "seq", progress)
    handoff = Handoff(Pipeline(progress, mirror), str(tmp_path), source.read, CHANGES)
    handoff.begin(spark.createDataFrame([("s", "t", "f")], NAMES))
    source.at = 1  # the chunk is read with the first update, while the delivery brings the second too
    handoff.deliver(spark.createDataFrame(source.log[1:], CHANGES), 0)
    assert mirror.state().isEmpty() and progress.read().isEmpty()  # the chunk waits for the first, and the second for the chunk
    handoff.deliver(spark.createDataFrame(source.log[:1], CHANGES), 1)
    assert {r.k: r.v for r in mirror.state().collect()} == {1: 8, 2: 2}
    assert not handoff.advance()
    for changed, code in ((spark.createDataFrame([("s", "t", "g")], NAMES), "snapshot_schema_drifted"), (spark.createDataFrame([("s", "u", "f")], NAMES), "snapshot_config_drifted")):
        with pytest.raises(Halt, match=code):
            handoff.begin(changed)


# --- the merged mirror ----------------------------------------------------------------------------------------------


def test_a_mirror_reads_few_tables_after_many_deliveries(spark, tmp_path):
    rng, now, most = random.Random(2), {}, 0
    progress = Progress(spark, f"{tmp_path}/p")
    mirror = MergedMirror(f"{tmp_path}/m", "k bigint, v bigint", ["k"], "seq", progress, buckets=2, fan=2)
    assert mirror.state().columns == ["k", "v"] and mirror.state().isEmpty()
    for n in range(11):
        changes = [("a", n + 1, rng.choice(["insert", "update", "delete"]), "s", "t", rng.randrange(12), 2 * n + i, rng.randrange(99)) for i in range(2)] if n % 5 else []
        df = spark.createDataFrame(changes, CHANGES)
        mirror(df, f"r~{n}")
        if n == 6:
            mirror(df, f"r~{n}")  # comes again before it was recorded
        progress.record("r", n, sets.from_points(df))
        for c in changes:
            now[c[5]] = c[7]
            if c[2] == "delete":
                now.pop(c[5])
        most = max(most, mirror.table_count())
    assert {r.k: r.v for r in mirror.state().collect()} == now
    assert most <= 2 * 4 and len(list((tmp_path / "m" / "came").iterdir())) <= 6
    some = spark.createDataFrame([(k,) for k in (1, 5, 500)], "k bigint")
    assert {r.k: r.v for r in mirror.lookup(some).collect()} == {k: v for k, v in now.items() if k in (1, 5)}
    mirror(spark.createDataFrame([("a", 99, "insert", "s", "t", 777, 99, 1)], CHANGES), "r~99")
    assert mirror.state().where("k = 777").isEmpty()  # written, not recorded


def test_open_transactions_are_not_broadcast(spark, monkeypatch):
    """What a micro-batch leaves open may be nearly all of it; and spans of a file's order are as wide as rows lie in it."""
    from types import SimpleNamespace

    from pyspark.sql import functions

    from ledgerline.plans.decode_queries import prepared_order_events
    from ledgerline.sources import binlog
    from ledgerline.streaming import assembly

    spans = []
    faults = capture.order_faults
    monkeypatch.setattr(assembly, "F", SimpleNamespace(**{**vars(functions), "broadcast": lambda _: pytest.fail("broadcast")}))
    monkeypatch.setattr(capture, "order_faults", lambda *a, **k: spans.append(k.get("span")) or faults(*a, **k))
    events = prepared_order_events(spark, "/root/testdata/sf0.001").where("file in ('1', '2', '4', '15')")
    shared = f"{spark.conf.get('spark.checkpoint.dir')}/unbroadcast"
    whole = assembly.Assembler(spark, f"{shared}/pool", assembly.Progress(spark, f"{shared}/progress"), [("shop", "orders")])
    step = whole.step(events.where("seq < 3"), "run")
    assert step.carried["open"].count() == 12 and step.changes.isEmpty()
    assert spans == [binlog.ORDER_SPAN]
