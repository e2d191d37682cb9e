import pytest
from pyspark.sql import functions as F

from ledgerline.functions import gtid
from ledgerline.sources.changelog import change_log
from ledgerline.streaming.backfill import Backfill, SnapshotStore
from ledgerline.streaming.delivery import Halt, Mirror, Permanent, Pipeline, Progress, measured, patiently


def _inputs(spark, sf_dir, tmp_path, parts=3):
    log = change_log(spark, sf_dir).withColumns({"schema": F.lit("app"), "table": F.lit("t")}).where("seq < 300")
    for k in range(parts):
        log.where(f"seq % {parts} = {k}").coalesce(1).write.parquet(f"{tmp_path}/in{k}")
    return log


def _stream(spark, log, folder, files):
    import shutil
    from pathlib import Path

    Path(folder).mkdir(exist_ok=True)
    for k in files:
        for p in Path(f"{folder}/..").resolve().glob(f"in{k}/part-*.parquet"):
            shutil.copy(p, f"{folder}/{k}.parquet")
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def _run(pipeline, stream, checkpoint):
    q = pipeline.start(stream, checkpoint, {"availableNow": True})
    q.awaitTermination()


def test_each_transaction_is_delivered_once_over_a_failure_and_a_lost_offset_log(spark, sf_dir, tmp_path):
    log = _inputs(spark, sf_dir, tmp_path)
    progress, mirror = Progress(spark, f"{tmp_path}/progress"), Mirror(f"{tmp_path}/mirror", ["pk"], "seq", ["value"], Progress(spark, f"{tmp_path}/progress"))
    folder = f"{tmp_path}/stream"
    _run(Pipeline(progress, mirror), _stream(spark, log, folder, [0]), f"{tmp_path}/c1")

    def broken(changes, batch_id):
        raise OSError("disk")

    with pytest.raises(Exception):
        _run(Pipeline(progress, broken), _stream(spark, log, folder, [0, 1]), f"{tmp_path}/c1")
    assert progress.read().agg(F.sum(F.col("hi") - F.col("lo") + 1)).first()[0] == log.where("seq % 3 = 0").count()
    # A new offset log replays everything into the same mirror; what was processed is passed over.
    _run(Pipeline(progress, mirror), _stream(spark, log, folder, [0, 1, 2]), f"{tmp_path}/c2")
    ledger = mirror.ledger(spark).select("gtid")
    assert ledger.count() == ledger.distinct().count() == log.count()
    assert gtid.render(progress.read()).first()[0] == gtid.render(gtid.from_points(log)).first()[0]


def _mirror(spark, tmp_path, name="m"):
    progress = Progress(spark, f"{tmp_path}/{name}-progress")
    return progress, Mirror(f"{tmp_path}/{name}", ["pk"], "seq", ["value"], progress)


@pytest.mark.parametrize("crash", ["none", "after the sink", "after the record"])
@pytest.mark.parametrize("again", ["same run", "new run"])
def test_a_batch_that_comes_again_keeps_every_row_once(spark, sf_dir, tmp_path, monkeypatch, crash, again):
    log = _inputs(spark, sf_dir, tmp_path, parts=1)
    progress, mirror = _mirror(spark, tmp_path)
    one, two = log.where("seq < 100"), log.where("seq >= 100")
    pipeline = Pipeline(progress, mirror, run="a", retries=1)
    pipeline.deliver(one, 0)
    record = Progress.record

    def broken(self, *args):
        if crash == "after the record":
            record(self, *args)
        raise OSError("killed")

    with monkeypatch.context() as patch:
        if crash != "none":
            patch.setattr(Progress, "record", broken)
            with pytest.raises(Halt, match="checkpoint_write_failed"):
                pipeline.deliver(two, 1)
        else:
            pipeline.deliver(two, 1)
    if again == "same run":
        pipeline.deliver(two, 1)
        pipeline.deliver(two, 1)
    else:
        other = Pipeline(progress, mirror, run="b")
        other.deliver(log.where("seq < 200"), 0)
        other.deliver(log.where("seq >= 200"), 1)
        other.deliver(log.where("seq < 200"), 0)
    ledger = sorted(r.gtid for r in mirror.ledger(spark).collect())
    assert ledger == sorted(f"{r.source_uuid}:{r.gno}" for r in log.collect())
    last = {}
    for r in sorted(log.collect(), key=lambda r: r.seq):
        last[r.pk] = r
    assert {(r.pk, r.value) for r in mirror.state(spark).collect()} == {(k, r.value) for k, r in last.items() if r.op != "delete"}


def test_progress_is_folded_and_goes_on(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ledgerline.streaming.delivery.FOLDED", 3)
    progress = Progress(spark, f"{tmp_path}/p")
    for k in range(8):
        progress.record("r", k, spark.createDataFrame([("u", 10 * k, 10 * k + 4 + 5 * (k % 2))], "source_uuid string, lo bigint, hi bigint"))
        assert progress.holds("r", k) and not progress.holds("r", k + 1)
    want = [("u", 0, 4), ("u", 10, 24), ("u", 30, 44), ("u", 50, 64), ("u", 70, 79)]
    assert sorted(tuple(r) for r in gtid.normalize(progress.read()).collect()) == want
    assert sorted(tuple(r) for r in gtid.normalize(Progress(spark, f"{tmp_path}/p").read()).collect()) == want


def test_schema_changes_are_delivered_between_the_data(spark, sf_dir, tmp_path):
    log = _inputs(spark, sf_dir, tmp_path, parts=1).where("gno <= 20").withColumn("op", F.when(F.col("gno").isin(5, 9), "schema").otherwise(F.col("op")))
    got = []

    def note(kind):
        return lambda df, name: got.append((kind, sorted((r.source_uuid[-1], r.gno) for r in df.collect())))

    Pipeline(Progress(spark, f"{tmp_path}/p"), note("data"), schema_sink=note("schema")).deliver(log, 0)
    sources = sorted({r.source_uuid[-1] for r in log.collect()})

    def each(*numbers):
        return [(s, n) for s in sources for n in numbers]

    assert got == [("data", each(1, 2, 3, 4)), ("schema", each(5)), ("data", each(6, 7, 8)), ("schema", each(9)), ("data", each(*range(10, 21)))]


def test_a_fault_in_a_batch_halts_before_delivery(spark, sf_dir, tmp_path):
    log = _inputs(spark, sf_dir, tmp_path, parts=1)
    got = []
    pipeline = Pipeline(Progress(spark, f"{tmp_path}/p"), lambda df, _: got.append(1), faults=lambda df: df.where("gno = 7").select(F.lit("data_gap").alias("reason")))
    with pytest.raises(Halt, match="^data_gap$"):
        pipeline.deliver(log, 0)
    assert not got and pipeline.progress.read().isEmpty()


def test_tries_again_with_pauses_but_not_for_a_permanent_fault():
    tried = []

    def task(fault):
        tried.append(1)
        raise fault

    for fault, n in ((OSError("x"), 3), (Permanent("x"), 1)):
        tried.clear()
        with pytest.raises(Halt, match="^code$"):
            patiently(lambda: task(fault), "code", tries=3, pause=0.001)
        assert len(tried) == n


def test_only_counts_and_allowed_names_are_told():
    assert measured({"row_count": 3}, {"table": "t"}) == {"row_count": 3, "table": "t"}
    for measures, labels in (({"balance": 3}, {}), ({}, {"value": "secret"}), ({"row_count": -1}, {}), ({"row_count": "secret"}, {}), ({"row_count": float("nan")}, {})):
        with pytest.raises(ValueError) as fault:
            measured(measures, labels)
        assert "secret" not in str(fault.value)


@pytest.mark.parametrize("breaks_at", [None, 0, 2, 5])
def test_a_snapshot_resumes_where_it_broke_off(spark, tmp_path, breaks_at):
    tables = {("s", "a"): spark.range(0, 47).selectExpr("id * 3 AS k", "id AS v"), ("s", "b"): spark.range(5).selectExpr("id AS k", "id AS v"), ("s", "none"): spark.range(0).selectExpr("id AS k", "id AS v")}
    names = spark.createDataFrame([(s, t, "f") for s, t in tables], "schema string, table string, fingerprint string")
    rows, calls = {}, []

    def sink(df, name):
        calls.append(name)
        for r in df.collect():
            rows[name.split("~")[0], r.k] = r.v
        if len(calls) - 1 == breaks_at:
            raise OSError("killed after it wrote")

    def start():
        filling = Backfill(SnapshotStore(spark, f"{tmp_path}/state"), sink, size=10)
        filling.begin(names)
        filling.run(lambda s, t: (tables[s, t], "k"))
        return filling

    if breaks_at is not None:
        with pytest.raises(Halt, match="snapshot_sink_error"):
            start()
        state = {r.table: r for r in SnapshotStore(spark, f"{tmp_path}/state").cursors().collect()}
        ahead = [r for r in state.values() if r.delivered_pk is not None and (r.pk_cursor is None or r.delivered_pk > r.pk_cursor)]
        assert len(ahead) == 1  # what the sink may have, but which is read again
    filling = start()
    assert rows == {(f"{s}.{t}", r.k): r.v for (s, t), df in tables.items() for r in df.collect()}
    assert len(calls) == 6 + (breaks_at is not None) and all(r.done for r in filling.store.read().collect())
    other = names.withColumn("fingerprint", F.lit("changed"))
    for changed, code in ((other, "snapshot_schema_drifted"), (names.limit(1), "snapshot_config_drifted")):
        with pytest.raises(Halt, match=code):
            filling.begin(changed)


def test_filtered_transactions_still_advance_the_processed_set(spark, sf_dir, tmp_path):
    log = _inputs(spark, sf_dir, tmp_path, parts=1)
    progress, got = Progress(spark, f"{tmp_path}/progress"), []
    pipeline = Pipeline(progress, lambda df, _: got.append(df.count()), tables=[("app", "other")])
    pipeline.deliver(log, 0)
    assert got == [0]
    assert gtid.render(progress.read()).first()[0] == gtid.render(gtid.from_points(log)).first()[0]
    progress.seed(spark.createDataFrame([("x", 1, 2)], "source_uuid string, lo bigint, hi bigint"))
    assert progress.read().where("source_uuid = 'x'").isEmpty()


def test_a_sink_fault_halts_without_values(spark, sf_dir, tmp_path):
    log = _inputs(spark, sf_dir, tmp_path, parts=1)

    def broken(changes, batch_id):
        raise ValueError("secret 42")

    with pytest.raises(Halt) as halt:
        Pipeline(Progress(spark, f"{tmp_path}/p"), broken).deliver(log, 0)
    assert str(halt.value) == "sink_error"
