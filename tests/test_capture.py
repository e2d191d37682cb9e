import json
import struct

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import capture
import binlog_writer as w
from ledgerline.streaming.delivery import Halt, Pipeline, Progress

SID = bytes(range(16))
UUID = "00010203-0405-0607-0809-0a0b0c0d0e0f"


def gtid(n):
    return 33, b"\1" + SID + n.to_bytes(8, "little") + b"\0" * 17


def query(sql, schema=b"app"):
    return 2, struct.pack("<IIBHH", 1, 0, len(schema), 0, 0) + schema + b"\0" + sql.encode()


def table(ident, name):
    return 19, w.table_map_body(ident, "app", name, [3], b"", ["id"], b"\0")


def rows(ident, *ids):
    return 30, w.rows_body(ident, 1, [b"\0" + struct.pack("<i", i) for i in ids])


XID = (16, b"\1" * 8)
STREAM = [
    gtid(1), query("BEGIN"), table(1, "a"), rows(1, 10, 11), XID,
    gtid(2), query("ALTER TABLE `a` ADD x INT"),
    gtid(3), query("BEGIN"), table(2, "b"), rows(2, 20), query("COMMIT"),
]
PACKED = [gtid(4), query("BEGIN"), table(1, "a"), rows(1, 30), rows(1, 31), XID]
OPEN = [gtid(5), query("BEGIN"), table(1, "a"), rows(1, 40)]


def file(events, tail=()):
    return b"\xfebin" + b"".join(w.event(k, b, 1000 + i) for i, (k, b) in enumerate([*events, *tail]))


def captured(spark, *contents):
    return capture.captured_events(spark.createDataFrame([(f"f{i}", c) for i, c in enumerate(contents)], "path string, content binary"))


def test_committed_changes_of_files(spark):
    inner = b"".join(w.event(k, b, checksum=False) for k, b in PACKED)
    events = captured(spark, file(STREAM), file([(40, w.payload(inner))], OPEN))
    assert capture.capture_faults(events).isEmpty()
    got = capture.committed_changes(events).orderBy("gno", "change_ix").collect()
    assert [(r.gno, r.table, json.loads(r.after)["id"]) for r in got] == [(1, "a", 10), (1, "a", 11), (3, "b", 20), (4, "a", 30), (4, "a", 31)]
    assert {r.source_uuid for r in got} == {UUID} and got[0].commit_ts.second == 1004 % 60
    assert [tuple(r) for r in capture.schema_changes(events).collect()] == [(UUID, 2, "alter_table", "app", "a")]
    assert sorted(r.gno for r in capture.committed(events).collect()) == [1, 2, 3, 4]
    assert {r.table for r in capture.committed_changes(events, [("app", "b")]).collect()} == {"b"}


def test_faults_are_found(spark):
    bad = bytearray(file(STREAM))
    bad[-1] ^= 1
    events = captured(spark, bytes(bad), file([rows(1, 1), gtid(1), query("BEGIN"), gtid(2), XID]))
    assert {(r.file, r.reason) for r in capture.capture_faults(events).collect()} == {("f0", "crc_mismatch"), ("f1", "rows_without_transaction"), ("f1", "gtid_within_open_transaction")}


def xa(n, fmt=7):
    return f"X'{n.encode().hex()}',X'',{fmt}"


def prepared(n, one_phase=False):
    return 38, struct.pack("<BIII", one_phase, 7, len(n), 0) + n.encode()


def test_two_phase_transactions_over_files(spark):
    def rows_of(n, name, *ids):
        return [gtid(n), query(f"XA START {xa(name)}"), table(1, "a"), rows(1, *ids), query(f"XA END {xa(name)}"), prepared(name)]

    one = [*rows_of(1, "x", 10), *rows_of(2, "y", 20), gtid(3), query("BEGIN"), table(1, "a"), rows(1, 30), XID, *rows_of(4, "z", 40)]
    two = [gtid(5), query(f"XA COMMIT {xa('x')}"), gtid(6), query(f"XA ROLLBACK {xa('y')}"), gtid(7), query("XA COMMIT " + xa("old"))]
    late = [gtid(8), query(f"XA START {xa('w')}"), table(1, "a"), rows(1, 80), prepared("w", True)]
    events = captured(spark, file(one), file(two, late))
    known = events.where("kind = 'xa_resolve'").select(capture.xid_digest(F.lit(7), F.lit("old"), F.lit("")).alias("digest")).limit(1)
    got = {r.gno: (json.loads(r.after)["id"], r.commit_ts.second) for r in capture.committed_changes(events, recovered=known).collect()}
    assert {n: i for n, (i, _) in got.items()} == {1: 10, 3: 30, 8: 80}
    assert got[1][1] == 1001 % 60  # the time of its commit, not of its prepare
    assert sorted(r.gno for r in capture.processed_points(events, known).collect()) == [1, 2, 3, 5, 6, 7, 8]
    assert capture.capture_faults(events, known).isEmpty()
    assert [(r.file, r.reason) for r in capture.capture_faults(events).collect()] == [("f1", "xa_commit_without_prepare")]
    assert {r.outcome for r in capture.prepared_outcomes(events, known).collect()} == {"resolved", "held", "committed", "rolled_back", "advanced"}


def test_unknown_and_malformed_events_are_faults(spark):
    events = captured(spark, file([gtid(1), query("BEGIN"), (99, b"?"), XID, gtid(2), query("BEGIN"), (38, b"\0\0"), (29, b"text"), XID]))
    assert {r.reason for r in capture.capture_faults(events).collect()} == {"unknown_event_type", "xa_prepare_malformed"}
    texts = ["XA COMMIT X'61',X'',1", "XA ROLLBACK X'6',X'',1", "XA COMMIT X'61',X''", " XA ROLLBACK X'aB', X'00' , 4294967295 ", "XA COMMIT X'61',X'',1 ONE PHASE", "xa start X'61',X'',1"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", capture.binlog.resolution_of(F.col("t")).alias("r")).orderBy("i").collect()
    assert [r.r and (r.r.verb, r.r.format_id, bytes(r.r.gtrid)) for r in got] == [("commit", 1, b"a"), None, None, ("rollback", 4294967295, b"\xab"), ("commit", 1, b"a"), None]


def test_a_folder_of_files_is_delivered_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f0").write_bytes(file(STREAM))
    progress, got = Progress(spark, f"{tmp_path}/progress"), []
    pipeline = Pipeline(progress, lambda df, _: got.extend(df.select("gno", "op").collect()))

    def deliver(files, batch_id):
        events = capture.captured_events(files).persist()
        if not capture.capture_faults(events).isEmpty():
            raise Halt("event_parse_failed")
        pipeline.deliver(capture.committed_changes(events), batch_id)

    for _ in range(2):
        pipeline.run = f"run{_}"
        stream = capture.stream_files(spark, f"{tmp_path}/in")
        q = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", f"{tmp_path}/c{_}").trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
    assert sorted(r.gno for r in got) == [1, 1, 3]
    (tmp_path / "in" / "f1").write_bytes(file(OPEN)[:-2])
    with pytest.raises(Exception):
        capture.stream_files(spark, f"{tmp_path}/in").writeStream.foreachBatch(deliver).option("checkpointLocation", f"{tmp_path}/c9").trigger(availableNow=True).start().awaitTermination()
    assert progress.read().agg(F.sum(F.col("hi") - F.col("lo") + 1)).first()[0] == 2
