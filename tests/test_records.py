"""Captured events read in one pass a file, and over spans of a file."""

import random
import struct

import pytest
from pyspark.sql import functions as F
from test_capture import XID, captured, file, gtid, prepared, query, rows, table, xa

import binlog_writer as w
from ledgerline.operators import capture
from ledgerline.operators.delivery import xid_digest
from ledgerline.sources import binlog, records


def drawn(rng, n):
    """Events of transactions of every shape, the last one open, some of them in payloads and some against the order."""
    out = []
    for k in range(1, n + 1):
        name, some = f"t{k}", [table(1, "a"), rows(1, 10 * k, 10 * k + 1), table(2, "b"), rows(2, 10 * k + 2), (29, b"text")]
        xs = [gtid(k), *rng.choice([
            [query("BEGIN"), *some, XID], [query("BEGIN"), *some, query("SAVEPOINT `s`"), query("COMMIT")], [query("CREATE TABLE `n` (i INT)")],
            [query(f"XA START {xa(name)}"), *some, query(f"XA END {xa(name)}"), prepared(name)], [query(f"XA COMMIT {xa(f't{max(1, k - 1)}')}")],
            [query(f"XA START {xa(name)}"), *some, prepared(name, True)], [(4, b"12345678")], [query("BEGIN"), *some],
        ])]
        out += [(40, w.payload(b"".join(w.event(a, b, 7, checksum=False) for a, b in xs)))] if rng.random() < 0.2 else xs
    return [*out, gtid(n + 1), query("BEGIN"), *some]


@pytest.mark.parametrize("seed", range(2))
def test_spans_of_a_file_equal_the_whole_file(spark, monkeypatch, seed):
    rng = random.Random(seed)
    files = spark.createDataFrame([(f"f{i}", file(drawn(rng, n))) for i, n in enumerate((1, 4, 9))], "path string, content binary")
    raw = spark.createDataFrame([tuple(r) for r in binlog.split_events(files).collect()], binlog.EVENT_SCHEMA)

    def found():
        events = capture.placed_events(capture.told_events(raw))
        kept = events.where("kind not in ('fault', 'mark')").collect()
        return sorted(map(str, kept)), sorted(map(tuple, capture.event_faults(events).collect()))

    whole = found()
    monkeypatch.setattr(records, "SPAN", 3)
    assert found() == whole and any("kind='open'" in r for r in whole[0])
    closed = [r for r in whole[0] if "kind='open'" not in r]
    assert sorted(str(r) for r in capture.captured_events(files).where("kind <> 'fault'").collect()) == closed


def test_only_rows_of_listed_tables_are_read(spark):
    strange = (19, w.table_map_body(3, "app", "c", [4], b"", ["f"], b""))
    events = spark.createDataFrame([("f", file([gtid(1), query("BEGIN"), table(1, "a"), rows(1, 5), strange, rows(3, 6), rows(9, 7), XID]))], "path string, content binary")
    assert capture.captured_events(events, [("app", "b")]).where("kind = 'change' and reason is null").isEmpty()
    read = capture.captured_events(events)
    with pytest.raises(Exception, match="unsupported_column_type|unmapped_table_id"):
        capture.committed_changes(read).collect()
    with pytest.raises(Exception, match="unmapped_table_id"):
        capture.committed_changes(read, [("app", "a")]).collect()


def test_a_text_that_is_none_fails_without_its_bytes(spark):
    with pytest.raises(Exception, match="statement_malformed") as fault:
        captured(spark, file([gtid(1), (2, struct.pack("<IIBHH", 1, 0, 1, 0, 0) + b"s\0secret\xff")]))
    assert "secret" not in str(fault.value)


def test_digests_equal_those_of_columns(spark):
    ids = [(0, b"", b""), (7, b"order-1", b"b"), ((1 << 32) - 1, b"\0\xff" * 40, b"x"), (9_999_999_999, b"g", b"")]
    df = spark.createDataFrame(ids, "f bigint, g binary, b binary").select(xid_digest(F.col("f"), F.col("g"), F.col("b")).alias("d"))
    assert [r.d for r in df.collect()] == [records.digest_of(*x) for x in ids]


def test_an_image_that_says_more_than_it_holds_is_refused():
    m = binlog.table_map(w.table_map_body(1, "s", "t", [8], b"", ["id"], b"\0"))
    with pytest.raises(ValueError, match="row_image_malformed"):
        binlog.row_changes(30, w.rows_body(1, 1, [b"\0\1\2"]), m)


def test_orders_are_dealt_over_tasks(spark, sf_dir):
    from ledgerline.plans import decode_queries as d

    plan = d._dealt_orders(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [o_orderkey" in plan


def test_events_are_dealt_once_where_files_come_whole(spark, sf_dir):
    from ledgerline.plans import decode_queries as d

    events = d.prepared_orders(spark, sf_dir, [("app", "other")])
    assert events.where("kind = 'change'").isEmpty() and not events.where("kind = 'done'").isEmpty()
    plan = capture.two_phase_steps(events)._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Join", "Window", "Aggregate"))  # steps are read as they stand


def test_outcomes_of_steps_are_found_once_for_what_is_done(spark):
    events = captured(spark, file([gtid(1), query(f"XA START {xa('x')}"), prepared("x"), gtid(2), query(f"XA COMMIT {xa('x')}"), gtid(3), query("BEGIN"), XID]))
    points = capture.processed_points(events)
    assert sorted(r.gno for r in points.collect()) == [1, 2, 3]
    assert points._jdf.queryExecution().optimizedPlan().toString().count("lag(") == 1
