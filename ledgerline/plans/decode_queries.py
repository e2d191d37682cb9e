"""Queries over captured binary events, laid out byte by byte from the test tables and read back."""

from __future__ import annotations

import datetime as dt
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import capture
from ledgerline.operators.delivery import xid_digest
from ledgerline.sources import binlog
from ledgerline.sources.changelog import table
from ledgerline.sources.scratch import stored


def _once(value: Column, body) -> Column:
    """body(value) with the value's expression written once, however often body refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _bytes(n: Column, size: int) -> Column:
    return _once(F.lpad(F.hex(n.cast("bigint")), 2 * size, "0"), lambda d: F.unhex(F.concat(*[F.substring(d, 2 * k + 1, 2) for k in reversed(range(size))])))


def _raw(hexed: str) -> Column:
    return F.unhex(F.lit(hexed.replace(" ", "")))


def _event(kind: int, body: Column, sealed: bool = True, at: Column | None = None) -> Column:
    """A header of 19 bytes (time, type, server, size, position, flags) and a body, with a checksum if sealed."""
    def sealing(b: Column) -> Column:
        size = F.octet_length(b) + (23 if sealed else 19)
        head = F.concat(_bytes(at if at is not None else F.lit(0), 4), _bytes(F.lit(kind), 1), _bytes(F.lit(1), 4), _bytes(size, 4), _raw("00000000 0000"), b)
        return _once(head, lambda h: F.concat(h, _bytes(F.crc32(h), 4))) if sealed else head

    return _once(body, sealing)


def q42_crc_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit events with their checksums, of which every 50th is damaged and every 70th cut."""
    key = F.col("event_id")
    head = F.concat(_bytes(key % 1_000_000, 4), F.unhex(F.lit("10")), _bytes(F.lit(1), 4), _bytes(F.lit(31), 4), _bytes(key % 1_000_000, 4), _bytes(F.lit(0), 2), _bytes(key, 8))
    whole = F.concat(head, _bytes(F.crc32(head), 4))
    damaged = F.concat(F.substring(whole, 1, 27), _bytes(F.crc32(head).bitwiseXOR(F.lit(1)), 4))
    raw = F.when(key % 70 == 69, F.substring(whole, 1, 20)).when(key % 50 == 49, damaged).otherwise(whole)
    events = table(spark, sf_dir, "events").select(F.lit("f").alias("file"), key.alias("seq"), raw.alias("raw"))
    parsed = binlog.parse_headers(events)
    return parsed.groupBy(F.coalesce("fault", F.lit("ok")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("fault").isNull(), binlog.little(F.col("body"), 1, 7)).otherwise(0)).cast("bigint").alias("ids"))


#: Letters of the statement text in each payload of q43, all alike.
ALIKE = 300


def q43_zstd_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement text and three commits an event within a compressed payload, written out byte by byte: a frame of three
    blocks, of which the second stands for ALIKE bytes by one."""
    key = F.col("event_id")
    text = F.concat(_bytes(F.lit(0), 4), _raw("1D"), _bytes(F.lit(1), 4), _bytes(F.lit(19 + ALIKE), 4), _raw("00000000 0000"))
    commits = F.concat(*[_event(16, _bytes(key * 3 + i, 8), sealed=False) for i in range(3)])

    def block(content: Column, size: Column | int, kind: int, last: bool) -> Column:
        size = F.lit(size) if isinstance(size, int) else size
        return F.concat(_bytes(size * 8 + 2 * kind + int(last), 3), content)

    def packed(tail: Column) -> Column:
        # The frame: magic, a descriptor for one segment with its size over 256 in two bytes, and its blocks.
        n = F.octet_length(tail) + 19 + ALIKE
        frame = F.concat(_raw("28B52FFD 60"), _bytes(n - 256, 2), block(text, 19, 0, False), block(_raw("78"), ALIKE, 1, False), block(tail, F.octet_length(tail), 0, True))
        return _once(frame, lambda f: F.concat(_raw("02 01 00 03 03 FC"), _bytes(n, 2), _raw("01 01"), _bytes(F.octet_length(f), 1), _raw("00"), f))

    made = table(spark, sf_dir, "events").select(F.lit("f").alias("file"), key.alias("seq"), _event(40, _once(commits, packed)).alias("raw"))
    return binlog.open_events(made).where(F.col("type") == binlog.XID).select("seq", "inner", binlog.little(F.col("body"), 1, 7).alias("xid"))


#: A table map of shop.orders (id and cents BIGINT, status CHAR, day DATE): table 9, flags, names, types, metadata, null bits,
#: then the optional parts: signs of the two numbers, and the column names.
ORDERS_MAP = "090000000000 0000 04 73686F70 00 06 6F7264657273 00 04 08FE080A 02 FE04 00 01 01 00 04 14 02 6964 06 737461747573 05 63656E7473 03 646179"


def _order_row() -> Column:
    """The row image of an order: no null, id, status with its length, cents, and the day as year, month and day bits."""
    day = F.year("day") * 512 + F.month("day") * 32 + F.dayofmonth("day")
    return F.concat(_raw("00"), _bytes(F.col("o_orderkey"), 8), _bytes(F.octet_length("o_orderstatus"), 1), F.col("o_orderstatus").cast("binary"), _bytes(F.col("cents"), 8), _bytes(day, 3))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"), F.to_date("o_orderdate").alias("day"))


def _rows_event() -> Column:
    return _event(30, F.concat(_raw("090000000000 0000 0200 04 0F"), _order_row()))


def q44_binary_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = F.array(_event(19, _raw(ORDERS_MAP)), _rows_event())
    made = _orders(spark, sf_dir).select(F.col("o_orderkey").cast("string").alias("file"), F.posexplode(pair).alias("seq", "raw")).withColumn("seq", F.col("seq").cast("bigint"))
    return read_orders(made)


def read_orders(raw: DataFrame) -> DataFrame:
    """The orders in the row images of raw events."""
    events = stored(binlog.open_events(raw), "decode-events")  # looked at more than once below
    image = F.from_json("after", "id bigint, status string, cents bigint, day string")
    changes = binlog.decode_changes(events, [("shop", "orders")]).select("op", image.alias("r"))
    return changes.select("op", F.col("r.id").alias("o_orderkey"), F.col("r.status").alias("o_orderstatus"), F.col("r.cents").alias("cents"), F.col("r.day").alias("day"))


def _laid(kind: int, body: bytes, at: int = 0) -> bytes:
    """An event as _event() has it, for what is laid out in tasks."""
    head = struct.pack("<IBIIIH", at, kind, 1, len(body) + 23, 0, 0) + body
    return head + struct.pack("<I", zlib.crc32(head))


#: What all orders have alike: their table map, and the head of a rows event.
_LAID_MAP = _laid(19, bytes.fromhex(ORDERS_MAP))
_ROW_HEAD = bytes.fromhex("090000000000 0000 0200 04 0F")


def _laid_row(key: int, status: str | None, cents: int | None, day: dt.date | None) -> bytes:
    """The rows event of an order, with a bit for each value that is null."""
    said = (status or "").encode()
    values = [struct.pack("<q", key), None if status is None else bytes([len(said)]) + said, None if cents is None else struct.pack("<q", cents)]
    values.append(None if day is None else (day.year * 512 + day.month * 32 + day.day).to_bytes(3, "little"))
    nulls = sum(1 << i for i, v in enumerate(values) if v is None)
    return _laid(30, _ROW_HEAD + bytes([nulls]) + b"".join(v for v in values if v is not None))


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, content) of captured files: a table map and the orders of 5,000 keys each."""
    head = binlog.MAGIC + _LAID_MAP

    def file(part: pa.Table) -> pa.Table:
        rows = sorted(zip(*[part.column(c).to_pylist() for c in ("o_orderkey", "o_orderstatus", "cents", "day")]), key=lambda r: r[0])
        return pa.table({"name": [f"orders.{part.column('part')[0].as_py():06}"], "content": pa.array([head + b"".join(_laid_row(*r) for r in rows)], pa.binary())})

    return _orders(spark, sf_dir).withColumn("part", F.floor(F.col("o_orderkey") / 5000)).groupBy("part").applyInArrow(file, "name string, content binary")


SID = "00112233445566778899AABBCCDDEEFF"
UUID = "00112233-4455-6677-8899-aabbccddeeff"


def _laid_gtid(n: int) -> bytes:
    return _laid(33, bytes.fromhex("01" + SID) + struct.pack("<q", n) + bytes(17))


def _laid_statement(sql: str, at: int) -> bytes:
    return _laid(2, bytes.fromhex("01000000 00000000 04 0000 0000") + b"shop\0" + sql.encode(), at)


def _prepared(key: int, status: str | None, cents: int | None, day: dt.date | None) -> list[bytes]:
    """The events of an order in two phases: prepared as 2k unless its key ends in 9, ended as 2k + 1 by a commit (status F) or
    a rollback (O); of those that end in 4 the prepare comes twice, and of those that end in 5 it is in one phase, so that it
    commits at once. Keys of 19, 39 and so on were found prepared at start."""
    gtrid, digit = b"order-%d" % key, key % 10
    xid = f"X'{gtrid.hex()}',X'62',7"
    out = []
    if digit != 9:
        body = struct.pack("<BIII", digit == 5, 7, len(gtrid), 1) + gtrid + b"b"
        out = [_laid_gtid(key * 2), _laid_statement(f"XA START {xid}", 50), _LAID_MAP, _laid_row(key, status, cents, day), _laid(38, body, 100)]
    if digit == 4:
        out *= 2
    if status != "P" and digit != 5:
        out += [_laid_gtid(key * 2 + 1), _laid_statement(f"XA {'COMMIT' if status == 'F' else 'ROLLBACK'} {xid}", 1000 + digit)]
    return out


def _dealt_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders dealt over all tasks, however few parts their table has: laying out takes far longer than dealing."""
    return _orders(spark, sf_dir).repartition("o_orderkey")


def _each_prepared(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    for row in zip(*[binlog.values(batch.column(c)) for c in ("o_orderkey", "o_orderstatus", "cents", "day")]):
        yield str(row[0]), _prepared(*row)


def prepared_orders(spark: SparkSession, sf_dir: str, tables: list[tuple[str, str]]) -> DataFrame:
    """The records of the events of _prepared() of each order, read back from the bytes of a file an order."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(path, binlog.MAGIC + b"".join(events)) for path, events in _each_prepared(batch)]
            yield pa.RecordBatch.from_pydict({"path": pa.array([p for p, _ in made], pa.string()), "content": pa.array([c for _, c in made], pa.binary())})

    return capture.captured_events(_dealt_orders(spark, sf_dir).mapInArrow(files, "path string, content binary"), tables)


def prepared_order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, seq, raw) of each event of _prepared() of each order."""

    def events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(path, k, raw) for path, each in _each_prepared(batch) for k, raw in enumerate(each)]
            columns = {"file": pa.string(), "seq": pa.int64(), "raw": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], t) for i, t in enumerate(columns.values())], names=list(columns))

    return _dealt_orders(spark, sf_dir).mapInArrow(events, binlog.EVENT_SCHEMA)


def recovered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    gtrid = F.concat(F.lit("order-"), F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").where("o_orderkey % 20 = 19").select(xid_digest(F.lit(7), gtrid, F.lit("b")).alias("digest"))


def q45_xa_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [("shop", "orders")]
    changes = capture.committed_changes(prepared_orders(spark, sf_dir, tables), tables, recovered_orders(spark, sf_dir))
    image = F.from_json("after", "id bigint, cents bigint")
    return changes.select("source_uuid", "gno", F.unix_seconds("commit_ts").alias("committed_at"), image["id"].alias("o_orderkey"), image["cents"].alias("cents"))


def q46_xa_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each step of a two-phase transaction and what it came to, with how many ids are done in all."""
    events = prepared_orders(spark, sf_dir, [])  # no rows are looked at
    outcomes = stored(capture.prepared_outcomes(events, recovered_orders(spark, sf_dir)).select("gtid", "prepare_gtid", "outcome"), "captured-outcomes")
    steps = outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum(F.split("gtid", ":")[1].cast("bigint")).alias("ids"))
    done = capture.done_points(events, outcomes).agg(F.lit("done").alias("outcome"), F.count(F.lit(1)).alias("n"), F.sum("gno").alias("ids"))
    return steps.union(done)


#: A table map of shop.events (id BIGINT, doc JSON): as above.
EVENTS_MAP = "0A0000000000 0000 04 73686F70 00 06 6576656E7473 00 02 08F5 01 04 02 01 01 00 04 07 02 6964 03 646F63"


def _document() -> Column:
    """An object of two keys in binary: k, a number of 16 bits or null in its entry, and t, a string behind the keys."""
    k = F.get_json_object("props", "$.k").cast("int")
    said = F.col("event_type").cast("binary")
    number = F.when(k.isNull(), _raw("04 0000")).otherwise(F.concat(_raw("05"), _bytes(F.coalesce(k, F.lit(0)), 2)))
    entries = F.concat(_raw("1200 0100 1300 0100"), number, _raw("0C 1400"), _raw("6B 74"))
    return F.concat(_raw("00 0200"), _bytes(F.octet_length(said) + 21, 2), entries, _bytes(F.octet_length(said), 1), said)


def q50_json_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON columns of row images, read from their binary form to VARIANT."""
    image = _once(_document(), lambda d: F.concat(_raw("00"), _bytes(F.col("event_id"), 8), _bytes(F.octet_length(d), 4), d))
    pair = F.array(_event(19, _raw(EVENTS_MAP)), _event(30, F.concat(_raw("0A0000000000 0000 0200 02 03"), image)))
    made = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("file"), F.posexplode(pair).alias("seq", "raw")).withColumn("seq", F.col("seq").cast("bigint"))
    changes = binlog.decode_changes(stored(binlog.open_events(made), "decode-events"), [("shop", "events")])
    row = F.parse_json("after")
    return changes.select(F.variant_get(row, "$.id", "bigint").alias("event_id"), F.variant_get(row, "$.doc.k", "bigint").alias("k"), F.variant_get(row, "$.doc.t", "string").alias("kind"))


QUERIES = {f.__name__: f for f in (q42_crc_filter, q43_zstd_roundtrip, q44_binary_decode, q45_xa_committed, q46_xa_outcomes, q50_json_columns)}
ORACLES = {
    "q42_crc_filter": "SELECT CASE WHEN event_id % 70 = 69 THEN 'truncated' WHEN event_id % 50 = 49 THEN 'crc_mismatch' ELSE 'ok' END AS verdict, count(*)::BIGINT AS n, sum(CASE WHEN event_id % 70 = 69 OR event_id % 50 = 49 THEN 0 ELSE event_id END)::BIGINT AS ids FROM events GROUP BY 1",
    "q43_zstd_roundtrip": "SELECT event_id AS seq, i::BIGINT AS inner, event_id * 3 + i - 1 AS xid FROM events, range(1, 4) AS r(i)",
    "q44_binary_decode": "SELECT 'insert' AS op, o_orderkey, o_orderstatus, round(o_totalprice * 100)::BIGINT AS cents, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
    "q45_xa_committed": """SELECT '00112233-4455-6677-8899-aabbccddeeff' AS source_uuid, o_orderkey * 2 AS gno, CASE WHEN o_orderkey % 10 = 5 THEN 100 ELSE 1000 + o_orderkey % 10 END AS committed_at,
        o_orderkey, round(o_totalprice * 100)::BIGINT AS cents
      FROM orders WHERE o_orderkey % 10 = 5 OR (o_orderkey % 10 <> 9 AND o_orderstatus = 'F')""",
    "q50_json_columns": "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, event_type AS kind FROM events",
    "q46_xa_outcomes": """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 10 AS d, o_orderstatus AS s, o_orderkey % 20 = 19 AS found FROM orders),
      steps AS (
        SELECT 'repeated' AS outcome, k * 2 AS id, false AS done FROM o WHERE d = 4
        UNION ALL SELECT CASE WHEN s = 'P' THEN 'held' ELSE 'resolved' END, k * 2, false FROM o WHERE d NOT IN (5, 9)
        UNION ALL SELECT CASE s WHEN 'F' THEN 'committed' ELSE 'rolled_back' END, k * 2 + 1, true FROM o WHERE d NOT IN (5, 9) AND s <> 'P'
        UNION ALL SELECT CASE WHEN found THEN 'advanced' WHEN s = 'F' THEN 'xa_commit_without_prepare' ELSE 'xa_rollback_without_prepare' END, k * 2 + 1, found FROM o WHERE d = 9 AND s <> 'P'),
      ids AS (SELECT id FROM steps WHERE done UNION SELECT id - 1 FROM steps WHERE outcome IN ('committed', 'rolled_back') UNION SELECT k * 2 FROM o WHERE d = 5)
      SELECT outcome, count(*)::BIGINT AS n, sum(id)::BIGINT AS ids FROM steps GROUP BY 1 UNION ALL SELECT 'done', count(*)::BIGINT, sum(id)::BIGINT FROM ids""",
}
