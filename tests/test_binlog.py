import datetime as dt
import json
import struct

import pytest

from ledgerline.sources import binary_json, binlog
import binlog_writer as w

GTID_BODY = b"\1" + bytes(range(16)) + (42).to_bytes(8, "little") + b"\0" * 17


def test_events_of_a_file(spark):
    sql = b"CREATE TABLE t (id INT)"
    query = struct.pack("<IIBHH", 1, 0, 2, 0, 3) + b"\0\0\0" + b"db\0" + sql
    raws = [w.event(33, GTID_BODY, 7), w.event(2, query), w.event(16, (5).to_bytes(8, "little"))]
    cut = w.event(16, b"12345678")[:-3]
    files = spark.createDataFrame([("f", b"\xfebin" + b"".join(raws) + cut)], "path string, content binary")
    events = binlog.parse_headers(binlog.split_events(files)).orderBy("seq")
    rows = events.withColumns({"gtid": binlog.gtid_of(events.body), "q": binlog.statement_of(events.body)}).collect()
    assert [r.type for r in rows[:3]] == [33, 2, 16]
    assert [r.fault for r in rows] == [None, None, None, "truncated"]
    assert rows[0].gtid == "00010203-0405-0607-0809-0a0b0c0d0e0f:42" and rows[0].timestamp == 7
    assert rows[1].q.schema == "db" and rows[1].q.sql == sql.decode()


def test_row_image_of_every_type():
    types = [1, 1, 2, 9, 3, 8, 8, 246, 15, 254, 252, 18, 17, 10, 19, 254, 254]
    meta = b"\x0a\x02" + b"\x32\0" + b"\xfe\x0a" + b"\2" + b"\3" + b"\0" + b"\6" + b"\xf7\1" + b"\xf8\1"
    names = [f"c{i}" for i in range(len(types))]
    # Numbers in order: tiny signed, tiny, short, int24, int, big and decimal; unsigned are the 2nd, 3rd, 4th, 5th and 6th big.
    unsigned = bytes([0b01111010])
    m = binlog.table_map(w.table_map_body(1, "s", "t", types, meta, names, unsigned, sets=[["a", "b", "c"]], enums=[["small", "medium"]]))
    stamp = (2024 * 13 + 1) << 5 | 15
    image = b"\0\0\0" + b"\x80" + b"\xff" + b"\xff\xff" + b"\xff\xff\xff" + b"\xff\xff\xff\xff" + b"\0" * 7 + b"\x80" + b"\xff" * 8
    image += bytes.fromhex("8000303943")  # 12345.67 as DECIMAL(10,2)
    image += b"\3abc" + b"\2xy" + b"\4\0text"
    image += ((stamp << 17 | 10 << 12 | 30 << 6) + 0x8000000000).to_bytes(5, "big") + (1230).to_bytes(2, "big")
    image += (1705314600).to_bytes(4, "big") + w.date_bytes(dt.date(2024, 1, 15))
    image += ((10 << 12 | 30 << 6) + 0x800000).to_bytes(3, "big") + (123456).to_bytes(3, "big") + b"\2" + b"\5"
    (op, before, after), = binlog.row_changes(30, w.rows_body(1, len(types), [image]), m)
    got = list(json.loads(after).values())
    assert (op, before) == ("insert", None)
    assert got[:7] == [-128, 255, 65535, 16777215, 4294967295, -(2**63), 2**64 - 1]
    assert got[7:] == ["12345.67", "abc", "xy", "text", "2024-01-15 10:30:00.123000", "2024-01-15 10:30:00+00:00", "2024-01-15", "10:30:00.123456", "medium", "a,c"]


def test_update_and_null():
    m = binlog.table_map(w.table_map_body(1, "s", "t", [3, 3], b"", ["id", "v"], b"\0"))
    body = w.rows_body(1, 2, [b"\0" + struct.pack("<ii", 1, 2), b"\2" + struct.pack("<i", 1)], update=True)
    assert [(op, json.loads(a), json.loads(b)) for op, a, b in binlog.row_changes(31, body, m)] == [("update", {"id": 1, "v": 2}, {"id": 1, "v": None})]


@pytest.mark.parametrize("types,meta,names,unsigned,reason", [([4], b"", ["f"], b"", "unsupported_column_type"), ([3], b"", [], b"\0", "missing_column_names"), ([3], b"", ["a"], b"", "missing_signedness")])
def test_refused_tables(types, meta, names, unsigned, reason):
    m = binlog.table_map(w.table_map_body(1, "s", "t", types, meta, names, unsigned))
    with pytest.raises(ValueError, match=reason):
        binlog.row_changes(30, w.rows_body(1, 1, [b"\0\0\0\0\0"]), m)


def test_payload_faults(monkeypatch):
    good = w.payload(w.event(16, b"12345678", checksum=False))
    assert len(binlog.inflate(good)) == 27
    for bad, reason in ((b"", "missing_end_mark"), (b"\0", "missing_payload_size"), (b"\1\1\0\0", "missing_compression_type"), (good + b"x", "payload_trailing_bytes"), (good[:-1], "payload_size_exceeded")):
        with pytest.raises(ValueError, match=reason):
            binlog.inflate(bad)
    monkeypatch.setattr(binlog, "MOST_INFLATED", 10)
    with pytest.raises(ValueError, match="payload_too_large"):
        binlog.inflate(good)


def test_rows_use_the_last_map_of_their_own_table_id(spark):
    def table(ident, name):
        return w.event(19, w.table_map_body(ident, "s", name, [3], b"", ["id"], b"\0"))

    def rows(ident, *ids):
        return w.event(30, w.rows_body(ident, 1, [b"\0" + struct.pack("<i", i) for i in ids]))

    raws = [table(1, "a"), table(2, "b"), rows(1, 10, 11), rows(2, 20), table(1, "c"), rows(1, 30)]
    df = spark.createDataFrame([("f", i, r) for i, r in enumerate(raws)], "file string, seq bigint, raw binary")
    events = binlog.parse_headers(df).selectExpr("*", "0L AS inner")
    got = [(r.table, json.loads(r.after)["id"]) for r in binlog.decode_changes(events).orderBy("seq", "change_ix").collect()]
    assert got == [("a", 10), ("a", 11), ("b", 20), ("c", 30)]
    assert {r.table for r in binlog.decode_changes(events, [("s", "b")]).collect()} == {"b"}
    with pytest.raises(Exception, match="unmapped_table_id"):
        binlog.decode_changes(events.where("seq <> 0 and seq <> 4")).collect()


# --- JSON columns ---------------------------------------------------------------------------------------------------


def _varint(n):
    out = b""
    while True:
        out += bytes([n & 0x7F | (0x80 if n > 0x7F else 0)])
        n >>= 7
        if not n:
            return out


def _binary_json(x, width=2):
    """(tag, bytes, whether it goes into an entry) of a value; a pair of a tag and bytes is a wrapped value."""
    if x is None or isinstance(x, bool):
        return 4, bytes([{None: 0, True: 1, False: 2}[x]]) + b"\0" * (width - 1), True
    if isinstance(x, int):
        for tag, f, inline in ((5, "<h", True), (6, "<H", True), (7, "<i", width == 4), (8, "<I", width == 4), (9, "<q", False), (10, "<Q", False)):
            try:
                raw = struct.pack(f, x)
                return tag, raw + b"\0" * (width - len(raw) if inline else 0), inline
            except struct.error:
                pass
    if isinstance(x, float):
        return 11, struct.pack("<d", x), False
    if isinstance(x, str):
        return 12, _varint(len(x.encode())) + x.encode(), False
    if isinstance(x, tuple):
        return 15, bytes([x[0]]) + _varint(len(x[1])) + x[1], False
    named = isinstance(x, dict)
    number = "<H" if width == 2 else "<I"
    keys = [k.encode() for k in x] if named else []
    values = [_binary_json(v, width) for v in (x.values() if named else x)]
    at = 2 * width + len(keys) * (width + 2) + len(values) * (1 + width)
    entries, tail = b"", b"".join(keys)
    for k in keys:
        entries += struct.pack(number, at) + struct.pack("<H", len(k))
        at += len(k)
    for tag, raw, inline in values:
        entries += bytes([tag]) + (raw if inline else struct.pack(number, at))
        if not inline:
            tail, at = tail + raw, at + len(raw)
    whole = struct.pack(number, len(x)) + struct.pack(number, at) + entries + tail
    return (0 if named else 2) + (width == 4), whole, False


def pack(x, width=2):
    tag, raw, _ = _binary_json(x, width)
    return bytes([tag]) + raw


@pytest.mark.parametrize("width", [2, 4])
@pytest.mark.parametrize(
    "value", [None, True, False, 0, -1, 32767, 40000, -70000, 4_000_000_000, -(1 << 63), (1 << 64) - 1, 1.5, -2e300, "", "é\"\\n😀", "x" * 300, [], {}, [[[]], {}], {"a": {"b": [1, "two", None, {"c": 99999, "": [True]}]}, "ä": -5}]
)
def test_binary_json(value, width):
    assert json.loads(binary_json.json_text(pack(value, width), binlog._decimal)) == value


def test_wrapped_values_of_json():
    def text(kind, raw):
        return binary_json.json_text(pack([(kind, raw)]), binlog._decimal)

    def packed(y, mo, d, h, mi, s, micro):
        return struct.pack("<q", ((((y * 13 + mo) << 5 | d) << 17 | h << 12 | mi << 6 | s) << 24) + micro)

    assert text(12, packed(2024, 2, 29, 23, 59, 58, 123456)) == '["2024-02-29 23:59:58.123456"]'
    assert text(10, packed(1999, 12, 31, 0, 0, 0, 0)) == '["1999-12-31"]'
    assert text(11, struct.pack("<q", -((100 << 12 | 5 << 6 | 9) << 24))) == '["-100:05:09.000000"]'
    assert text(246, bytes([30, 2]) + bytes([0x80]) + (7).to_bytes(4, "big") * 3 + bytes([25])) == "[7000000007000000007.25]"


@pytest.mark.parametrize("raw", [b"\x00", b"\x0c\xff\xff\xff\xff\xff\xff\x01", b"\x0c\x05abc", b"\x04\x07", b"\x63", b"\x0f\x10\x01a", b"\x02\x01\x00\x07\x00\x02\x00\x00", b"\x00\x01\x00\x0b\x00\xff\x00\x01\x00\x04\x00\x00", b"\x0b" + b"\xff" * 8, b"\x0c\x01\xff"])
def test_what_is_no_json_is_refused_without_its_bytes(raw):
    with pytest.raises(ValueError, match="^(json_malformed|unsupported_json_type)$"):
        binary_json.json_text(raw, binlog._decimal)


def test_columns_of_a_map_are_read_once(monkeypatch):
    types, meta, names, unsigned = [3, 3], b"", ["id", "v"], b"\0"
    m = binlog.table_map(w.table_map_body(1, "s", "t", types, meta, names, unsigned))
    columns = binlog._columns(m)
    monkeypatch.setattr(binlog, "_columns", lambda _: pytest.fail("read again"))
    body = w.rows_body(1, 2, [b"\0" + (5).to_bytes(4, "little") + (6).to_bytes(4, "little")])
    assert [(op, json.loads(after)) for op, _, after in binlog.row_changes(30, body, m, columns)] == [("insert", {"id": 5, "v": 6})]


def test_rows_laid_out_in_tasks_equal_those_of_columns(spark, sf_dir):
    from ledgerline.plans import decode_queries as d

    orders = d._orders(spark, sf_dir).limit(200)
    for r in orders.select("*", d._rows_event().alias("raw")).collect():
        assert d._laid_row(r.o_orderkey, r.o_orderstatus, r.cents, r.day) == bytes(r.raw)
