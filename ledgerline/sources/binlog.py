"""Captured binary logs as DataFrames: events, checked and decoded; compressed payloads; row images as changes.

Headers and checksums are read in one Arrow pass over the bytes, which opens compressed payloads as well. Transaction ids and
statements are column expressions; table maps and row images, which have no fixed layout, are read after the table filter.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.ordered import DENSE, asof_backward, running_total
from ledgerline.sources.binary_json import json_text

#: The file's magic, event types, and header and checksum sizes.
MAGIC = b"\xfebin"
QUERY, ROTATE, FORMAT, XID, TABLE_MAP, ROWS_QUERY, GTID, XA_PREPARE, PAYLOAD = 2, 4, 15, 16, 19, 29, 33, 38, 40
ROW_EVENTS = {30: "insert", 31: "update", 32: "delete"}
#: Events that are passed over (stop, heartbeat, statement texts, earlier ids); all others are refused.
PASSED = (3, 27, ROWS_QUERY, 35)
KNOWN = (QUERY, ROTATE, FORMAT, XID, TABLE_MAP, GTID, XA_PREPARE, PAYLOAD, *ROW_EVENTS, *PASSED)
HEADER, CHECKSUM = 19, 4
_SIZE = struct.Struct("<I")
#: A payload may inflate to so many bytes.
MOST_INFLATED = 1 << 30

#: An event's place in its file: its own, or that of its payload, above its place in the payload.
INNER_BITS = 31
ORDER_SPAN = DENSE << INNER_BITS

EVENT_SCHEMA = "file string, seq bigint, raw binary"


def little(body: Column, at: Column | int, n: int) -> Column:
    """The unsigned number in n bytes, lowest first, from the 1-based place `at`; n up to 7."""
    at = F.lit(at) if isinstance(at, int) else at
    digits = F.hex(F.substring(body, at, F.lit(n)))
    return F.conv(F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(n))]), 16, 10).cast("bigint")


def raw_events(content: bytes) -> Iterator[bytes]:
    """The bytes of each event of a captured file, in order."""
    at = len(MAGIC) if content.startswith(MAGIC) else 0
    while at < len(content):
        whole = at + HEADER <= len(content)
        size = max(_SIZE.unpack_from(content, at + 9)[0], HEADER) if whole else len(content) - at
        yield content[at : at + size]
        at += size


def split_events(files: DataFrame) -> DataFrame:
    """(file, seq, raw) of each event of captured files (path, content), in file order. A cut last event comes as it is."""

    def events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = [(path, k, raw) for k, raw in enumerate(raw_events(content))]
                yield _batch(rows, ("file", pa.string()), ("seq", pa.int64()), ("raw", pa.binary()))

    return files.select("path", "content").mapInArrow(events, EVENT_SCHEMA)


def values(column: pa.Array, absent: int | None = None) -> list:
    """to_pylist() without an object a value where that can be had. absent, if given, stands for null numbers."""
    if column.null_count and pa.types.is_integer(column.type):
        if absent is None:
            return column.to_pylist()
        column = column.fill_null(absent)
    return column.to_numpy(zero_copy_only=False).tolist()


def _batch(rows: list[tuple], *fields: tuple[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


HEADERS = "file string, seq bigint, fault string, type int, timestamp bigint, server_id bigint, log_pos bigint, flags int, body binary"
_HEADER_FIELDS = np.dtype([("timestamp", "<u4"), ("type", "u1"), ("server_id", "<u4"), ("size", "<u4"), ("log_pos", "<u4"), ("flags", "<u2")])
_HEADER_COLUMNS = (("type", pa.int32()), ("timestamp", pa.int64()), ("server_id", pa.int64()), ("log_pos", pa.int64()), ("flags", pa.int32()))


def _headers(raws: pa.Array) -> tuple[list, dict[str, np.ndarray], list]:
    """Fault, header fields and body of each event of a batch; the fields of an event that is cut within its header are 0."""
    events = raws.to_pylist()
    empty = bytes(HEADER)
    fields = np.frombuffer(b"".join(e[:HEADER] if e is not None and len(e) >= HEADER else empty for e in events), dtype=_HEADER_FIELDS)
    faults, bodies = [], []
    for e, size in zip(events, fields["size"].tolist()):
        n = len(e or b"")
        whole = n >= HEADER + CHECKSUM and n == size
        faults.append("truncated" if not whole else None if zlib.crc32(memoryview(e)[:-CHECKSUM]) == int.from_bytes(e[-CHECKSUM:], "little") else "crc_mismatch")
        bodies.append((e or b"")[HEADER:-CHECKSUM])
    return faults, {c: fields[c] for c, _ in _HEADER_COLUMNS}, bodies


def parse_headers(events: DataFrame) -> DataFrame:
    """(file, seq), the header's fields, body, and fault: null, truncated or crc_mismatch."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            faults, fields, bodies = _headers(batch.column(2))
            columns = [*batch.columns[:2], pa.array(faults, pa.string()), *[pa.array(fields[c].astype(np.int64)).cast(t) for c, t in _HEADER_COLUMNS], pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "seq", "fault", *[c for c, _ in _HEADER_COLUMNS], "body"])

    return events.select("file", "seq", "raw").mapInArrow(parsed, HEADERS)


def open_events(events: DataFrame) -> DataFrame:
    """parse_headers() with each compressed payload replaced by the events in it, which have their place in it as `inner`."""
    names = ["file", "seq", "fault", *[c for c, _ in _HEADER_COLUMNS], "body"]

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            faults, fields, bodies = _headers(batch.column(2))
            at, added = list(range(len(faults))), {c: [] for c in ("at", "body", "inner", *fields)}
            for i in np.flatnonzero(fields["type"] == PAYLOAD).tolist():
                if faults[i] is None:
                    at[i] = -1
                    for k, r in enumerate(inner_events(bodies[i])):
                        for c, v in (("at", i), ("inner", k), ("log_pos", fields["log_pos"][i]), *r.items()):
                            added[c].append(v)
            keep = pa.array([i for i in at if i >= 0] + added["at"], pa.int64())
            plain = [i for i in at if i >= 0]
            columns = [batch.column(0).take(keep), batch.column(1).take(keep), pa.array([faults[i] for i in plain] + [None] * len(added["at"]), pa.string())]
            columns += [pa.array(np.concatenate([fields[c][plain].astype(np.int64), np.array(added[c], dtype=np.int64)])).cast(t) for c, t in _HEADER_COLUMNS]
            columns += [pa.array([bodies[i] for i in plain] + added["body"], pa.binary()), pa.array([0] * len(plain) + added["inner"], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "inner"])

    return events.select("file", "seq", "raw").mapInArrow(opened, f"{HEADERS}, inner bigint")


def gtid_of(body: Column) -> Column:
    """`uuid:number` of a transaction-id event."""
    sid = F.lower(F.hex(F.substring(body, 2, 16)))
    parts = [F.substring(sid, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws(":", F.concat_ws("-", *parts), little(body, 18, 7).cast("string"))


def statement_of(body: Column) -> Column:
    """struct(schema, sql) of a statement event."""
    schema_len, vars_len = little(body, 9, 1), little(body, 12, 2)
    start = F.lit(14) + vars_len
    return F.struct(
        F.decode(F.substring(body, start.cast("int"), schema_len.cast("int")), "UTF-8").alias("schema"),
        F.decode(F.substring(body, (start + schema_len + 1).cast("int"), F.length(body)), "UTF-8").alias("sql"),
    )


def place() -> Column:
    """Where an event stands in its file, as one number; a file or a payload of 2^31 events or more is refused."""
    fits = (F.col("seq") < 1 << INNER_BITS) & (F.col("inner") < 1 << INNER_BITS)
    return F.when(fits, F.shiftleft(F.col("seq"), INNER_BITS) + F.col("inner")).otherwise(F.raise_error(F.lit("too_many_events")).cast("bigint"))


def resolution_of(sql: Column) -> Column:
    """struct(verb, format_id, gtrid, bqual) of the statement that ends a prepared transaction; null for any other text."""
    text = F.trim(sql)
    pattern = r"^XA (COMMIT|ROLLBACK) +X'((?:[0-9a-fA-F]{2})*+)' *, *X'((?:[0-9a-fA-F]{2})*+)' *, *([0-9]{1,10})(?: +ONE PHASE)?$"
    part = [F.regexp_extract(text, pattern, k) for k in (1, 2, 3, 4)]
    return F.when(part[0] != "", F.struct(F.lower(part[0]).alias("verb"), part[3].cast("bigint").alias("format_id"), F.unhex(part[1]).alias("gtrid"), F.unhex(part[2]).alias("bqual")))


def inflate(payload: bytes) -> bytes:
    """The bytes of a compressed-payload body; ValueError with a reason that holds none of them."""
    at, fields = 0, {}
    while True:
        if at >= len(payload):
            raise ValueError("missing_end_mark")
        kind, at = payload[at], at + 1
        if kind == 0:
            break
        size, at = _packed(payload, at)
        fields[kind], at = _packed(payload[at : at + size], 0)[0], at + size
    if 1 not in fields:
        raise ValueError("missing_payload_size")
    if fields.get(2) != 0:
        raise ValueError("missing_compression_type" if 2 not in fields else "unsupported_payload_compression")
    if at + fields[1] != len(payload):
        raise ValueError("payload_size_exceeded" if at + fields[1] > len(payload) else "payload_trailing_bytes")
    if fields.get(3, 0) > MOST_INFLATED:
        raise ValueError("payload_too_large")
    out = bytearray()
    reader = zstandard.ZstdDecompressor().stream_reader(payload[at:])  # in bounded reads: a declared size can't be trusted
    while part := reader.read(1 << 20):
        out += part
        if len(out) > MOST_INFLATED:
            raise ValueError("payload_too_large")
    if 3 in fields and fields[3] != len(out):
        raise ValueError("uncompressed_size_mismatch")
    return bytes(out)


def inner_events(body: bytes) -> Iterator[dict]:
    """The events in a compressed payload: header fields but the log position, and body; they carry no checksums."""
    inner, at = inflate(body), 0
    while at < len(inner):
        if at + HEADER > len(inner):
            raise ValueError("inner_event_truncated")
        ts, kind, server, size, _, flags = struct.unpack_from("<IBIIIH", inner, at)
        if size < HEADER or at + size > len(inner):
            raise ValueError("inner_event_malformed" if size < HEADER else "inner_event_truncated")
        if kind == PAYLOAD:
            raise ValueError("nested_payload_unsupported")
        yield {"type": kind, "timestamp": ts, "server_id": server, "flags": flags, "body": inner[at + HEADER : at + size]}
        at += size


def _packed(b: bytes, at: int) -> tuple[int, int]:
    """A length-encoded number and the place after it."""
    first = b[at]
    n = {252: 2, 253: 3, 254: 8}.get(first, 0)
    return (int.from_bytes(b[at + 1 : at + 1 + n], "little") if n else first), at + 1 + n


def _text(b: bytes, at: int) -> tuple[bytes, int]:
    size, at = _packed(b, at)
    return b[at : at + size], at + size


def table_map(body: bytes) -> dict:
    """Names, types and what else of a table map the row images need."""
    at = 8
    size = body[at]
    schema, at = body[at + 1 : at + 1 + size].decode(), at + size + 2
    size = body[at]
    table, at = body[at + 1 : at + 1 + size].decode(), at + size + 2
    n, at = _packed(body, at)
    types, at = list(body[at : at + n]), at + n
    meta, at = _text(body, at)
    at += (n + 7) // 8
    out = {"schema": schema, "table": table, "types": types, "meta": meta.hex(), "unsigned": "", "names": [], "sets": [], "enums": []}
    while at < len(body):
        kind, (value, at) = body[at], _text(body, at + 1)
        if kind == 1:
            out["unsigned"] = value.hex()
        elif kind == 4:
            pos = 0
            while pos < len(value):
                name, pos = _text(value, pos)
                out["names"].append(name.decode())
        elif kind in (5, 6):
            pos, lists = 0, []
            while pos < len(value):
                count, pos = _packed(value, pos)
                members = []
                for _ in range(count):
                    member, pos = _text(value, pos)
                    members.append(member.decode())
                lists.append(members)
            out["sets" if kind == 5 else "enums"] = lists
    return out


def _columns(m: dict) -> list[tuple]:
    """The name as it stands in JSON, and what reads a value, of each column."""
    meta, at, out, sets, enums, numeric = bytes.fromhex(m["meta"]), 0, [], iter(m["sets"]), iter(m["enums"]), 0
    unsigned = bytes.fromhex(m["unsigned"])
    if len(m["names"]) != len(m["types"]):
        raise ValueError("missing_column_names")
    for name, t in zip(m["names"], m["types"]):
        args: tuple = ()
        if t in (1, 2, 3, 8, 9, 246):
            if numeric // 8 >= len(unsigned):
                raise ValueError("missing_signedness")
            signed = not unsigned[numeric // 8] >> (7 - numeric % 8) & 1
            numeric += 1
            kind, args = ("decimal", (meta[at], meta[at + 1])) if t == 246 else ("int", ({1: 1, 2: 2, 9: 3, 3: 4, 8: 8}[t], signed))
            at += 2 * (t == 246)
        elif t == 10:
            kind = "date"
        elif t in (15, 253):
            kind, args, at = "text", (1 + (int.from_bytes(meta[at : at + 2], "little") > 255),), at + 2
        elif t == 254:
            a, b = meta[at], meta[at + 1]
            real, size = (a | 0x30, b | ((a & 0x30) ^ 0x30) << 4) if a & 0x30 != 0x30 else (a, b)
            kind, args = ("enum", (size, next(enums))) if real == 247 else ("set", (size, next(sets))) if real == 248 else ("text", (1 + (size > 255),))
            at += 2
        elif t in (252, 245, 255):
            kind, args, at = {252: "text", 245: "json", 255: "bytes"}[t], (meta[at],), at + 1
        elif t in (17, 18, 19):
            kind, args, at = {17: "timestamp", 18: "datetime", 19: "time"}[t], (meta[at],), at + 1
        else:
            raise ValueError("unsupported_column_type")  # its width is unknown, so nothing after it can be read
        out.append((f"{json.dumps(name)}: ", _reading(kind, args)))
    return out


#: Bytes that 0 to 9 left-over digits of a packed decimal take.
DIGIT_BYTES = (0, 1, 1, 2, 2, 3, 3, 4, 4, 4)


def _decimal(b: bytes, at: int, precision: int, scale: int) -> tuple[str, int]:
    whole, part = divmod(precision - scale, 9), divmod(scale, 9)
    groups = [(DIGIT_BYTES[whole[1]], whole[1])] + [(4, 9)] * (whole[0] + part[0]) + [(DIGIT_BYTES[part[1]], part[1])]
    size = sum(n for n, _ in groups)
    buf = bytearray(b[at : at + size])
    negative = not buf[0] & 0x80
    buf[0] ^= 0x80
    if negative:
        buf = bytearray(x ^ 0xFF for x in buf)
    number, pos = 0, 0
    for n, digits in groups:
        number = number * 10**digits + int.from_bytes(buf[pos : pos + n], "big")
        pos += n
    return str(decimal.Decimal(-number if negative else number).scaleb(-scale)), at + size


def _fraction(b: bytes, at: int, fsp: int) -> tuple[int, int]:
    n = (fsp + 1) // 2
    return int.from_bytes(b[at : at + n], "big") * 100 ** (3 - n), at + n


class _Json(str):
    """JSON text that is a value as it stands."""


def _reading(kind: str, args: tuple) -> Callable[[bytes, int], tuple[str, int]]:
    """What reads a value of a column at a place: as JSON, and the place after it. The kinds that most columns have come first."""
    if kind == "int":
        size, signed = args
        return lambda b, at: (repr(int.from_bytes(b[at : at + size], "little", signed=signed)), at + size)
    quote = json.encoder.encode_basestring_ascii
    if kind == "text":
        wide = args[0]

        def text(b: bytes, at: int) -> tuple[str, int]:
            start = at + wide
            end = start + int.from_bytes(b[at:start], "little")
            return quote(b[start:end].decode("utf-8", "backslashreplace")), end

        return text

    def any_(b: bytes, at: int) -> tuple[str, int]:
        value, at = _value(b, at, kind, args)
        return value if isinstance(value, _Json) else json.dumps(value), at

    return any_


def _value(b: bytes, at: int, kind: str, args: tuple) -> tuple[object, int]:
    if kind == "decimal":
        return _decimal(b, at, *args)
    if kind in ("bytes", "json"):
        size, at = int.from_bytes(b[at : at + args[0]], "little"), at + args[0]
        value = b[at : at + size]
        if kind == "json":
            return _Json(json_text(value, _decimal)), at + size
        return value.hex(), at + size
    if kind in ("enum", "set"):
        size, members = args
        n, at = int.from_bytes(b[at : at + size], "little"), at + size
        if kind == "enum":
            if n > len(members):
                raise ValueError("enum_index_out_of_range")
            return ("", *members)[n], at
        if n >> len(members):
            raise ValueError("set_member_out_of_range")
        return ",".join(m for i, m in enumerate(members) if n >> i & 1), at
    if kind == "date":
        n = int.from_bytes(b[at : at + 3], "little")
        return dt.date(n >> 9, n >> 5 & 15, n & 31).isoformat(), at + 3
    if kind == "datetime":
        n = int.from_bytes(b[at : at + 5], "big") - 0x8000000000
        micro, at = _fraction(b, at + 5, args[0])
        day, clock = n >> 17, n & 0x1FFFF
        return dt.datetime((day >> 5) // 13, (day >> 5) % 13, day & 31, clock >> 12, clock >> 6 & 63, clock & 63, micro).isoformat(" "), at
    if kind == "timestamp":
        seconds = int.from_bytes(b[at : at + 4], "big")
        micro, at = _fraction(b, at + 4, args[0])
        return (dt.datetime.fromtimestamp(seconds, dt.timezone.utc) + dt.timedelta(microseconds=micro)).isoformat(" "), at
    n = int.from_bytes(b[at : at + 3], "big") - 0x800000
    micro, at = _fraction(b, at + 3, args[0])
    return dt.time(n >> 12, n >> 6 & 63, n & 63, micro).isoformat(), at


def row_changes(kind: int, body: bytes, m: dict, columns: list[tuple] | None = None) -> list[tuple[str, str | None, str | None]]:
    """(op, before, after) of each row of a row event, images as JSON objects; absent columns are left out.
    columns, if given, are the map's, read before."""
    op, at = ROW_EVENTS[kind], 8 + int.from_bytes(body[8:10], "little")
    n, at = _packed(body, at)
    width, columns = (n + 7) // 8, columns or _columns(m)
    masks = []
    for _ in range(2 if op == "update" else 1):
        mask = int.from_bytes(body[at : at + width], "little")
        masks.append(columns if not ~mask & (1 << n) - 1 and n == len(columns) else [c for i, c in enumerate(columns) if mask >> i & 1])
        at += width
    images, size = [], len(body)
    while at < size:
        present = masks[len(images) % len(masks)]
        end = at + (len(present) + 7) // 8
        nulls, at = int.from_bytes(body[at:end], "little"), end
        image = []
        for i, (name, read) in enumerate(present):
            if nulls and nulls >> i & 1:
                image.append(name + "null")
            else:
                value, at = read(body, at)
                image.append(name + value)
        images.append("{" + ", ".join(image) + "}")
    if at > size:
        raise ValueError("row_image_malformed")  # it says more than it holds
    if op == "update":
        return [(op, a, b) for a, b in zip(images[::2], images[1::2])]
    return [(op, None, x) if op == "insert" else (op, x, None) for x in images]


CHANGE_SCHEMA = "file string, seq bigint, inner bigint, change_ix int, schema string, table string, op string, before string, after string"


def decode_changes(events: DataFrame, tables: list[tuple[str, str]] | None = None) -> DataFrame:
    """The changes of row events, each read with the last table map of its own table id since the file's last rotation.

    tables, if given, is applied to the table maps, so that the rows of other tables are never decoded. A row event
    without a table map fails the query.
    """
    marked = events.withColumn("_order", place())
    # Which map a row event reads is found on places alone; bodies are joined to it once.
    table_id = F.when(F.col("type").isin(TABLE_MAP, *ROW_EVENTS), little(F.col("body"), 1, 6))
    narrow = marked.where(F.col("type").isin(ROTATE, FORMAT, TABLE_MAP, *ROW_EVENTS)).select("file", "_order", "type", table_id.alias("table_id"))
    numbered = running_total(narrow, ["file"], "_order", F.when(F.col("type").isin(ROTATE, FORMAT), 1).otherwise(0), "epoch", ORDER_SPAN)
    maps = numbered.where(F.col("type") == TABLE_MAP).select("file", "epoch", "table_id", F.col("_order").alias("_map"))
    placed = asof_backward(numbered.where(F.col("type").isin(*ROW_EVENTS)), maps.withColumn("_map_at", F.col("_map")), ["file", "epoch", "table_id"], "_order", "_map", ["_map_at"], ORDER_SPAN).select("file", "_order", "_map_at")
    bodies = marked.where(F.col("type").isin(*ROW_EVENTS)).select("file", "seq", "inner", "type", "body", "_order")
    map_bodies = marked.where(F.col("type") == TABLE_MAP).select("file", F.col("_order").alias("_map_at"), F.col("body").alias("map_body"))
    rows = bodies.join(placed, ["file", "_order"], "left").join(map_bodies, ["file", "_map_at"], "left")
    name_len = little(F.col("map_body"), 9, 1).cast("int")
    schema = F.decode(F.substring("map_body", F.lit(10), name_len), "UTF-8")
    table = F.decode(F.substring("map_body", F.lit(12) + name_len, little(F.col("map_body"), F.lit(11) + name_len, 1).cast("int")), "UTF-8")
    named = rows.withColumns({"schema": schema, "table": table})
    if tables is not None:
        hit = F.col("map_body").isNull()  # fails below
        for s, t in tables:
            hit = hit | ((F.col("schema") == s) & (F.col("table") == t))
        named = named.where(hit)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[dict, list[tuple]]] = {}
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["map_body"] is None:
                    raise ValueError("unmapped_table_id")
                if len(known) > 10_000:
                    known.clear()
                if r["map_body"] not in known:
                    m = table_map(r["map_body"])
                    known[r["map_body"]] = m, _columns(m)
                m, columns = known[r["map_body"]]
                out += [(r["file"], r["seq"], r["inner"], i, m["schema"], m["table"], *c) for i, c in enumerate(row_changes(r["type"], r["body"], m, columns))]
            names = [x.split()[0] for x in CHANGE_SCHEMA.split(", ")]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), *[pa.string()] * 5)
            yield _batch(out, *zip(names, kinds))

    return named.select("file", "seq", "inner", "type", "body", "map_body").mapInArrow(decoded, CHANGE_SCHEMA)
