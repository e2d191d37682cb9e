"""What the events of captured files come to, read in one pass in the order of each file.

A pass knows which transaction it is in, which table maps hold, and whether a transaction has reached its end. What it finds
are records: ends, steps of two-phase transactions, changes, faults, and the events of a transaction that is still open.
Files that come whole are read as they are. Events that come one by one are sorted within spans of SPAN events of a file, and
a file of several spans has a row for each that carries what came before.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.ordered import ROWS
from ledgerline.operators.assemble import TERMINATORS
from ledgerline.sources import binlog
from ledgerline.sources.binlog import CHECKSUM, HEADER, INNER_BITS, MAGIC
from ledgerline.sources.scratch import stored

#: Events of a file that one task reads in order.
SPAN = ROWS
#: Records that are handed on at once.
TOGETHER = 1 << 14

#: An event as it waits for the end of its transaction.
EVENT = "file string, seq bigint, inner bigint, type int, timestamp bigint, server_id bigint, log_pos bigint, flags int, body binary"
#: Kinds: fault (reason), mark (verb: the event's kind), done (the end of a transaction in one phase), ddl (schema, after: the
#: statement), xa_prepare and xa_resolve (digest, verb), change, and open (the event). reason tells what a change can't be read for.
RECORDS = (
    "file string, seq bigint, inner bigint, kind string, txn_ix bigint, gtid string, timestamp bigint, digest string, verb string, change_ix int, schema string, table string, "
    "op string, before string, after string, reason string, type int, server_id bigint, log_pos bigint, flags int, body binary"
)
_TYPES = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
_FIELDS = [(c.split()[0], _TYPES[c.split()[1]]) for c in RECORDS.split(", ")]

_HEAD = struct.Struct("<IBIIIH")
_PREPARE = struct.Struct("<BIII")
_ONE, _TWO = struct.Struct("<I"), struct.Struct("<II")
_RESOLUTION = re.compile(r"XA (COMMIT|ROLLBACK) +X'((?:[0-9a-fA-F]{2})*+)' *, *X'((?:[0-9a-fA-F]{2})*+)' *, *([0-9]{1,10})(?: +ONE PHASE)?(?:\r\n|[\n\r\x85\u2028\u2029])?\Z")
_ENDS = frozenset(TERMINATORS)
_NONE = (None,) * 12
_AT_ONCE = ("xid", "commit", "ddl")
_PLAIN = {t: "other" for t in binlog.KNOWN} | {t: "rows" for t in binlog.ROW_EVENTS} | {binlog.XID: "xid", binlog.TABLE_MAP: "table_map"}

#: A file's number of transactions, the id of the last and where it begins, whether it has begun, ended, and ended in one phase.
State = tuple[int, str | None, tuple[int, int] | None, bool, bool, bool]
START: State = (0, None, None, False, False, False)


def digest_of(format_id: int, gtrid: bytes, bqual: bytes) -> str:
    """delivery.xid_digest() of one id."""
    if format_id >> 32:
        format_id = int(f"{format_id:X}"[:8], 16)
    return hashlib.sha256(b"".join((b"xa.v1", _TWO.pack(format_id, len(gtrid)), gtrid, _ONE.pack(len(bqual)), bqual))).hexdigest()


@lru_cache(1 << 12)
def _source(sid: bytes) -> str:
    text = sid.hex()
    return f"{text[:8]}-{text[8:12]}-{text[12:16]}-{text[16:20]}-{text[20:]}"


def told(kind: int, body: bytes) -> tuple[str, object]:
    """An event's part in a transaction, and what it says: an id, (schema, text) of a statement, or (verb, digest) of a step.

    A prepare in one phase commits; a statement that ends a prepared transaction resolves it.
    """
    if kind == binlog.GTID:
        return "gtid", f"{_source(body[1:17])}:{int.from_bytes(body[17:24], 'little')}"
    if kind == binlog.QUERY:
        return _statement(body)
    if kind == binlog.XA_PREPARE:
        if len(body) < 13:
            return "malformed", None
        one_phase, format_id, n, m = _PREPARE.unpack_from(body)
        if len(body) != 13 + n + m:
            return "malformed", None
        return ("commit", None) if one_phase == 1 else ("xa_prepare", ("prepare", digest_of(format_id, body[13 : 13 + n], body[13 + n :])))
    return _PLAIN.get(kind, "unknown"), None


def _statement(body: bytes) -> tuple[str, object]:
    if len(body) < 13:
        return "statement", (None, None)
    at = 13 + int.from_bytes(body[11:13], "little")
    try:
        schema, sql = body[at : at + body[8]].decode(), body[at + body[8] + 1 :].decode()
    except UnicodeDecodeError:
        raise ValueError("statement_malformed") from None
    text = sql.strip(" ")
    if found := _RESOLUTION.match(text):
        verb, gtrid, bqual, format_id = found.groups()
        return "xa_resolve", (verb.lower(), digest_of(int(format_id), bytes.fromhex(gtrid), bytes.fromhex(bqual)))
    text = text.upper()
    return "commit" if text == "COMMIT" else "begin" if text == "BEGIN" or text.startswith("XA ") else "statement", (schema, sql)


class Reader:
    """Takes the events of a file in order and keeps the records in `out`. A transaction's events wait until its end is seen,
    as only then its rows are read; carried, if given, says where the open transaction of a file of several spans begins."""

    def __init__(self, tables: list[tuple[str, str]] | None) -> None:
        self.tables = None if tables is None else {tuple(t) for t in tables}
        self.known: dict[bytes, tuple] = {}
        self.out: list[tuple] = []

    def begin(self, file: str, carried: dict | None = None) -> None:
        self.file, self.waiting = file, []
        self.long = carried is not None
        self.ix, self.gtid, self.at, self.begun, self.ended, self.once = carried["state"] if carried else START
        self.maps = {bytes.fromhex(m[:12]): bytes.fromhex(m) for m in carried["maps"]} if carried else {}
        self.open_from = tuple(carried["open"]) if carried and carried["open"] else None

    def put(self, kind: str, seq: int, inner: int, at: int | None = None, digest=None, verb=None, change_ix=None, schema=None, table=None, op=None, before=None, after=None, reason=None, event=(None,) * 5) -> None:
        self.out.append((self.file, seq, inner, kind, self.ix, self.gtid, at, digest, verb, change_ix, schema, table, op, before, after, reason, *event))

    def batch(self) -> pa.RecordBatch:
        out, self.out = self.out, []
        return binlog._batch(out, *_FIELDS)

    def fault(self, seq: int, reason: str) -> None:
        self.put("fault", seq, 0, reason=reason)

    def take(self, seq: int, inner: int, event: tuple) -> None:
        """event: type, time, server, place in the log, flags, body."""
        kind, said = told(event[0], event[5])
        if kind in ("unknown", "malformed"):
            self.put("fault", seq, inner, reason="unknown_event_type" if kind == "unknown" else "xa_prepare_malformed")
            return
        if kind == "statement":  # before its transaction began it commits itself
            kind = "marker" if self.begun else "ddl"
        ends = kind in _ENDS
        if self.long and (ends or kind in ("gtid", "rows")):
            self.put("mark", seq, inner, verb=kind)
        elif kind == "gtid":
            if self.ix and not self.ended:
                self.put("fault", seq, inner, reason="gtid_within_open_transaction")
        elif (ends or kind == "rows") and (self.ended or not self.ix):
            self.put("fault", seq, inner, reason="terminator_without_transaction" if ends else "rows_without_transaction")
        if kind == "gtid":
            self._read_waiting()
            self.ix, self.gtid, self.begun, self.ended, self.once = self.ix + 1, said, False, False, False
        elif kind == "begin":
            self.begun = True
        if self.long:
            if self.open_from is not None and (seq, inner) >= self.open_from:
                self._open(seq, inner, event)
            else:
                self._read(seq, inner, kind, said, event)
        elif self.ix and not self.ended:
            self.waiting.append((seq, inner, kind, said, event))
            if ends:
                self._read_waiting()
        else:
            self._read(seq, inner, kind, said, event)
        self.ended = self.ended or ends

    def end(self) -> None:
        """What waits now is open."""
        for seq, inner, _, _, event in self.waiting:
            self._open(seq, inner, event)
        self.waiting = []

    def _open(self, seq: int, inner: int, event: tuple) -> None:
        kind, at, server, log_pos, flags, body = event
        self.out.append((self.file, seq, inner, "open", None, None, at, *_NONE[:9], kind, server, log_pos, flags, body))

    def _read_waiting(self) -> None:
        waiting, self.waiting = self.waiting, []
        for x in waiting:
            self._read(*x)

    def _read(self, seq: int, inner: int, kind: str, said: object, event: tuple) -> None:
        if kind == "rows":
            if self.ix:
                self._rows(seq, inner, event)
        elif kind == "table_map":
            self.maps[event[5][:6]] = event[5]
        elif event[0] in (binlog.ROTATE, binlog.FORMAT):
            self.maps = {}
        elif kind in _AT_ONCE:
            if self.ix and not self.once:
                self.put("done", seq, inner, event[1])
                self.once = True
            if self.ix and kind == "ddl":
                self.put("ddl", seq, inner, event[1], schema=said[0], after=said[1])
        elif kind in ("xa_prepare", "xa_resolve") and self.ix:
            self.out.append((self.file, seq, inner, kind, self.ix, self.gtid, event[1], said[1], said[0], *_NONE[:12]))

    def _rows(self, seq: int, inner: int, event: tuple) -> None:
        body = event[5]
        if (told_by := self.maps.get(body[:6])) is None:
            self.put("change", seq, inner, reason="unmapped_table_id")
            return
        if (known := self.known.get(told_by)) is None:
            if len(self.known) > 10_000:
                self.known.clear()
            known = self.known[told_by] = self._map(told_by)
        m, columns, reason = known
        if m is None:
            return
        if reason is None:
            try:
                for i, (op, before, after) in enumerate(binlog.row_changes(event[0], body, m, columns)):
                    self.out.append((self.file, seq, inner, "change", self.ix, self.gtid, None, None, None, i, m["schema"], m["table"], op, before, after, *_NONE[:6]))
                return
            except Exception as fault:
                reason = _code(fault)
        self.put("change", seq, inner, schema=m["schema"], table=m["table"], reason=reason)

    def _map(self, body: bytes) -> tuple:
        """The map, its columns, and why they can't be read; no map for a table that isn't listed."""
        m = binlog.table_map(body)
        if self.tables is not None and (m["schema"], m["table"]) not in self.tables:
            return None, None, None
        try:
            return m, binlog._columns(m), None
        except Exception as fault:
            return m, None, _code(fault)


def _code(fault: Exception) -> str:
    """A fault's own code, which holds no value of a row."""
    text = str(fault)
    return text if type(fault) is ValueError and re.fullmatch("[a-z_]+", text) else "row_image_malformed"


def _feed(to: Reader | Head, seq: int, raw: bytes | None) -> None:
    """Hands on a raw event, or those in its payload, or its fault."""
    if seq >= 1 << INNER_BITS:
        raise ValueError("too_many_events")
    n = len(raw or b"")
    if n < HEADER + CHECKSUM:
        to.fault(seq, "truncated")
        return
    at, kind, server, size, log_pos, flags = _HEAD.unpack_from(raw)
    if n != size:
        to.fault(seq, "truncated")
    elif zlib.crc32(raw[:-CHECKSUM]) != int.from_bytes(raw[-CHECKSUM:], "little"):
        to.fault(seq, "crc_mismatch")
    elif kind == binlog.PAYLOAD:
        for k, e in enumerate(binlog.inner_events(raw[HEADER:-CHECKSUM])):
            if k >= 1 << INNER_BITS:
                raise ValueError("too_many_events")
            to.take(seq, k, (e["type"], e["timestamp"], e["server_id"], log_pos, e["flags"], e["body"]))
    else:
        to.take(seq, 0, (kind, at, server, log_pos, flags, raw[HEADER:-CHECKSUM]))


def file_records(files: DataFrame, tables: list[tuple[str, str]] | None = None) -> DataFrame:
    """The records of captured files (path, content), without events that are open."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(tables)
        for batch in batches:
            for path, content in zip(binlog.values(batch.column("path")), binlog.values(batch.column("content"))):
                reader.begin(path)
                for seq, raw in enumerate(binlog.raw_events(content)):
                    _feed(reader, seq, raw)
                    if len(reader.out) >= TOGETHER:
                        yield reader.batch()
        yield reader.batch()

    return files.select("path", "content").mapInArrow(read, RECORDS)


def to_read(raw: DataFrame, open_: DataFrame | None = None) -> DataFrame:
    """Raw events (file, seq, raw) and those that were left open (EVENT), as event_records() reads them."""
    names = [c.split()[0] for c in EVENT.split(", ")]
    rows = raw.select("file", "seq", "raw")
    return rows.unionByName((open_ if open_ is not None else raw.sparkSession.createDataFrame([], EVENT)).select(names), allowMissingColumns=True).select("raw", *names)


def event_records(events: DataFrame, tables: list[tuple[str, str]] | None = None) -> DataFrame:
    """The records of events as to_read() has them. Each file begins with its first event; what is still open at its last
    event comes as it is."""
    cut = events.withColumn("_span", F.floor(F.col("seq") / SPAN))
    names = [c.split()[0] for c in EVENT.split(", ")][3:]
    long_files = stored(cut.groupBy("file").agg(F.min("_span").alias("_a"), F.max("_span").alias("_b")).where("_a <> _b").select("file"), "records-long")
    rows = cut.withColumn("_carried", F.lit(None).cast("string"))
    if not long_files.isEmpty():
        carried = _carried(cut.join(long_files, "file", "left_semi").select(*cut.columns))
        rows = rows.unionByName(carried, allowMissingColumns=True)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now = Reader(tables), None
        for batch in batches:
            for file, span, seq, inner, raw, held, *event in zip(*[binlog.values(c, -1) for c in batch.columns]):
                if (file, span) != now:
                    if now is not None:
                        reader.end()
                    reader.begin(file, held and json.loads(held))
                    now = (file, span)
                if held is None and event[0] < 0:
                    _feed(reader, seq, raw)
                elif held is None:
                    reader.take(seq, inner, tuple(event))
                if len(reader.out) >= TOGETHER:
                    yield reader.batch()
        if now is not None:
            reader.end()
        yield reader.batch()

    return _in_order(rows, "_carried", *names).mapInArrow(read, RECORDS)


def _in_order(rows: DataFrame, *more: str) -> DataFrame:
    """Spans of files, each in one task and in order; a row without a number comes first."""
    order = rows.repartition("file", "_span").sortWithinPartitions("file", "_span", "seq", "inner")
    return order.select("file", "_span", "seq", "inner", "raw", *more)


def _carried(events: DataFrame) -> DataFrame:
    """(file, _span, _carried): the state at the beginning of each span of a file, the table maps that hold there, and where
    the transaction begins that is still open at the file's last event; as JSON."""
    names = [c.split()[0] for c in EVENT.split(", ")][3:]

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, head = None, None
        for batch in batches:
            for file, span, seq, inner, raw, *event in zip(*[binlog.values(c, -1) for c in batch.columns]):
                if (file, span) != now:
                    if now is not None:
                        yield _head_batch(now, head)
                    now, head = (file, span), Head()
                if event[0] < 0:
                    _feed(head, seq, raw)
                else:
                    head.take(seq, inner, tuple(event))
        if now is not None:
            yield _head_batch(now, head)

    def fold(part: pa.Table) -> pa.Table:
        rows = sorted(zip(*[part.column(c).to_pylist() for c in ("file", "_span", "_head")]), key=lambda r: r[1])
        state, maps, out = START, {}, []
        for _, span, text in rows:
            out.append((span, state, list(maps.values())))
            head = json.loads(text)
            state = _after(state, head)
            maps = ({} if head["reset"] else maps) | {m[:12]: m for m in head["maps"]}
        open_ = state[2] if state[0] and not state[4] else None
        return pa.table({"file": [r[0] for r in rows], "_span": [s for s, _, _ in out], "_carried": [json.dumps({"state": s, "maps": m, "open": open_}) for _, s, m in out]})

    told_heads = _in_order(events, *names).mapInArrow(heads, "file string, _span bigint, _head string")
    return told_heads.groupBy("file").applyInArrow(fold, "file string, _span bigint, _carried string")


class Head:
    """What a span does to the state before it, which it doesn't know."""

    def __init__(self) -> None:
        self.n, self.gtid, self.at, self.begun, self.ended, self.once, self.said, self.reset, self.maps = 0, None, None, False, False, False, False, False, {}

    def fault(self, seq: int, reason: str) -> None:
        """Faults count for nothing else."""

    def take(self, seq: int, inner: int, event: tuple) -> None:
        kind, said = told(event[0], event[5])
        if kind == "gtid":
            self.n, self.gtid, self.at, self.begun, self.ended, self.once = self.n + 1, said, (seq, inner), False, False, False
        elif kind == "begin":
            self.begun = True
        elif kind == "statement" and not self.begun:
            if self.n:
                self.ended = self.once = True
            else:
                self.said = True  # commits itself unless its transaction began in an earlier span
        elif kind == "table_map":
            self.maps[event[5][:6]] = event[5]
        elif event[0] in (binlog.ROTATE, binlog.FORMAT):
            self.reset, self.maps = True, {}
        self.ended = self.ended or kind in _ENDS
        self.once = self.once or kind in _AT_ONCE


def _head_batch(now: tuple[str, int], head: Head) -> pa.RecordBatch:
    text = json.dumps({**vars(head), "maps": [m.hex() for m in head.maps.values()]})
    return pa.RecordBatch.from_pydict({"file": pa.array([now[0]], pa.string()), "_span": pa.array([now[1]], pa.int64()), "_head": pa.array([text], pa.string())})


def _after(state: State, head: dict) -> State:
    ix, gtid, at, begun, ended, once = state
    if head["n"]:
        return ix + head["n"], head["gtid"], tuple(head["at"]), head["begun"], head["ended"], head["once"]
    itself = head["said"] and not begun
    return ix, gtid, at, begun or head["begun"], ended or head["ended"] or itself, once or head["once"] or itself
