"""Writes events in the captured layout, for fixtures and round trips."""

from __future__ import annotations

import datetime as dt
import struct
import zlib

import zstandard

from ledgerline.sources.binlog import CHECKSUM, HEADER


def event(kind: int, body: bytes, timestamp: int = 0, server_id: int = 1, log_pos: int = 0, checksum: bool = True) -> bytes:
    size = HEADER + len(body) + (CHECKSUM if checksum else 0)
    raw = struct.pack("<IBIIIH", timestamp, kind, server_id, size, log_pos, 0) + body
    return raw + struct.pack("<I", zlib.crc32(raw)) if checksum else raw


def packed(n: int) -> bytes:
    return bytes([n]) if n < 251 else b"\xfc" + n.to_bytes(2, "little") if n < 1 << 16 else b"\xfd" + n.to_bytes(3, "little") if n < 1 << 24 else b"\xfe" + n.to_bytes(8, "little")


def payload(inner: bytes) -> bytes:
    """The body of a compressed-payload event around events without checksums."""
    frame = zstandard.ZstdCompressor().compress(inner)

    def field(kind: int, value: bytes) -> bytes:
        return bytes([kind]) + packed(len(value)) + value

    return field(2, packed(0)) + field(3, packed(len(inner))) + field(1, packed(len(frame))) + b"\0" + frame


def table_map_body(table_id: int, schema: str, table: str, types: list[int], meta: bytes, names: list[str], unsigned: bytes = b"", sets: list = (), enums: list = ()) -> bytes:
    def name(x: str) -> bytes:
        return bytes([len(x)]) + x.encode() + b"\0"

    def listed(lists) -> bytes:
        return b"".join(packed(len(m)) + b"".join(packed(len(x)) + x.encode() for x in m) for m in lists)

    tlvs = [(1, unsigned), (4, b"".join(packed(len(n)) + n.encode() for n in names)), (5, listed(sets)), (6, listed(enums))]
    extra = b"".join(bytes([k]) + packed(len(v)) + v for k, v in tlvs if v)
    n = len(types)
    return table_id.to_bytes(6, "little") + b"\0\0" + name(schema) + name(table) + packed(n) + bytes(types) + packed(len(meta)) + meta + b"\0" * ((n + 7) // 8) + extra


def rows_body(table_id: int, columns: int, images: list[bytes], update: bool = False) -> bytes:
    """images hold their null bits; every column is present."""
    mask = ((1 << columns) - 1).to_bytes((columns + 7) // 8, "little")
    return table_id.to_bytes(6, "little") + b"\0\0" + b"\x02\0" + packed(columns) + mask * (2 if update else 1) + b"".join(images)


def date_bytes(d: dt.date) -> bytes:
    return (d.year << 9 | d.month << 5 | d.day).to_bytes(3, "little")
