"""The binary form of JSON columns as JSON text: exact numbers, no lookup outside the value, nothing guessed."""

from __future__ import annotations

import json
import struct
from collections.abc import Callable
from decimal import Decimal

#: Tags of values, and tags of column types that a value may wrap.
SMALL_OBJECT, LARGE_OBJECT, SMALL_ARRAY, LARGE_ARRAY, LITERAL, DOUBLE, STRING, OPAQUE = 0, 1, 2, 3, 4, 11, 12, 15
INTEGERS = {5: "<h", 6: "<H", 7: "<i", 8: "<I", 9: "<q", 10: "<Q"}
LITERALS = ("null", "true", "false")
TIMESTAMP, DATE, TIME, DATETIME, DECIMAL = 7, 10, 11, 12, 246
#: Values that lie in the entry itself, by the size of offsets.
INLINE = {2: (LITERAL, 5, 6), 4: (LITERAL, 5, 6, 7, 8)}
#: Deeper values are refused, as no server stores them.
DEEPEST = 100


def json_text(doc: bytes, decimal: Callable[[bytes, int, int, int], tuple[str, int]]) -> str:
    """The JSON text of a column's bytes, of which none are `null`. decimal reads a packed decimal (bytes, place, precision,
    scale). A wrapped decimal becomes a number with all its digits, a wrapped date or time a string. ValueError, without a
    byte of the value, for other wrapped types and for whatever doesn't lie within the bytes."""
    if not doc:
        return "null"
    try:
        return _value(doc[0], doc, 1, decimal, 0, [len(doc)])
    except (IndexError, struct.error, UnicodeDecodeError):
        raise ValueError("json_malformed") from None


def _length(b: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        byte, at = b[at], at + 1
        out |= (byte & 0x7F) << shift
        shift += 7
        if not byte & 0x80:
            return out, at
        if shift > 35:
            raise ValueError("json_malformed")


def _slice(b: bytes, at: int, n: int) -> bytes:
    if at + n > len(b):
        raise ValueError("json_malformed")
    return b[at : at + n]


def _value(tag: int, b: bytes, at: int, decimal: Callable, depth: int, left: list[int]) -> str:
    """left counts the values that the document may still have: each takes a byte, so one read more often is none."""
    left[0] -= 1
    if depth > DEEPEST or left[0] < 0:
        raise ValueError("json_malformed")
    if tag in (SMALL_OBJECT, LARGE_OBJECT, SMALL_ARRAY, LARGE_ARRAY):
        return _container(tag in (SMALL_OBJECT, LARGE_OBJECT), 4 if tag in (LARGE_OBJECT, LARGE_ARRAY) else 2, b, at, decimal, depth, left)
    if tag == LITERAL:
        return LITERALS[b[at]]
    if tag in INTEGERS:
        return str(struct.unpack_from(INTEGERS[tag], b, at)[0])
    if tag == DOUBLE:
        number = struct.unpack_from("<d", b, at)[0]
        if number - number != 0:
            raise ValueError("json_malformed")
        return repr(number)
    if tag == STRING:
        n, at = _length(b, at)
        return json.dumps(_slice(b, at, n).decode("utf-8"))
    if tag != OPAQUE:
        raise ValueError("unsupported_json_type")
    kind = b[at]
    n, at = _length(b, at + 1)
    return _wrapped(kind, _slice(b, at, n), decimal)


def _wrapped(kind: int, raw: bytes, decimal: Callable) -> str:
    if kind == DECIMAL:
        text, end = decimal(raw, 2, raw[0], raw[1])
        if end != len(raw):
            raise ValueError("json_malformed")
        return format(Decimal(text), "f")
    if kind not in (TIMESTAMP, DATE, TIME, DATETIME):
        raise ValueError("unsupported_json_type")
    packed = struct.unpack("<q", raw)[0]
    sign, (clock, micro) = "-" if packed < 0 else "", divmod(abs(packed), 1 << 24)
    ymd, hms = divmod(clock, 1 << 17)
    said = f"{hms >> 12 & 0x3FF if kind != TIME else clock >> 12 & 0x3FF:02}:{hms >> 6 & 63:02}:{hms & 63:02}.{micro:06}"
    if kind == TIME:
        return f'"{sign}{said}"'
    day = f"{(ymd >> 5) // 13:04}-{(ymd >> 5) % 13:02}-{ymd & 31:02}"
    return f'"{day}"' if kind == DATE else f'"{day} {said}"'


def _container(named: bool, width: int, b: bytes, start: int, decimal: Callable, depth: int, left: list[int]) -> str:
    """An object or array: its count and size, entries of keys and values, then what they point at, from its start on."""
    number = "<H" if width == 2 else "<I"
    count, size = (struct.unpack_from(number, b, start + k * width)[0] for k in (0, 1))
    if start + size > len(b):
        raise ValueError("json_malformed")
    own, at, keys = b[start : start + size], 2 * width, []
    for _ in range(count if named else 0):
        offset, n = struct.unpack_from(number, own, at)[0], struct.unpack_from("<H", own, at + width)[0]
        keys.append(json.dumps(_slice(own, offset, n).decode("utf-8")))
        at += width + 2
    values = []
    for _ in range(count):
        tag = own[at]
        place = at + 1 if tag in INLINE[width] else struct.unpack_from(number, own, at + 1)[0]
        values.append(_value(tag, own, place, decimal, depth + 1, left))
        at += 1 + width
    return "{" + ", ".join(f"{k}: {v}" for k, v in zip(keys, values)) + "}" if named else "[" + ", ".join(values) + "]"
