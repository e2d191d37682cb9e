"""Secrets in texts: plain patterns, and keys and tokens that are told by their structure.

A long run of base64 or hex says little, so it is decoded and its structure read before anything is reported: the nested
lengths of a key's encoding must add up to the outermost one, and a token must have a header that names its signature and
a signature of that length. What doesn't parse to its end isn't reported by structure.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from ledgerline.llm.common import arrow_map, schema_with

SPANS = ArrayType(StructType().add("kind", StringType()).add("start", LongType()).add("end", LongType()).add("detail", StringType()))
#: Kinds of spans, in the order that equal starts have: by pattern, then by structure.
BASE = ("assign", "access", "hex")
CONFIRMED = ("der_key", "ssh_key", "pgp_key", "signed_token", "sealed_token")
KINDS = (*BASE, *CONFIRMED)
#: The patterns.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6
#: Candidates. Base64 may run over lines, also over those written as `\n`; a URL's alphabet has no breaks.
_BREAK = r"(?:\r?\n|(?:\\r)?\\n)[ \t]*"
_BASE64 = re.compile(rf"(?<![A-Za-z0-9+/=])[Mblx][A-Za-z0-9+/]{{15,}}(?:{_BREAK}[A-Za-z0-9+/]+)*={{0,2}}")
_URL64 = re.compile(r"(?<![A-Za-z0-9_-])[Mblx][A-Za-z0-9_-]{39,}={0,2}")
_LONG_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[A-Za-z0-9_-]{11,}(?:\.[A-Za-z0-9_-]*){2,4}(?![A-Za-z0-9_.-])")
_LETTER = re.compile(r"[A-Za-z0-9+/_-]")
#: Object identifiers of key algorithms and of password-based encryption, and bytes of a token's signature.
_RSA, _PBES2, _PKCS12 = bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a864886f70d01050d"), bytes.fromhex("2a864886f70d010c01")
SIGNATURE_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}
_SSH_MAGIC = b"openssh-key-v1\x00"
_PGP_ALGORITHMS = (1, 2, 3, 16, 17, 18, 19, 22, 25, 26, 27, 28)


class Malformed(ValueError):
    """The bytes are not what they would have to be."""


def _element(raw: bytes, at: int, end: int) -> tuple[int, int, int]:
    """Tag, start and end of the contents of the element at a place, which must lie before end."""
    if at + 2 > end:
        raise Malformed
    tag, size, at = raw[at], raw[at + 1], at + 2
    if size >= 0x80:
        more = size & 0x7F
        if not 0 < more <= 4 or at + more > end or raw[at] == 0:
            raise Malformed
        size, at = int.from_bytes(raw[at : at + more], "big"), at + more
        if size < 0x80:
            raise Malformed
    if at + size > end:
        raise Malformed
    return tag, at, at + size


def _elements(raw: bytes, at: int, end: int) -> list[tuple[int, int, int]]:
    """All elements between two places, which they must fill."""
    out = []
    while at < end:
        out.append(_element(raw, at, end))
        at = out[-1][2]
    return out


_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


def _number(raw: bytes, part: tuple[int, int, int]) -> int:
    if part[0] != _INTEGER or part[1] == part[2]:
        raise Malformed
    return int.from_bytes(raw[part[1] : part[2]], "big", signed=True)


def _key_parts(raw: bytes, parts: list[tuple[int, int, int]]) -> str:
    """What private key the parts of a sequence are."""
    tags = [t for t, _, _ in parts]
    if tags[:2] == [_SEQUENCE, _OCTETS] and len(parts) == 2:
        inner = _elements(raw, *parts[0][1:])
        name = raw[inner[0][1] : inner[0][2]] if inner and inner[0][0] == _OID else b""
        if name == _PBES2 or name.startswith(_PKCS12):
            return "encrypted pkcs8"
        raise Malformed
    version = _number(raw, parts[0]) if parts else -1
    if version not in (0, 1):
        raise Malformed
    if tags[1:3] == [_SEQUENCE, _OCTETS] and all(t & 0xC0 == 0x80 for t in tags[3:]):
        inner = _elements(raw, *parts[1][1:])
        if not inner or inner[0][0] != _OID:
            raise Malformed
        if raw[inner[0][1] : inner[0][2]] == _RSA:
            tag, start, end = _element(raw, *parts[2][1:])
            if tag != _SEQUENCE or end != parts[2][2] or not _key_parts(raw, _elements(raw, start, end)).startswith("rsa"):
                raise Malformed
        return "pkcs8"
    if tags[1:2] == [_OCTETS] and version == 1 and 16 <= parts[1][2] - parts[1][1] <= 66 and set(tags[2:]) <= {0xA0, 0xA1}:
        return "ec"
    if set(tags) == {_INTEGER} and len(parts) in (6, 9):
        values = [_number(raw, p) for p in parts[1:]]
        bits = values[0].bit_length()
        if min(values) <= 0 or bits < 512 or len(parts) == 9 and values[3] * values[4] != values[0]:
            raise Malformed
        return f"{'rsa' if len(parts) == 9 else 'dsa'} {bits}"
    raise Malformed


def der_key(raw: bytes) -> tuple[str, int]:
    """The kind of a private key and its bytes, by the lengths of its own elements."""
    tag, start, end = _element(raw, 0, len(raw))
    if tag != _SEQUENCE:
        raise Malformed
    return _key_parts(raw, _elements(raw, start, end)), end


def ssh_key(raw: bytes) -> tuple[str, int]:
    at = len(_SSH_MAGIC)
    if raw[:at] != _SSH_MAGIC:
        raise Malformed

    def field() -> bytes:
        nonlocal at
        size = int.from_bytes(raw[at : at + 4], "big")
        if at + 4 + size > len(raw):
            raise Malformed
        at += 4 + size
        return raw[at - size : at]

    cipher, _, _ = field(), field(), field()
    keys, at = int.from_bytes(raw[at : at + 4], "big"), at + 4
    if not 0 < keys <= 16:
        raise Malformed
    for _ in range(keys):
        field()
    if not (secret := field()) or cipher == b"none" and secret[:4] != secret[4:8]:
        raise Malformed
    return cipher.decode("ascii", "replace"), at


def pgp_key(raw: bytes) -> tuple[str, int]:
    """A secret key packet and all packets after it, as far as they go on without a gap."""
    at, first = 0, ""
    while at < len(raw):
        head, start = raw[at], at
        if not head & 0x80 or at + 6 > len(raw):
            break
        if head & 0x40:
            tag, b, at = head & 0x3F, raw[at + 1], at + 2
            if b >= 192 and b < 224:
                b, at = ((b - 192) << 8) + raw[at] + 192, at + 1
            elif b == 255:
                b, at = int.from_bytes(raw[at : at + 4], "big"), at + 4
            elif b >= 224:
                raise Malformed
        else:
            tag, size = head >> 2 & 0xF, 1 << (head & 3)
            if size == 8:
                raise Malformed
            b, at = int.from_bytes(raw[at + 1 : at + 1 + size], "big"), at + 1 + size
        if at + b > len(raw):
            at = start
            break
        if not first:
            if tag != 5 or b < 20 or raw[at] not in (4, 5, 6) or raw[at + 5] not in _PGP_ALGORITHMS:
                raise Malformed
            first = f"v{raw[at]}"
        at += b
    if not first:
        raise Malformed
    return first, at


_PARSERS: tuple[tuple[str, Callable[[bytes], tuple[str, int]]], ...] = (("der_key", der_key), ("ssh_key", ssh_key), ("pgp_key", pgp_key))


def key_in(raw: bytes) -> tuple[str, str, int] | None:
    """Kind, detail and length of the private key that the bytes begin with."""
    for kind, parse in _PARSERS:
        try:
            detail, used = parse(raw)
            return kind, detail, used
        except (Malformed, IndexError):
            pass
    return None


def _decoded(letters: str, altchars: bytes | None = None) -> bytes:
    whole = letters[: len(letters) - (len(letters) % 4 == 1)]
    return base64.b64decode(whole + "=" * (-len(whole) % 4), altchars)


def _object(part: str) -> dict:
    found = json.loads(_decoded(part, b"-_").decode("utf-8"))
    if not isinstance(found, dict):
        raise Malformed
    return found


def token_in(text: str) -> tuple[str, str] | None:
    """Kind and algorithm of a signed (three parts) or sealed (five parts) token; null if it isn't one."""
    parts = text.split(".")
    try:
        if any(len(p) % 4 == 1 for p in parts):
            return None
        header = _object(parts[0])
        alg = header.get("alg")
        if not isinstance(alg, str):
            return None
        if len(parts) == 5:
            iv, sealed, tag = (_decoded(p, b"-_") for p in parts[2:])
            return ("sealed_token", alg) if isinstance(header.get("enc"), str) and len(iv) in (12, 16) and sealed and len(tag) in (16, 24, 32) else None
        if len(parts) != 3:
            return None
        if header.get("b64", True) is not False:
            _object(parts[1])
        size = len(_decoded(parts[2], b"-_"))
        fits = size == 0 if alg.lower() == "none" else size == SIGNATURE_BYTES[alg] if alg in SIGNATURE_BYTES else alg[:2] in ("RS", "PS") and size >= 128
        return ("signed_token", alg) if fits else None
    except (ValueError, RecursionError, binascii.Error):
        return None


def _end_of(text: str, start: int, end: int, letters: int) -> int:
    """The place after so many base64 letters from start on, and after the padding that follows."""
    for m in _LETTER.finditer(text, start, end):
        if text[m.start() - 1 : m.start()] == "\\" and m.group() in "nr" and m.start() > start:
            continue
        letters -= 1
        if not letters:
            at = m.end()
            while at < end and text[at] == "=":
                at += 1
            return at
    return end


def find_confirmed(text: str) -> list[tuple[str, int, int, str]]:
    """The keys and tokens of a text that parse."""
    out = []
    for pattern, alt in ((_BASE64, None), (_URL64, b"-_")):
        for m in pattern.finditer(text):
            letters = re.sub(_BREAK, "", m.group()).rstrip("=")
            if len(letters) >= 40 and (key := key_in(_decoded(letters, alt))):
                out.append((key[0], m.start(), _end_of(text, m.start(), m.end(), -(-key[2] * 8 // 6)), key[1]))
    for m in _LONG_HEX.finditer(text):
        if key := key_in(bytes.fromhex(m.group()[: len(m.group()) // 2 * 2])):
            out.append((key[0], m.start(), m.start() + 2 * key[2], key[1]))
    for m in _TOKEN.finditer(text):
        if found := token_in(m.group()):
            out.append((found[0], m.start(), m.end(), found[1]))
    return list(dict.fromkeys(out))


def find_base(text: str) -> list[tuple[str, int, int, str]]:
    """The spans of the patterns: leftmost, not overlapping within a kind; a match that is too short takes its place too.

    A run of hex or of an access key's letters is as long as it can be, so asking for its length at once changes nothing.
    """
    out = [("assign", m.start(), m.end(), m.group(1).lower()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    out += [("access", m.start(), m.end(), "") for m in _ACCESS.finditer(text)]
    return out + [("hex", m.start(), m.end(), "") for m in _HEX.finditer(text)]


def secret_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `secrets`: kind, start, end and detail of each span of the whole text, by start and then by kind as listed in
    KINDS; places are code points, end exclusive. A column of that name is replaced.

    Spans of different kinds may overlap, as an assigned token that is a signed one too. A null or empty text has none. Each
    row is worked on by itself, so repeated rows agree and an empty table stays empty. detail never holds a secret.
    """
    base = docs.drop("secrets")
    own, schema = base.columns, schema_with(base, secrets=SPANS)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("detail", pa.string())]))
    place = {k: i for i, k in enumerate(KINDS)}

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(text):
                found = find_base(t) + find_confirmed(t) if (t := value.as_py()) else []
                found.sort(key=lambda x: (x[1], place[x[0]], x[2]))
                rows.append([{"kind": k, "start": a, "end": b, "detail": d} for k, a, b, d in found])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], pa.array(rows, kind)], names=schema.names)

    return arrow_map(base, scanned, schema)
