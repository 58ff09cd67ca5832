"""Secrets in texts: patterns first, then confirmation by structure.

The base patterns (assignments, access keys, hex runs) are reported as they match.
Candidates of encoded secrets are reported only if they decode and parse: PEM blocks
and bare base64 or hex runs must hold a DER structure whose nested lengths add up or
an OpenSSH key whose length-prefixed fields do, signed tokens a JSON header that names
an algorithm and a JSON payload.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidyspark.llm.common import small_batches, texts

KINDS = ("assign", "access", "hex", "pem", "jwt", "der", "ssh")
Span = tuple[str, int, int]

# The base patterns. ``re.A`` keeps "either case" to ASCII letters.
ASSIGN = re.compile(
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,40})-----([A-Za-z0-9+/=\s]+)-----END \1-----")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
# Encoded structures start with a SEQUENCE of some length (0x30) or a length-prefixed name.
BASE64 = re.compile(r"(?<![A-Za-z0-9+/])(?:M|b3Blb|AAAA)[A-Za-z0-9+/]{38,}={0,2}")
HEX_DER = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{38,}(?![0-9A-Fa-f])")
OPENSSH = b"openssh-key-v1\0"
PUBLIC_NAMES = (b"ssh-", b"ecdsa-", b"sk-")
DEEPEST = 32


def der_parses(data: bytes) -> bool:
    """Whether the bytes are one DER SEQUENCE with content, nested lengths adding up to the last byte."""
    return len(data) > 8 and data[0] == 0x30 and _elements(data, 0, len(data), 0) == 1


def _elements(data: bytes, at: int, end: int, depth: int) -> int:
    """How many elements fill ``at`` to ``end`` exactly; -1 if they do not."""
    count = 0
    while at < end:
        if depth > DEEPEST or end - at < 2:
            return -1
        tag, size, at = data[at], data[at + 1], at + 2
        if size == 0x80 or size > 0x84 or tag in (0x00, 0xFF) or tag & 0x1F == 0x1F:
            return -1
        if size > 0x80:
            width = size & 0x7F
            size = int.from_bytes(data[at : at + width], "big")
            at += width
            if size < 0x80 or size >> 8 * (width - 1) == 0:  # DER wants the shortest form
                return -1
        if at + size > end:
            return -1
        if tag & 0x20 and _elements(data, at, at + size, depth + 1) < 1:
            return -1
        if tag == 0x02 and size == 0:  # an integer has a byte at least
            return -1
        at, count = at + size, count + 1
    return count


def _fields(data: bytes) -> list[bytes] | None:
    """Length-prefixed fields that fill the data exactly."""
    found, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        found.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return found


def ssh_parses(data: bytes) -> bool:
    """An OpenSSH private key (cipher, kdf, options, count, keys) or a public key blob."""
    if data.startswith(OPENSSH):
        rest, head = data[len(OPENSSH) :], []
        for _ in range(3):
            size = int.from_bytes(rest[:4], "big")
            if len(rest) < 4 + size:
                return False
            head.append(rest[4 : 4 + size])
            rest = rest[4 + size :]
        count = int.from_bytes(rest[:4], "big")
        keys = _fields(rest[4:])
        return bool(head[0].isascii() and 1 <= count <= 64 and keys is not None and len(keys) == count + 1)
    fields = _fields(data) if len(data) > 24 else None
    return bool(fields and len(fields) >= 2 and fields[0].startswith(PUBLIC_NAMES))


def _decoded(text: str) -> bytes | None:
    text = text.rstrip("=")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json(part: str) -> dict | None:
    raw = _decoded(part.replace("-", "+").replace("_", "/"))
    try:
        value = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _confirmed(text: str) -> Iterator[Span]:
    covered = []
    if "-----BEGIN " in text:
        for match in PEM.finditer(text):
            data = _decoded("".join(match[2].split()))
            if data and (der_parses(data) or ssh_parses(data)):
                covered.append(match.span())
                yield "pem", *match.span()
    if "eyJ" in text:
        for match in JWT.finditer(text):
            header = _json(match[1])
            signed = header is not None and isinstance(header.get("alg"), str) and _json(match[2]) is not None
            if signed and bool(match[3]) != (header["alg"].lower() == "none"):
                yield "jwt", *match.span()
    for match in BASE64.finditer(text):
        if not any(a <= match.start() < b for a, b in covered) and (data := _decoded(match[0])):
            if der_parses(data):
                yield "der", *match.span()
            elif ssh_parses(data):
                yield "ssh", *match.span()
    for match in HEX_DER.finditer(text):
        if len(match[0]) % 2 == 0 and der_parses(bytes.fromhex(match[0])):
            yield "der", *match.span()


def find_secrets(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) in code points, each ordered by start, then kind as listed."""
    base: list[Span] = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    base += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    base += [("hex", *m.span()) for m in HEX.finditer(text)]
    order = lambda span: (span[1], KINDS.index(span[0]), span[2])
    return sorted(base, key=order), sorted([*base, *_confirmed(text)], key=order)


SPANS = "array<struct<kind: string, start: int, stop: int>>"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): spans by start, then kind as in ``KINDS``.

    ``base`` holds the matches of the three base patterns, ``spans`` those and the confirmed
    structures; ``stop`` is exclusive. Null and empty texts have none. Rows are looked at one
    by one: repeated rows and null ids stay, an empty table gives no rows, other columns
    are ignored.
    """
    source = texts(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 22):
            found = [find_secrets(text) for text in batch.column("text").to_pylist()]
            columns = [
                pa.array([[dict(zip(("kind", "start", "stop"), s)) for s in spans[i]] for spans in found], span)
                for i in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "base", "spans"])

    return source.mapInArrow(run, f"doc_id {kind}, base {SPANS}, spans {SPANS}")
