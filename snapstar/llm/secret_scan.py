"""Secrets in texts: base patterns, and what proves to be a secret by its structure.

A run of base64 or hexadecimal digits is no secret by its looks. It is decoded,
and reported only if the bytes are a private key whose nested lengths fit to the
last byte, a signed token whose header names its algorithm and whose signature is
as long as that asks for, or a text that has a secret in it itself.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructType

#: Base kinds with the pattern of each and the least length, of group 2 for ``assign``.
BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    # A shorter run would be dropped, so that none is looked for.
    "hex": (re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+"), 0, 32),
}
#: What a text must have, lower-cased, for an assignment to be looked for.
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
#: Added kinds, after the base ones: keys in armour, bare keys, signed tokens, secrets within encoded text.
ADDED = ("armour", "key", "signed", "wrapped")
ORDER = {kind: i for i, kind in enumerate((*BASE, *ADDED))}

BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+(={0,2}+)")
LINE = re.compile(r"\r?\n([A-Za-z0-9+/_-]++={0,2}+)(?=\r?\n|\Z)")
HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}+")
SIGNED = re.compile(r"(?<![A-Za-z0-9_.-])(e[A-Za-z0-9_-]{7,}+)((?:\.[A-Za-z0-9_-]*+){2,4}+)")
ARMOUR = "-----BEGIN "
LABEL = re.compile(r"((?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----")
#: A first line of a wrapped run is at least as long, and texts are decoded from texts so many times.
WRAPPED, DEPTH = 40, 3

#: The bytes of a signature by algorithm; of the RSA ones at least so many.
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}
RSA_SIGNED, RSA_LEAST = ("RS256", "RS384", "RS512", "PS256", "PS384", "PS512"), 128
#: Tags of DER, and the beginnings of object identifiers (encryption by password, contents of a key store).
INTEGER, OCTETS, IDENTIFIER, SEQUENCE = 2, 4, 6, 48
BY_PASSWORD = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
CONTENTS = bytes.fromhex("2a864886f70d0107")
OPENSSH = b"openssh-key-v1\0"

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The matches of each base pattern, leftmost and non-overlapping, that pass its check."""
    found = []
    low = text.lower()
    for kind, (pattern, group, least) in BASE.items():
        if kind == "assign" and not any(name in low for name in NAMES) or kind == "access" and "AKIA" not in text:
            continue
        found += [(kind, *m.span()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return found


# --- encodings ------------------------------------------------------------------------
def unbase64(run: str) -> bytes | None:
    """The bytes of a run in either alphabet, padded or not."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except binascii.Error:
        return None


def nodes(data: bytes) -> list[tuple[int, bytes]] | None:
    """The elements (tag, content) of a DER encoding, if their lengths fit to the last byte and are written the shortest way."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or data[at] & 31 == 31:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 128:
            count = size - 128
            if not 1 <= count <= 4 or at + count > len(data):
                return None
            size = int.from_bytes(data[at : at + count], "big")
            if size < 128 or size < 1 << 8 * (count - 1):
                return None
            at += count
        if at + size > len(data):
            return None
        found.append((tag, data[at : at + size]))
        at += size
    return found


def der_key(data: bytes) -> bool:
    """A private key in DER: of RSA, DSA or an elliptic curve, bare or in PKCS 8, encrypted or in a PKCS 12 store."""
    if data[:1] != b"\x30" or not (top := nodes(data)) or len(top) != 1 or not (parts := nodes(top[0][1])):
        return False
    tags, first = [tag for tag, _ in parts], parts[0][1]
    if tags[0] == SEQUENCE:
        inner = nodes(first) or [(0, b"")]
        return tags == [SEQUENCE, OCTETS] and inner[0][0] == IDENTIFIER and inner[0][1].startswith(BY_PASSWORD)
    if tags[0] != INTEGER or len(tags) < 2:
        return False
    if tags[:9] == [INTEGER] * 9 and tags[9:] in ([], [SEQUENCE]):
        return first in (b"\0", b"\1") and len(parts[1][1]) >= 64 and all(c for _, c in parts)
    if tags == [INTEGER] * 6:
        return first == b"\0" and len(parts[1][1]) >= 64 and all(c for _, c in parts)
    if tags[1] == OCTETS:
        return first == b"\1" and len(parts[1][1]) >= 16 and tags[2:] in ([], [0xA0], [0xA1], [0xA0, 0xA1])
    inner = tags[1] == SEQUENCE and nodes(parts[1][1])
    if not inner or inner[0][0] != IDENTIFIER:
        return False
    if first == b"\3":
        return tags[2:] in ([], [SEQUENCE]) and inner[0][1].startswith(CONTENTS)
    return first in (b"\0", b"\1") and tags[2:3] == [OCTETS] and all(t in (0xA0, 0xA1, 0x81) for t in tags[3:]) and bool(parts[2][1])


def _prefixed(data: bytes, at: int) -> tuple[bytes, int] | None:
    """A field after its length in four bytes, and where it ends."""
    size = int.from_bytes(data[at : at + 4], "big")
    return (data[at + 4 : at + 4 + size], at + 4 + size) if at + 4 + size <= len(data) else None


def openssh_key(data: bytes) -> bool:
    """A private key as OpenSSH writes it: fields after their lengths, to the last byte."""
    if not data.startswith(OPENSSH):
        return False
    fields, at = [], len(OPENSSH)
    while at < len(data):
        if len(fields) == 3:
            if int.from_bytes(data[at : at + 4], "big") != 1:
                return False
            at += 4
        if not (field := _prefixed(data, at)):
            return False
        fields.append(field[0])
        at = field[1]
    if len(fields) != 5:
        return False
    return fields[0] != b"none" or len(fields[4]) >= 8 and fields[4][:4] == fields[4][4:8]


def pgp_key(data: bytes) -> bool:
    """OpenPGP packets that fit to the last byte, the first one a secret key."""
    at, tags = 0, []
    while at < len(data):
        head = data[at]
        at += 1
        if head & 0xC0 == 0xC0:
            tags.append(head & 63)
            size = data[at] if at < len(data) else 255
            if size < 192:
                at += 1
            elif size < 224 and at + 1 < len(data):
                size, at = (size - 192 << 8) + data[at + 1] + 192, at + 2
            elif size == 255 and at + 5 <= len(data):
                size, at = int.from_bytes(data[at + 1 : at + 5], "big"), at + 5
            else:
                return False
        elif head & 0x80 and head & 3 < 3:
            tags.append(head >> 2 & 15)
            width = 1 << (head & 3)
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
        else:
            return False
        at += size
    return at == len(data) and len(tags) > 0 and tags[0] in (5, 7)


def key(data: bytes | None) -> bool:
    return data is not None and len(data) >= 16 and (der_key(data) or openssh_key(data) or pgp_key(data))


def signed(header: str, rest: list[str]) -> bool:
    """A token of three parts, signed, or of five, encrypted, whose header and lengths agree."""
    try:
        head = json.loads(unbase64(header) or b"")
        parts = [unbase64(p) for p in rest]
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(alg := head.get("alg"), str) or None in parts:
        return False
    if len(parts) == 4:
        return isinstance(head.get("enc"), str) and all(parts[1:])
    if len(parts) != 2 or not parts[0]:
        return False
    return len(parts[1]) == SIGNATURES.get(alg) or alg in RSA_SIGNED and len(parts[1]) >= RSA_LEAST


# --- candidates -----------------------------------------------------------------------
def armoured(text: str) -> Iterator[Span]:
    """Keys between BEGIN and END lines; the body is over at the next dashes, so that each is looked at once."""
    at = text.find(ARMOUR)
    while at >= 0:
        after = at + len(ARMOUR)
        label = LABEL.match(text, after, after + 80)
        end = text.find("-----", label.end()) if label else -1
        if label and end >= 0 and text.startswith(f"-----END {label[1]}-----", end) and _body(text[label.end() : end]):
            after = end + len(f"-----END {label[1]}-----")
            yield "armour", at, after
        at = text.find(ARMOUR, after)


def _body(body: str) -> bool:
    lines = [line.strip() for line in re.sub(r"\\r|\\n|\r", "\n", body).split("\n")]
    heads = [line for line in lines if ":" in line]
    digits = "".join(line for line in lines if ":" not in line and not re.fullmatch("=[A-Za-z0-9+/]{4}", line))
    data = unbase64(digits)
    if any("ENCRYPTED" in line for line in heads):
        return bool(data) and len(data) % 8 == 0
    return key(data)


def runs(text: str) -> Iterator[tuple[int, int, str]]:
    """Runs of base64 digits (start, end, digits), with the lines of equal length that go on with a wrapped one."""
    at = 0
    while m := BASE64.search(text, at):
        end, parts, width = m.end(), [m.group()], len(m.group())
        if width >= WRAPPED and not m[1]:
            while (line := LINE.match(text, end)) and len(line[1]) <= width:
                end = line.end()
                parts.append(line[1])
                if len(line[1]) < width:
                    break
        yield m.start(), end, "".join(parts)
        if len(parts) > 1:
            yield m.start(), m.end(), m.group()
        at = end


def _readable(data: bytes | None) -> str | None:
    try:
        text = (data or b"").decode()
    except UnicodeDecodeError:
        return None
    return text if text and not re.search(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", text) else None


def added_spans(text: str, depth: int = DEPTH) -> list[Span]:
    """What the structure of encoded runs confirms."""
    found = list(armoured(text))

    def decoded(start: int, end: int, data: bytes | None) -> None:
        if key(data):
            found.append(("key", start, end))
        elif depth and (inner := _readable(data)) and holds(inner, depth - 1):
            found.append(("wrapped", start, end))

    if "." in text:
        for m in SIGNED.finditer(text):
            rest = m[2].rstrip(".")  # a full stop after a token is none of it
            if signed(m[1], rest[1:].split(".")):
                found.append(("signed", m.start(), m.end() - len(m[2]) + len(rest)))
    for start, end, digits in runs(text):
        decoded(start, end, unbase64(digits))
    for m in HEX.finditer(text):
        if len(m.group()) % 2 == 0:
            decoded(*m.span(), bytes.fromhex(m.group()))
    # A key in armour is reported once, not line by line.
    armour = [(a, b) for kind, a, b in found if kind == "armour"]
    return [s for s in found if s[0] == "armour" or not any(a <= s[1] and s[2] <= b for a, b in armour)] if armour else found


def holds(text: str, depth: int) -> bool:
    """Whether a decoded text has a secret: an assignment, an access key, or what structure confirms."""
    return any(kind != "hex" for kind, _, _ in base_spans(text)) or bool(added_spans(text, depth))


def spans(text: str) -> list[Span]:
    """All spans by start, then kind in the order of the lists, then end."""
    return sorted({*base_spans(text), *added_spans(text)}, key=lambda s: (s[1], ORDER[s[0]], s[2]))


FOUND = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def find(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans): all secrets of every whole text, as (kind, start, end, base) in code points, by start, then kind.

    ``base`` spans are the matches of a base pattern that pass its check. Others
    are ``armour`` (a private key between BEGIN and END lines), ``key`` (a bare one
    in base64 or hex), ``signed`` (a token) and ``wrapped`` (encoded text that has a
    secret); a base span stays whatever is added. Null and empty texts have none;
    a repeated row appears as often as it is given; an empty table gives no rows;
    other columns are left out. Nothing is shuffled.
    """
    schema = StructType([docs.schema[id]]).add("spans", DataType.fromDDL(FOUND))
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b, "base": k in BASE} for k, a, b in spans(whole or "")] for whole in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, arrow.field(1).type)], schema=arrow)

    return docs.select(id, F.col(text).alias("_text")).mapInArrow(rows, schema)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = _joined(F.filter("spans", lambda x: x["base"]))
    return find(docs).select("doc_id", *[count(k) for k in BASE], F.sha2(base, 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
