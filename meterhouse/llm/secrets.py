"""Secret scan: keyword, access-id and hex patterns, plus keys and tokens confirmed by structure.

Base kinds are ``assign``, ``access`` and ``hex``. Further kinds are reported only when a candidate
decodes to what it claims to be:

* ``key``: base64 or hex, armoured or bare, whose bytes are a private key: DER with nested lengths
  that add up (PKCS#1, PKCS#8 plain or encrypted, SEC1), an OpenSSH key with its length-prefixed
  fields, or an armoured key inside the decoded text. Lines of a bare key may have any length, be
  indented and be broken as in a JSON string; it ends with the line in which its lengths are met;
* ``jwt``: a signed token whose header and payload decode to JSON objects and whose header names
  its algorithm.

Every text is scanned whole, row by row, so nothing is shuffled. A null or empty text has no spans;
rows with a null id, repeated rows and further columns pass through unchanged.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.llm.tables import documents

KINDS = ("assign", "access", "hex", "key", "jwt")
SPANS = T.ArrayType(
    T.StructType()
    .add("kind", T.StringType())
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
)

# The three base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LENGTH = 8

JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----(.*?)-----END \1-----", re.DOTALL)
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}(?:\r?\n[A-Za-z0-9+/_-]{16,})*={0,2}")
HEX_RUN = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{2}){32,}(?![0-9A-Za-z])")
# Wrapped keys: where one may begin, its lines, and what stands between them.
BREAK = re.compile(r"[ \t]*(?:\r?\n|\r|(?:\\+r)?\\+n)[ \t]*")
LITERAL_BREAK = re.compile(r"(?:\\+r)?\\+n|\\+r")
BLANK_LINE = re.compile(r"\n[ \t]*\n")
START = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[nrt]))(?=M[A-P][A-Za-z0-9+/_-]{2}|b3Bl|LS0t)")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
HEX_START = re.compile(
    r"(?:(?<![0-9A-Za-z])|(?<=(?<![0-9A-Za-z])0[xX])|(?<=\\[nrt]))"
    r"(?=30[0-9a-fA-F]{6}|6[fF]7065|2[dD]2[dD]2[dD])"
)
HEX_LINE = re.compile(r"[0-9a-fA-F]+(?![0-9A-Za-z])")
PADDING = re.compile(r"={0,2}")
ARMOUR_BYTES = re.compile(
    rb"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----.*?-----END \1-----\s*", re.DOTALL
)
Decoder = Callable[[str], bytes | None]

SEQUENCE, INTEGER, OCTETS, OBJECT_ID = 0x30, 0x02, 0x04, 0x06


def decode64(text: str) -> bytes | None:
    """Bytes of a base64 text in either alphabet, padding optional; None if it is not one."""
    plain = re.sub(r"[\s=]", "", text).replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of the DER items that fill ``data`` exactly; None if lengths do not add up."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


def is_der_key(data: bytes) -> bool:
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    items = der_items(outer[0][1])
    if not items or len(items) < 2:
        return False
    tags = [tag for tag, _ in items]
    if tags[0] == INTEGER and len(items[0][1]) == 1:
        if len(items) >= 9 and set(tags[:9]) == {INTEGER}:
            return True  # PKCS#1
        if tags[1] == OCTETS and 16 <= len(items[1][1]) <= 80:
            return True  # SEC1
        inner = tags[1] == SEQUENCE and der_items(items[1][1])
        return bool(inner and inner[0][0] == OBJECT_ID and OCTETS in tags[2:3])  # PKCS#8
    inner = tags == [SEQUENCE, OCTETS] and der_items(items[0][1])
    return bool(inner and inner[0][0] == OBJECT_ID and len(items[1][1]) % 8 == 0)  # encrypted


def is_openssh_key(data: bytes) -> bool:
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)
    for _ in range(3):  # cipher, key derivation and its options
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 64


def is_key(data: bytes | None) -> bool:
    if not data:
        return False
    if data[0] == SEQUENCE:
        return is_der_key(data)
    return is_openssh_key(data) or (b"PRIVATE KEY-----" in data and b"-----BEGIN " in data)


def openssh_length(data: bytes) -> int | None:
    """Bytes up to the end of the private part of an OpenSSH key; None if ``data`` ends before."""
    at, left, counted = len(b"openssh-key-v1\0"), 3, False
    while left:  # cipher, key derivation, its options; then public keys and the private part
        if at + 4 > len(data):
            return None
        at, left = at + 4 + int.from_bytes(data[at : at + 4], "big"), left - 1
        if not left and not counted:
            counted, left, at = True, int.from_bytes(data[at : at + 4], "big") + 1, at + 4
    return at if at <= len(data) else None


def der_length(head: bytes) -> int | None:
    """Bytes of the DER key that begins with ``head``; None if none does."""
    wide = head[1] & 0x7F if head[1] & 0x80 else 0
    if wide > 4 or head[1] == 0x80 or head[2 + wide] not in (INTEGER, SEQUENCE):
        return None
    return 2 + wide + (int.from_bytes(head[2 : 2 + wide], "big") if wide else head[1])


def wrapped_key(
    text: str, start: int, line: re.Pattern, decode: Decoder, unit: int, width: int
) -> int:
    """End of the key whose lines begin at ``start``, -1 if none: where a line ends with its last byte.

    ``unit`` characters hold ``width`` bytes.
    """
    lines, ends, count, at, size = [], [], 0, start, None
    while m := line.match(text, at):
        before = count
        lines.append(m[0])
        count, at = count + len(m[0]), m.end()
        ends.append((count, at))
        if before < 16 <= count:
            head = decode("".join(lines)[:16]) or b"?"
            if head[0] == SEQUENCE:
                size = der_length(head)
            if size is None and head[:3] not in (b"ope", b"---"):
                return -1
        if size is not None and count * width >= size * unit:
            break
        gap = BREAK.match(text, at)
        if not gap:
            break
        at = gap.end()
    if count < 16:
        return -1
    if size is None:
        whole = "".join(lines)
        data = decode(whole) or decode(whole[: count - count % unit]) or b""
        armour = ARMOUR_BYTES.match(data)
        size = armour.end() if armour else openssh_length(data)
        if size is None:
            return -1
    for n, (count, at) in enumerate(ends):
        if count * width >= size * unit - unit + 1 and count * width // unit >= size:
            data = decode("".join(lines[: n + 1])) or b""
            ok = not data[size:].strip() and is_key(data)
            return PADDING.match(text, at).end() if ok else -1
    return -1


def plain_hex(text: str) -> bytes | None:
    return bytes.fromhex(text) if len(text) % 2 == 0 else None


def is_armoured_key(body: str) -> bool:
    """The body between the lines of an armoured key, old encryption headers included.

    Its line breaks may be written as in a JSON string.
    """
    body = LITERAL_BREAK.sub("\n", body)
    if "Proc-Type:" in body:
        data = decode64("".join(BLANK_LINE.split(body.replace("\r", ""), maxsplit=1)[1:]))
        return bool(data) and len(data) % 8 == 0
    return is_key(decode64(body))


def is_jwt(token: str) -> bool:
    parts = []
    for part in token.split(".")[:2]:
        try:
            parts.append(json.loads(decode64(part) or b""))
        except ValueError:
            return False
    return all(isinstance(p, dict) for p in parts) and isinstance(parts[0].get("alg"), str)


def find_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all secrets, by start, then kind as listed; code points, end exclusive."""
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH
    ]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    armoured: list[tuple[int, int]] = []
    if "-----BEGIN " in text:
        for m in ARMOUR.finditer(text):
            if is_armoured_key(m[2]):
                found.append((m.start(), 3, m.end()))
                armoured.append(m.span())
    keys = list(armoured)
    for first, *form in ((START, LINE, decode64, 4, 3), (HEX_START, HEX_LINE, plain_hex, 2, 1)):
        for m in first.finditer(text):
            if not any(a <= m.start() < b for a, b in keys):
                end = wrapped_key(text, m.start(), *form)
                if end >= 0:
                    found.append((m.start(), 3, end))
                    keys.append((m.start(), end))
    for m in RUN.finditer(text):
        inside = any(a <= m.start() < b for a, b in keys)
        if not inside and is_key(decode64(m[0])):
            found.append((m.start(), 3, m.end()))
    for m in HEX_RUN.finditer(text):
        inside = any(a <= m.start() < b for a, b in keys)
        if not inside and is_key(bytes.fromhex(m[0])):
            found.append((m.start(), 3, m.end()))
    if "eyJ" in text:
        found += [(m.start(), 4, m.end()) for m in JWT.finditer(text) if is_jwt(m[0])]
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


@F.arrow_udf(SPANS)
def spans_of(texts: pa.Array) -> pa.Array:
    rows = [
        [{"kind": k, "start": s, "end": e} for s, k, e in find_spans(t.as_py() or "")]
        for t in texts
    ]
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    return pa.array(rows, pa.list_(kind))


@F.arrow_udf(T.StringType())
def redacted(texts: pa.Array) -> pa.Array:
    """Whole texts with every span, overlapping ones merged, replaced by ``[secret]``."""
    out = []
    for text in texts.to_pylist():
        kept, at = [], 0
        for start, _, end in find_spans(text or ""):
            if start >= at:
                kept += [text[at:start], "[secret]"]
            at = max(at, end)
        out.append(text if not kept else "".join(kept) + text[at:])
    return pa.array(out, pa.string())


def scan(docs: DataFrame, text: str = "text", spans: str = "secret_spans") -> DataFrame:
    """Adds ``spans``, the secrets in ``text`` as (kind, start, end)."""
    return docs.withColumn(spans, spans_of(F.col(text)))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced in ``text``, and ``n_chars`` as long as what is left."""
    out = docs.withColumn("text", redacted("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))
    return out


def joined(spans: Column) -> Column:
    return F.concat_ws(
        ",",
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, with a digest of the base spans."""
    found = F.col("secret_spans")

    def number(kind: str) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")

    base = F.filter(found, lambda s: s["kind"].isin(*KINDS[:3]))
    return scan(documents(spark, folder)).select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(found).alias("spans"),
        *[number(k).alias(f"n_{k}") for k in KINDS[3:]],
    )
