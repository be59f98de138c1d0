"""Personal data: anchors found by Aho-Corasick, expanded and validated by local parsers.

One automaton finds the anchors of every text in a single pass: at-signs, plus signs and digits for the
base kinds ``email``, ``ip``, ``card`` and ``phone``; schemes and cue words for the kinds added to them:

* ``login``: a web address whose authority names a user, from its scheme to the end of the host;
* ``tel``: the number after a ``tel:`` scheme, 7 to 15 digits;
* ``iban``: an account number after that cue, to the last group at which its check digits hold;
* ``account``: 6 to 20 digits after an account cue and a separator or a word for number;
* ``ssn``: a social security number after its cue, of an area, group and serial that are issued;
* ``ipv6`` and ``mac``: a network address after that cue, of groups that add up;
* ``street``: a house number, one to three capitalised words and a word for street.

Each parser reads the characters around its anchor only, and never twice what an earlier anchor of its
kind has read, so the work is in proportion to the text. Base spans are exactly the leftmost
non-overlapping matches of the base patterns that pass their checks; spans of further kinds may overlap
them. Texts are read whole, row by row, and nothing is shuffled. A null or empty text has no spans; rows
with a null id, repeated rows and further columns pass through unchanged.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.llm.tables import documents

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "tel", "iban", "account", "ssn", "ipv6", "mac", "street")
SPAN = (
    T.StructType()
    .add("kind", T.StringType())
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
)

# The characters and lengths of the base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
SPACED = re.compile(r"[0-9](?:[ -]?[0-9])*")
DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
OCTET_MOST, CARD_DIGITS, PHONE_DIGITS = 255, range(12, 20), range(9, 16)

# What follows a scheme or a cue.
SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{0,30}\Z")
AUTHORITY = re.compile(r"[^\s/?#\"'<>@:]+(?::[^\s/?#\"'<>@]*)?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?")
TEL = re.compile(r"[0-9(][0-9().-]{5,28}[0-9](?![0-9])")
NUMBER_WORD = r"(?:[ \t]?(?:[Nn]umber|[Nn]um\.?|[Nn]r\.?|[Nn]o\.?|ID|id))"
GAP = r"[ \t]{0,3}"
IBAN = re.compile(rf"{NUMBER_WORD}?{GAP}[:=#]?{GAP}([A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}})")
ACCOUNT = re.compile(
    rf"(?:{NUMBER_WORD}{GAP}[:=#]?|{GAP}[:=#]){GAP}([0-9](?:[ -]?[0-9]){{5,19}})(?![0-9A-Za-z])"
)
SSN = re.compile(rf"{NUMBER_WORD}?{GAP}[:=#]?{GAP}([0-9]{{3}})[ -]([0-9]{{2}})[ -]([0-9]{{4}})(?![0-9])")
NETWORK_WORD = r"(?:[ \t]?(?:[Aa]ddress|[Aa]ddr\.?))"
IPV6 = re.compile(rf"{NETWORK_WORD}?{GAP}[:=]?{GAP}([0-9A-Fa-f:]{{2,39}})(?![0-9A-Za-z:.])")
MAC = re.compile(
    rf"{NETWORK_WORD}?{GAP}[:=]?{GAP}([0-9A-Fa-f]{{2}}([:-])(?:[0-9A-Fa-f]{{2}}\2){{4}}[0-9A-Fa-f]{{2}})(?![0-9A-Za-z:-])"
)
HOUSE = re.compile(r"(?<![0-9A-Za-z.,-])[0-9]{1,5}[A-Za-z]?(?: [A-Z][A-Za-z'.-]{0,24}){1,3}\Z")
HOUSE_LENGTH = 84  # characters that a match of it can have
CUES = {
    "iban": ["IBAN", "Iban", "iban"],
    "account": ["ACCOUNT", "Account", "account", "ACCT", "Acct", "acct", "KONTO", "Konto", "konto"],
    "ssn": ["SSN", "ssn", "Social Security", "social security", "Social security"],
    "ipv6": ["IPv6", "ipv6", "IPV6"],
    "mac": ["MAC", "mac", "Mac"],
}


@cache
def automaton() -> ahocorasick.Automaton:
    """Anchors, each with what it announces and its length."""
    words = ahocorasick.Automaton()
    anchors = {"@": ["@"], "+": ["+"], "digit": list("0123456789"), "://": ["://"], "tel:": ["tel:", "TEL:"]}
    anchors["street"] = STREETS
    for what, spellings in (anchors | CUES).items():
        for word in spellings:
            words.add_word(word, (what, len(word)))
    words.make_automaton()
    return words


def digits_in(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def passes_luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        value = int(c) << (n & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def email_at(text: str, at: int, after: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at`` that begins at ``after`` or later."""
    domain = DOMAIN.match(text, at + 1)
    if not domain:
        return None
    start = at
    while start > after and text[start - 1] in LOCAL:
        start -= 1
    return (start, domain.end()) if start < at else None


def ips_in(text: str, chain: re.Match) -> Iterator[tuple[int, int]]:
    """Every four numbers of a dotted chain, those with a number above 255 left out."""
    parts, at = chain[0].split("."), chain.start()
    for n in range(0, len(parts) - 3, 4):
        four = parts[n : n + 4]
        end = at + sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= OCTET_MOST for p in four):
            yield at, end
        at = end + 1


def login_at(text: str, at: int) -> tuple[int, int] | None:
    """The address with a user whose ``://`` begins at ``at``."""
    authority = AUTHORITY.match(text, at + 3)
    first = max(0, at - 31)
    while authority and first < at:
        scheme = SCHEME.match(text[first:at])
        if scheme and (first == 0 or not text[first - 1].isalnum()):
            return first, authority.end()
        first += 1
    return None


def iban_after(text: str, at: int) -> tuple[int, int] | None:
    """The account number after a cue, up to the last character group whose check digits hold."""
    m = IBAN.match(text, at)
    if not m:
        return None
    for end in range(m.end(1), m.start(1) + 14, -1):
        if text[end - 1] == " " or text[end : end + 1].isalnum():
            continue
        plain = text[m.start(1) : end].replace(" ", "")
        if 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            return m.start(1), end
    return None


def ssn_after(text: str, at: int) -> tuple[int, int] | None:
    m = SSN.match(text, at)
    if not m or m[1] in ("000", "666") or m[1][0] == "9" or m[2] == "00" or m[3] == "0000":
        return None
    return m.start(1), m.end(3)


def ipv6_after(text: str, at: int) -> tuple[int, int] | None:
    m = IPV6.match(text, at)
    if not m:
        return None
    try:
        ipaddress.IPv6Address(m[1])
    except ValueError:
        return None
    return m.span(1)


def mac_after(text: str, at: int) -> tuple[int, int] | None:
    m = MAC.match(text, at)
    return m.span(1) if m else None


def street_to(text: str, at: int, end: int) -> tuple[int, int] | None:
    """The address whose word for street, with the space before it, begins at ``at`` and ends at ``end``."""
    m = HOUSE.search(text[max(0, at - HOUSE_LENGTH - 1) : at])
    if not m or text[end : end + 1].isalnum():
        return None
    return at - len(m[0]), end


def tel_after(text: str, at: int) -> tuple[int, int] | None:
    m = TEL.match(text, at)
    return m.span() if m and 7 <= len(digits_in(m[0])) <= 15 else None


def account_after(text: str, at: int) -> tuple[int, int] | None:
    m = ACCOUNT.match(text, at)
    return m.span(1) if m else None


AFTER = {
    "iban": iban_after, "ssn": ssn_after, "tel:": tel_after, "account": account_after, "ipv6": ipv6_after,
    "mac": mac_after,
}
STREETS = [" Street", " St.", " Avenue", " Ave.", " Road", " Rd.", " Lane", " Boulevard", " Blvd.", " Drive"]
NAMES = {"tel:": "tel"}


def find_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all findings, by start, then kind as listed; code points, end exclusive."""
    found: list[tuple[int, int, int]] = []
    read = dict.fromkeys(("email", "ip", "card"), 0)  # where what these parsers have read ends
    for last, (what, size) in automaton().iter(text):
        at = last + 1 - size
        if what == "digit":
            if at >= read["card"]:
                chain = SPACED.match(text, at)
                read["card"] = chain.end()
                if chain.end() - at >= CARD_DIGITS[0]:
                    digits = digits_in(chain[0])
                    if len(digits) in CARD_DIGITS and passes_luhn(digits):
                        found.append((at, KINDS.index("card"), chain.end()))
            if at >= read["ip"]:
                chain = DOTTED.match(text, at)
                read["ip"] = chain.end()
                if chain.end() - at >= 7:
                    found += [(a, KINDS.index("ip"), b) for a, b in ips_in(text, chain)]
        elif what == "@":
            span = email_at(text, at, read["email"])
            if span:
                found.append((span[0], KINDS.index("email"), span[1]))
                read["email"] = span[1]
        elif what == "+":
            m = DIALLED.match(text, at)
            if m and len(digits_in(m[0])) in PHONE_DIGITS:
                found.append((at, KINDS.index("phone"), m.end()))
        elif what == "://":
            span = login_at(text, at)
            if span:
                found.append((span[0], KINDS.index("login"), span[1]))
        elif what == "street":
            span = street_to(text, at, last + 1)
            if span:
                found.append((span[0], KINDS.index("street"), span[1]))
        elif at == 0 or not text[at - 1].isalnum():  # a cue is a word of its own
            span = AFTER[what](text, last + 1)
            if span:
                found.append((span[0], KINDS.index(NAMES.get(what, what)), span[1]))
    return [(start, KINDS[kind], end) for start, kind, end in sorted(set(found))]


@F.arrow_udf(T.ArrayType(SPAN))
def spans_of(texts: pa.Array) -> pa.Array:
    rows = [
        [{"kind": k, "start": s, "end": e} for s, k, e in find_spans(t.as_py() or "")]
        for t in texts
    ]
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    return pa.array(rows, pa.list_(kind))


@F.arrow_udf(T.StringType())
def masked(texts: pa.Array) -> pa.Array:
    """Whole texts with each finding replaced by its kind in brackets, overlapping ones by the first's."""
    out = []
    for value in texts:
        text, kept, at = value.as_py(), [], 0
        for start, kind, end in find_spans(text or ""):
            if start >= at:
                kept += [text[at:start], f"[{kind}]"]
            at = max(at, end)
        out.append(text if not kept else "".join(kept) + text[at:])
    return pa.array(out, pa.string())


def scan(docs: DataFrame, text: str = "text", spans: str = "personal_spans") -> DataFrame:
    """Adds ``spans``, the personal data in ``text`` as (kind, start, end)."""
    return docs.withColumn(spans, spans_of(F.col(text)))


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by its kind, other columns as they are."""
    return docs.withColumn(text, masked(F.col(text)))


def joined(spans: Column) -> Column:
    return F.concat_ws(
        ",",
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document, with a digest of the base spans."""
    found = F.col("personal_spans")

    def number(kind: str) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(documents(spark, folder)).select(
        "doc_id",
        *[number(k) for k in BASE],
        F.sha2(joined(F.filter(found, lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        joined(found).alias("spans"),
        *[number(k) for k in KINDS[len(BASE) :]],
    )
