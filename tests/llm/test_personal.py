"""Personal data against the base patterns run as they are written, and rows of every awkward kind."""

import random
import re

import pytest
from conftest import SMALL

from meterhouse.llm import personal

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + n % 2) for n, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def number(text):
    return re.sub("[^0-9]", "", text)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [
        (m.start(), 2, m.end()) for m in CARD.finditer(text)
        if 12 <= len(number(m[0])) <= 19 and luhn(number(m[0]))
    ]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(number(m[0])) <= 15]
    return [(s, personal.KINDS[k], e) for s, k, e in sorted(found)]


def base_of(text):
    return [s for s in personal.find_spans(text) if s[1] in personal.BASE]


@pytest.mark.parametrize("alphabet", ["a@.b-", "12.0", "0123456789 -", "+1(). -9", "a1@.+- (_é:٣\U0001f600"])
def test_base_spans_equal_the_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(3_000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        assert base_of(text) == base_spans(text), text


def test_written_out_cases():
    card = "4532015112830366"
    for text in [f"pay {card}.", " ".join([card[:4], card[4:8], card[8:12], card[12:]]), f"{card} 1 2",
                 "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "0000000255.1.1.1", "a@b.c@d.e f@g", "+1 (974) 555-3436 x",
                 "9" * 5_000, "a" * 5_000 + "@b.c", "x@y.z" * 100, "1.1.1." * 300]:
        assert base_of(text) == base_spans(text), text[:50]


@pytest.mark.parametrize("text, kind, inner", [
    ("see https://ann:pw@host.example:8080/x", "login", "https://ann:pw@host.example:8080"),
    ("(ftp://bob@files.example)", "login", "ftp://bob@files.example"),
    ("call tel:030-1234567.", "tel", "030-1234567"),
    ("IBAN: DE89 3704 0044 0532 0130 00 NOW", "iban", "DE89 3704 0044 0532 0130 00"),
    ("iban GB82WEST12345698765432", "iban", "GB82WEST12345698765432"),
    ("account number 1234 567 890, please", "account", "1234 567 890"),
    ("Acct: 00123456", "account", "00123456"),
    ("SSN 078-05-1120", "ssn", "078-05-1120"),
    ("IPv6 address: 2001:db8::ff00:42:8329, up", "ipv6", "2001:db8::ff00:42:8329"),
    ("MAC 00:1b:44:11:3a:b7", "mac", "00:1b:44:11:3a:b7"),
    ("mac=00-1B-44-11-3A-B7;", "mac", "00-1B-44-11-3A-B7"),
    ("lives at 221B Baker Street, London", "street", "221B Baker Street"),
    ("12 Martin Luther King Blvd.", "street", "12 Martin Luther King Blvd."),
])
def test_further_kinds(text, kind, inner):
    at = text.index(inner)
    assert (at, kind, at + len(inner)) in personal.find_spans(text)


@pytest.mark.parametrize("text", [
    "https://host.example/a@b", "https://@host", "tel:12", "IBAN DE89 3704 0044 0532 0130 01", "Caliban DE89",
    "account 2019", "an account of 123456 people", "account: 12345", "SSN 000-12-1234", "ssn 900-12-1234", "SSN 123-00-1234",
    "IPv6 ::1::2", "IPv6: 12345::", "ipv6 is new", "MAC 00:1b:44:11:3a", "MAC 00:1b-44:11:3a:b7", "a machine",
    "Baker Street", "in 1999 the Long Road", "12 Baker Streets", "1.5 Baker Street",
])
def test_what_fails_validation_is_not_reported(text):
    assert personal.find_spans(text) == []


def test_rows(spark):
    long = "word " * 200_000 + "a.b@c.de"
    texts = ["a.b@c.de 1.2.3.4", None, "", "none", "none", long]
    schema = "doc_id long, text string, start string, kind int, personal_span int"
    rows = [(n if n != 3 else None, t, "s", 1, 2) for n, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[0]], schema)
    found = personal.scan(docs).collect()
    assert [len(r.personal_spans) for r in found] == [2, 0, 0, 0, 0, 1, 2]
    shown = personal.mask(docs)
    assert shown.columns == docs.columns
    assert [r.text for r in shown.collect()][:5] == ["[email] [ip]", None, "", "none", "none"]
    assert personal.scan(docs.limit(0)).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = personal.query(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = base_spans(texts[r.doc_id])
        assert [s for s in r.spans.split(",") if s.split(":")[0] in personal.BASE] == [
            f"{k}:{s}:{e}" for s, k, e in expected
        ]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(k == kind for _, k, _ in expected) for kind in personal.BASE
        )
    assert sum(r.n_email + r.n_phone for r in rows) > 0
