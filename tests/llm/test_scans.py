"""Operators that read row by row, on rows of every awkward kind."""

import base64
import json
import re

import pytest
from pyspark.sql import functions as F

from meterhouse.llm import decontaminate, licenses, pages, quality, secrets, toxicity
from meterhouse.llm.training import labelled

LONG = "word " * 200_000
SCHEMA = "doc_id long, text string, start string, kind int, _leaks int, _quality int, spans string"
TEXTS = ["password = hunter2hunter2", None, "", "no secret", "no secret", LONG, "tab\tand\nline\x0b"]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(n if n != 3 else None, t, "x", 1, 2, 3, "s") for n, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + rows[:1], SCHEMA)


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.limit(0)


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


NUMBER = der(2, b"\x11" * 16)
PKCS1 = der(0x30, der(2, b"\0"), *[NUMBER] * 8)
PKCS8 = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48")), der(4, PKCS1))
SEC1 = der(0x30, der(2, b"\x01"), der(4, b"\x22" * 32))


def part(value):
    return base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")


@pytest.mark.parametrize("key", [PKCS1, PKCS8, SEC1])
def test_keys_are_found_by_structure(key):
    for text in (base64.b64encode(key).decode(), key.hex()):
        spans = secrets.find_spans(f"see {text} there")
        assert (4, "key", 4 + len(text)) in spans
    broken = bytearray(key)
    broken[1 if key[1] < 128 else 3] ^= 1  # a length that does not add up
    assert not any(k == "key" for _, k, _ in secrets.find_spans(base64.b64encode(broken).decode()))


def test_armour_and_tokens():
    body = base64.encodebytes(PKCS8).decode()
    armour = f"-----BEGIN PRIVATE KEY-----\n{body}-----END PRIVATE KEY-----"
    assert secrets.find_spans(f"a {armour} b") == [(2, "key", 2 + len(armour))]
    fake = "-----BEGIN PRIVATE KEY-----\nnot a key at all\n-----END PRIVATE KEY-----"
    assert secrets.find_spans(fake) == []
    token = ".".join([part({"alg": "HS256"}), part({"sub": "1"}), "c2ln"])
    assert secrets.find_spans(token) == [(0, "jwt", len(token))]
    assert secrets.find_spans(".".join([part({"typ": "x"}), part({}), "c2ln"])) == []


def test_base_spans_as_stated():
    text = 'Token="abcdefgh" AKIAABCDEFGHIJKL token=secret: abcdefgh1 ' + "a1" * 20 + " paſsword=xxxxxxxxx"
    found = []
    rule = re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII,
    )
    found += [(m.start(), "assign", m.end()) for m in rule.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    assert [s for s in secrets.find_spans(text) if s[1] in secrets.KINDS[:3]] == sorted(found)


def test_secret_rows(awkward, empty):
    rows = secrets.scan(awkward).collect()
    assert len(rows) == len(TEXTS) + 1
    assert [len(r.secret_spans) for r in rows] == [1, 0, 0, 0, 0, 0, 0, 1]
    redacted = secrets.redact(awkward).collect()
    assert [r.text for r in redacted] == ["[secret]", *TEXTS[1:], "[secret]"]
    assert redacted[0].asDict().keys() == set(awkward.columns)
    assert secrets.scan(empty).count() == 0


@pytest.mark.parametrize("block_bytes", [32_000_000, 0])
def test_leaks_equal_brute_force(spark, awkward, empty, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    half = " ".join(item.split()[:9])
    items = [(1, item), (2, "too short now"), (3, None), (None, item.upper()), (1, item), (5, "")]
    items = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1, f"x {item} y"), (2, half), (3, None), (None, item), (4, "x " * 3), (1, f"x {item} y"),
            (6, " ".join(item.split()[:13]))]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.contamination(docs, items).collect()
    expected = []
    for d in docs.collect():
        have = decontaminate.shingles_of(decontaminate.words_of(d.text))
        for i in items.collect():
            want = decontaminate.shingles_of(decontaminate.words_of(i.text))
            if want and len(want & have) >= 0.8 * len(want):
                expected.append((d.doc_id, i.item_id, len(want & have) / len(want)))
    assert sorted([(r.doc_id, r.item_id, r.containment) for r in found], key=str) == sorted(
        expected, key=str
    )
    kept = decontaminate.without_leaks(awkward, items)
    assert kept.columns == awkward.columns and kept.count() == len(TEXTS) + 1
    assert decontaminate.without_leaks(docs, items.limit(0)).count() == 7
    assert decontaminate.without_leaks(empty, items).count() == 0


def test_joins_find_what_is_sent_out_finds(spark, monkeypatch):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    whole = sorted(decontaminate.contamination(docs, items).collect())
    clean = sorted(r.doc_id for r in decontaminate.without_leaks(docs, items).collect())
    assert whole and len(clean) < docs.count()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 0)
    assert sorted(decontaminate.contamination(docs, items).collect()) == whole
    kept = decontaminate.without_leaks(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == clean


def test_pages():
    page = """<!DOCTYPE html><html><head><title>T</title></head><body><div id="top-nav"><a href=x>Home</a>
    <a href=y>News</a></div><header>Site</header><div class="sidebar">Side text, long enough to be text</div>
    <div class="c1"><h1>Head &amp; line</h1><p>First  para\n is long enough to be text, yes indeed.
    <div class="cookie-notice">We use cookies</div><p>Second <b>bold<i> and</b> <span class="ad">BUY</span>end.
    <ul><li>one<li>two</ul></div><div id="comments"><p>Reader says hi</p></div><form>Name <input></form>
    <script>var x = "<p>no</p>";</script><footer>f</footer>"""
    assert pages.main_text(page) == (
        "Head & line\n\nFirst para is long enough to be text, yes indeed.\n\n"
        "Second bold and end.\n\none\n\ntwo"
    )
    assert pages.main_text(None) == pages.main_text("") == pages.main_text("<p></p>") == ""
    assert pages.main_text("plain < text") == "plain < text"
    assert pages.main_text("<article><p>cut o") == "cut o"
    assert len(pages.main_text("<p>" + LONG)) == len(LONG) - 1


PARAGRAPHS = [f"Paragraph {n} of the story, with words enough to count as running text." for n in range(4)]
STORY = "<h1>Headline</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
STORY_TEXT = "\n\n".join(["Headline", *PARAGRAPHS])
SHORT = "<p>The end.</p>"


@pytest.mark.parametrize("before, after", [
    ("<article>", "</article>"),
    ("<div>", "</div>"),
    ('<div class="page sidebar-right social">', "</div>"),
    ('<form action="/" id="aspnet">', "</form>"),
    ('<div class="hentry comments-open"><main>', "</main></div>"),
    ('<article class="post related-posts-on">', "</article>"),
    ('<div class="comments-closed">', "</div>"),
    ('<div class="popup-root"><div class="share-layout"><article>', "</article></div></div>"),
])
def test_frames_hold_the_article_whatever_they_are_called(before, after):
    menu = '<nav><a href="/">Home</a></nav><div class="cookie">We use cookies for this and that.</div>'
    inner = '<div class="comments"><p>A reader thinks otherwise, and says so here.</p></div>'
    page = f"<html><body>{menu}{before}{STORY}{inner}{after}<footer>Imprint</footer></body></html>"
    assert pages.main_text(page) == STORY_TEXT


def test_marks_count_by_what_they_hold():
    teasers = "".join(f"<article><a href=/{n}>More news {n}</a></article>" for n in range(5))
    assert pages.main_text(f"<body><div>{STORY}</div><ul>{teasers}</ul></body>") == STORY_TEXT
    plain = "<div>Words outside of the article that nobody marked as anything.</div>"
    assert pages.main_text(f"{plain}<main>{STORY}</main>{plain}") == STORY_TEXT


def test_comments_longer_than_the_article():
    reader = "".join(f"<p>{p} I do not agree with it at all, dear author.</p>" for p in PARAGRAPHS * 5)
    for wrapper in ('<div id="comments">', "<section class='discussion'><article>", "<div class=disqus>"):
        assert pages.main_text(f"<div>{STORY}</div>{wrapper}{reader}") == STORY_TEXT
        assert pages.main_text(f"<article>{STORY}</article>{wrapper}{reader}") == STORY_TEXT


@pytest.mark.parametrize("name", [
    "commentlist", "commentThread", "relatedposts", "topnav", "sidebar2", "leftsidebar", "cookiebar", "siteFooter",
    "advertbox", "newsletterbox", "usercomments", "widget_area", "post-comments", "mainMenu", "ad-slot",
])
def test_compound_class_words(name):
    other = f'<div class="{name}"><p>{PARAGRAPHS[0]} Not of the story.</p></div>'
    assert pages.main_text(f"<body>{other}<div>{STORY}</div>{other}</body>") == STORY_TEXT
    assert pages.main_text(f'<body><div class="{name}"><main>{STORY}</main></div></body>') == STORY_TEXT


@pytest.mark.parametrize("page", [
    "<form>Name <input><p>Password <input></form>",
    '<div class="cookie-notice">We use cookies to make your stay with us as pleasant as can be.</div>',
    "<nav><ul><li>One<li>Two<li>Three<li>Four</ul></nav><footer>Imprint</footer>",
    '<section id="comments"><p>One reader.</p><p>Another reader.</p><p>And a third.</p></section>',
])
def test_pages_without_an_article(page):
    assert pages.main_text(f"<html><body>{page}</body></html>") == ""


def test_surge_and_dive():
    advert = '<div class="ad">Buy one, get one.</div>'
    link = "<p><a href=/x>Read this other story too</a></p>"
    for before, after in (("<article>", "</article>"), ("<div>", "</div>")):
        text = pages.main_text(f"{before}{SHORT}{advert}{STORY}{advert}{SHORT}{after}")
        assert text == f"The end.\n\n{STORY_TEXT}\n\nThe end."
    assert pages.main_text(f"<div>{STORY}{link}{SHORT}</div>") == f"{STORY_TEXT}\n\nThe end."
    assert pages.main_text(f"<article>{STORY}{link}</article>") == f"{STORY_TEXT}\n\nRead this other story too"
    menu = "".join(f"<li><a href=/{n}>Section {n}</a></li>" for n in range(9))
    imprint = f"<ul>{menu}</ul><div>Imprint</div>"
    assert pages.main_text(f"<div>Tips</div><ul>{menu}</ul><div>{STORY}</div>{imprint}") == STORY_TEXT


def test_page_rows(spark):
    rows = [(1, None, "x"), (None, "<p>a</p>", "y"), (1, "", "z"), (1, None, "x")]
    df = spark.createDataFrame(rows, "page_id long, html string, url string")
    assert [r.text for r in pages.extract(df).collect()] == ["", "a", "", ""]
    assert pages.extract(df.limit(0)).count() == 0


def test_licences(spark, awkward, empty):
    model = licenses.Model(licenses.unlicensed(awkward))
    lines = [p for phrases in licenses.TEMPLATES.values() for p in phrases]
    family = [f for f, phrases in licenses.TEMPLATES.items() for _ in phrases]
    text = "\n".join([*lines, *licenses.SOUNDS_ALIKE, "", "RELEASED under the MIT license!"])
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (None, LONG)], "doc_id long, text string")
    found = [r.licenses for r in licenses.scan(df, model).collect()]
    mine = {x.paragraph: x.family for x in found[0]}
    assert mine == {**dict(enumerate(family)), len(lines) + len(licenses.SOUNDS_ALIKE) + 1: "mit"}
    assert found[1:] == [[], [], []]
    assert licenses.scan(awkward, model).count() == len(TEXTS) + 1
    assert licenses.scan(empty, licenses.Model(licenses.unlicensed(empty))).count() == 0


def test_licences_where_their_words_are_common(spark):
    plain = [
        "Her rights were reserved by the court.", "The reserved seats gave rights to nobody.", "He reserved all of it.",
        "Rights and duties belong together.", "The license was released under the old rules.", "A new version of the work.",
        "The driver lost a license.", "They released a license under protest.", "MIT released the film.", "Reserved for you.",
        "Lizenz mit Rechten, mit Version und mit Bedingungen.", "Mit der Zeit kam mit dem Wind mit der Flut Regen.",
        "The public domain of general interest.", "A general of the public guard, licensed to sell.", "CC of BY streets.",
        "Work under the general license of public law.", "Universal terms of commons and creative people.",
        "This work is subject to the conditions of the source.", "Any person may use the following form.",
    ]
    rows = [(n, "\n".join(f"{line} {w}" for line in plain)) for n, w in enumerate(["Today.", "Again.", "Never.", "Often."])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = licenses.Model(licenses.unlicensed(docs))
    for word in ("rights", "reserved", "license", "released", "mit"):
        assert word not in model.features
    held = {*model.triggers, *model.trigger_pairs}
    assert all(held & licenses.ngrams_of(g.split()) for g in model.features)
    lines = [p for phrases in licenses.TEMPLATES.values() for p in phrases]
    family = [f for f, phrases in licenses.TEMPLATES.items() for _ in phrases]
    found = licenses.scan(spark.createDataFrame([(1, "\n".join(lines + plain))], "doc_id long, text string"), model)
    mine = {x.paragraph: x.family for x in found.first().licenses}
    assert mine == dict(enumerate(family))


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_rows(spark, awkward, empty, module, label):
    rows = [(0, 1), (4, 0), (3, None), (6, 2), (5, 0), (5, 1)]
    labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
    for known in (labels, labels.limit(0)):
        model = module.fit(awkward, known, label)
        scores = [
            r.score
            for r in awkward.select(module.score(F.col("text"), model, spark).alias("score")).collect()
        ]
        assert len(scores) == len(TEXTS) + 1 and all(0 <= s <= 1 for s in scores)
        assert scores[0] == scores[-1] and scores[1] == scores[2]
    assert module.fit(empty, labels.limit(0), label) is not None
    kept = quality.only_good(awkward, labels.withColumn("quality", F.lit(1)))
    assert kept.columns == awkward.columns


@pytest.mark.parametrize(
    "name,label,module", [("op5_quality", "quality", quality), ("op10_toxicity", "toxic", toxicity)]
)
def test_held_out_accuracy(spark, name, label, module):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = module.query(spark, folder).join(labels, "doc_id").where("held_out")
    right = out.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]
    assert right >= 0.9


def test_training_leaves_the_held_out_fold_alone(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    flipped = labels.withColumn(
        "toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic"))
        .otherwise(F.col("toxic"))
    )
    assert labelled(docs, labels, "toxic", 4, 2, 500) == labelled(docs, flipped, "toxic", 4, 2, 500)


P256 = der(0x30, der(2, b"\x01"), der(4, b"\x22" * 32), der(0xA0, b"\x06\x08" + b"\x2a" * 8), der(0xA1, b"\x03\x42" + b"\x01" * 66))
SSH = b"openssh-key-v1\0" + b"".join(
    [len(f).to_bytes(4, "big") + f for f in (b"none", b"none", b"")]
    + [b"\0\0\0\1"] + [len(f).to_bytes(4, "big") + f for f in (b"p" * 51, b"q" * 136)]
)


def wrap(text, width, gap="\n"):
    return gap.join(text[i : i + width] for i in range(0, len(text), width))


@pytest.mark.parametrize("key", [PKCS1, PKCS8, SEC1, P256, SSH])
@pytest.mark.parametrize("width", [20, 64, 76, 10_000])
@pytest.mark.parametrize("gap", ["\n", "\r\n", "\n    ", "\\n", "\\r\\n"])
def test_wrapped_keys_are_found_whole(key, width, gap):
    for plain in (base64.b64encode(key).decode(), key.hex(), key.hex().upper()):
        text = wrap(plain, width, gap)
        for before, after in (("key: ", " there"), ('{"k":"', '"}'), ("", ""), ("see" + gap, gap + "word" + gap)):
            spans = secrets.find_spans(before + text + after)
            assert (len(before), "key", len(before) + len(text)) in spans
    broken = bytearray(key)
    at = 1 if key[1] < 128 else 3
    broken[at if key[0] == 0x30 else 18] ^= 1
    for plain in (base64.b64encode(broken).decode(), broken.hex()):
        assert not any(k == "key" for _, k, _ in secrets.find_spans(wrap(plain, width, gap)))


def test_keys_in_strings_and_after_0x():
    body = wrap(base64.b64encode(PKCS8).decode(), 64, "\\n")
    armour = f"-----BEGIN PRIVATE KEY-----\\n{body}\\n-----END PRIVATE KEY-----"
    text = '{"private_key": "' + armour + '\\n"}'
    assert (17, "key", 17 + len(armour)) in secrets.find_spans(text)
    assert (4, "key", 4 + 2 * len(SEC1)) in secrets.find_spans(f"= 0x{SEC1.hex()};")
    assert (4, "key", 4 + 2 * len(PKCS1) + 2 * len(PKCS1) // 64 - (2 * len(PKCS1) % 64 == 0)) in secrets.find_spans(
        f"= 0x{wrap(PKCS1.hex(), 64)};"
    )
    lines = f"-----BEGIN PRIVATE KEY-----\n{wrap(base64.b64encode(PKCS8).decode(), 64)}\n-----END PRIVATE KEY-----\n"
    twice = wrap(base64.b64encode(lines.encode()).decode(), 76, "\n  ")
    assert secrets.find_spans(twice + "\nword") == [(0, "key", len(twice))]
    assert secrets.find_spans("MIT\nMILAN\nMAP\nMIIE\n" * 200) == []
