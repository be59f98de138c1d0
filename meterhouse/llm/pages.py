"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block element with text; elements that are no part of an
article (menus, headers, footers, sidebars, notices, adverts, forms, reader comments) are stripped like
markup. A line weighs its length, or nothing if links make up most of it. Weights are summed over windows
of ``WINDOW`` lines. Text begins at a surge, the first window whose sum reaches ``SHARE`` of the highest
sum, and ends at a dive, the last such window; weighty lines that touch one, such as a headline, belong to
the text. All weighty lines between the first surge and the last dive are kept whole.

Names and class words only weigh in:

* Where a page marks its article, by element or else by class, and the marked lines hold at least half of
  the weight, the other lines weigh nothing and links inside count as text.
* An element that its class, or being a form, a header or an aside, sets apart is stripped unless it
  holds ``MOST`` of the page's weight in a window of lines or more, or half of it with the page's heading
  or main element: then it is what the page is built in, and its name is disregarded. A wrapper of reader
  comments needs the latter.

Pages are read row by row, so nothing is shuffled. A null or empty page, and one without a weighty line,
has the empty text. Null ids, repeated rows and further columns pass through. Unclosed, misnested and cut
off elements end with the element around them or with the page.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 3  # lines
SHARE = 0.1  # of the highest sum, at a surge or dive
MOST = 0.8  # of a page's weight, in an element that is its frame whatever it is called
LINKS = 0.5  # of a line's characters

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)"
    r"(?P<attributes>[^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*)(?:>|(?=<)|\Z)"
    r"|<[!?/][^<>]*>",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(
    r"""(class|id|role|style|hidden|aria-hidden)\b\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
    re.IGNORECASE,
)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Element names of the markup language, by what they do here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
SKIPPED = set(
    "head title nav footer button select option dialog menu search object audio video "
    "canvas map applet label input".split()
)
DOUBTED = {"aside", "form", "fieldset", "header"}  # no part of an article unless they hold it
MARKED = {"article", "main"}
HEADING = {"h1", "main"}
SELF_CLOSING = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
# Words in classes, ids and roles of elements that are no part of an article.
APART = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo "
    "promotion promoted cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription signup paywall sidebar sidebars aside complementary "
    "widget widgets related recommended recommendations suggestions trending popular share sharing "
    "social breadcrumb breadcrumbs menu menus nav navbar navigation toolbar masthead topbar footer "
    "contentinfo copyright legal disclaimer comment comments commentary disqus reply replies respond "
    "discussion responses feedback pagination pager login register search form skip dialog print "
    "toc rail outbrain taboola".split()
)
READERS = set(
    "comment comments commentary disqus reply replies respond discussion responses feedback".split()
)
# Beginnings and ends of compound words of the same kinds.
READER_STEMS = ("comment", "disqus")
APART_STEMS = (
    *READER_STEMS, "advert", "sponsor", "sidebar", "cookie", "newsletter", "breadcrumb", "footer", "related", "popup"
)
APART_ENDS = ("nav", "navbar", "menu", "sidebar", "footer", "banner", "comments")
HEADERS = {"header", "head", "masthead"}
CONTENT = set("article content entry story post main text body prose".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Wrapper:
    """An element set apart by its name or class, and whether it holds readers' text or a heading."""

    readers: bool
    heading: bool


@dataclass
class Element:
    name: str
    skipped: bool  # it or an element around it is never part of an article
    apart: bool  # the same, wrappers included
    wrappers: tuple[int, ...]  # numbers of the wrappers around it, its own included
    marked: bool  # it or an element around it is marked as the article
    likely: bool  # the same by its class or id only
    link: bool


@dataclass
class Line:
    text: str
    links: int
    element: Element | None

    @property
    def apart(self) -> bool:
        return self.element is not None and self.element.apart

    @property
    def mostly_links(self) -> bool:
        return self.links > LINKS * len(self.text)


def is_apart(words: set[str]) -> bool:
    return any(w in APART or w.startswith(APART_STEMS) or w.endswith(APART_ENDS) for w in words)


def is_readers(words: set[str]) -> bool:
    return any(w in READERS or w.startswith(READER_STEMS) or w.endswith("comments") for w in words)


def element_of(
    name: str, attributes: str, parent: Element | None, wrappers: list[Wrapper], frames: set[int]
) -> Element:
    """The element within ``parent``; adds a wrapper if it is one. ``frames``: wrappers not set apart."""
    words, hidden = set(), False
    for m in ATTRIBUTE.finditer(attributes) if attributes.strip(" /") else ():
        key, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
        if key in ("class", "id", "role"):
            words.update(w.lower() for w in WORD.findall(value))
        elif key == "style":
            hidden |= bool(HIDDEN.search(value))
        else:
            hidden |= value.lower() != "false"
    root = name in ("html", "body")
    within = parent is not None and (parent.marked or parent.likely)
    around = parent.wrappers if parent else ()
    skipped = (parent is not None and parent.skipped) or (not root and (name in SKIPPED or hidden))
    if name in HEADING:
        for n in around:
            wrappers[n].heading = True
    if within:
        doubted = name in DOUBTED - {"header"} or is_apart(words)
    else:
        doubted = name in DOUBTED or is_apart(words) or bool(words & HEADERS)
    if doubted and not root and name != "main":
        readers = is_readers(words)
        around = (*around, len(wrappers))
        wrappers.append(Wrapper(readers, name in MARKED and not readers))
    return Element(
        name,
        skipped,
        skipped or not frames.issuperset(around),
        around,
        (parent is not None and parent.marked) or name in MARKED,
        within or (not root and bool(words & CONTENT)),
        name == "a" or (parent is not None and parent.link),
    )


def lines_of(page: str, wrappers: list[Wrapper], frames: set[int]) -> list[Line]:
    """Lines of text in page order, one for each block; fills ``wrappers``."""
    lines: list[Line] = []
    stack: list[Element] = []
    parts: list[str] = []
    links = 0
    owner: Element | None = None

    def end_line() -> None:
        nonlocal links, owner
        text = " ".join("".join(parts).split())
        if text:
            lines.append(Line(text, links, owner))
        parts.clear()
        links, owner = 0, None

    def add(chunk: str) -> None:
        nonlocal links, owner
        if not chunk:
            return
        text = html.unescape(chunk) if "&" in chunk else chunk
        top = stack[-1] if stack else None
        if text.strip():
            if owner and top and owner.apart != top.apart:
                if top.apart:
                    return  # an inline element that is no part of the block around it
                end_line()
            owner = owner or top
            if top and top.link:
                links += len(text.strip())
        parts.append(text)

    def close(names: set[str], barrier: set[str]) -> bool:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name in names:
                del stack[i:]
                return True
            if stack[i].name in barrier:
                return False
        return False

    at = 0
    for m in TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        block = name in BLOCKS
        if block:
            end_line()
        if name == "br":
            parts.append(" ")
        elif m["end"]:
            close({name}, set() if block else BLOCKS)
        else:
            if block:
                close({"p"}, BLOCKS - {"p"})
                if name in SELF_CLOSING:
                    close(SELF_CLOSING[name], {"ul", "ol", "dl", "table", "select", "div", "menu"})
            if name not in VOID and not m["attributes"].endswith("/"):
                around = stack[-1] if stack else None
                stack.append(element_of(name, m["attributes"], around, wrappers, frames))
    add(page[at:])
    end_line()
    return lines


def frames_of(lines: list[Line], wrappers: list[Wrapper]) -> set[int]:
    """Wrappers that hold so much of the page that they are its frame."""
    total, held, count = 0, [0] * len(wrappers), [0] * len(wrappers)
    for line in lines:
        if not line.mostly_links and not (line.element and line.element.skipped):
            total += len(line.text)
            for n in line.element.wrappers if line.element else ():
                held[n] += len(line.text)
                count[n] += 1
    return {
        n
        for n, (wrapper, weight) in enumerate(zip(wrappers, held, strict=True))
        if weight
        and (
            (wrapper.heading and 2 * weight >= total)
            or (not wrapper.readers and weight >= MOST * total and count[n] >= WINDOW)
        )
    }


def weights_of(lines: list[Line]) -> list[int]:
    """The weight of each line: none for links, or outside of where the page marks most of its weight."""
    plain = [0 if line.mostly_links else len(line.text) for line in lines]
    for mark in ("marked", "likely"):
        inside = [line.element is not None and getattr(line.element, mark) for line in lines]
        if 0 < sum(plain) <= 2 * sum(w for w, here in zip(plain, inside, strict=True) if here):
            return [len(line.text) if here else 0 for line, here in zip(lines, inside, strict=True)]
    return plain


def main_text(page: str | None) -> str:
    wrappers: list[Wrapper] = []
    lines = lines_of(page or "", wrappers, set())
    frames = frames_of(lines, wrappers)
    if frames:
        lines = lines_of(page or "", [], frames)
    lines = [line for line in lines if not line.apart]
    weights = weights_of(lines)
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    level = max(SHARE * max(sums, default=0), 1)
    dense = [i for i, total in enumerate(sums) if total >= level]
    if not dense:
        return ""
    surge, dive = dense[0], min(dense[-1] + WINDOW, len(weights)) - 1
    while surge and weights[surge - 1]:
        surge -= 1
    while dive + 1 < len(weights) and weights[dive + 1]:
        dive += 1
    kept = zip(lines[surge : dive + 1], weights[surge : dive + 1], strict=True)
    return "\n\n".join(line.text for line, weight in kept if weight)


@F.arrow_udf(T.StringType())
def extracted(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(p.as_py()) for p in pages], pa.string())


def extract(pages: DataFrame, page: str | Column = "html", text: str = "text") -> DataFrame:
    """Adds ``text``, the main text of each page."""
    return pages.withColumn(text, extracted(F.col(page) if isinstance(page, str) else page))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
