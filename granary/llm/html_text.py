"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one for each block of text; blank lines stand where sections of the page begin and end.
Lines of menus, headers, footers, sidebars, notices, adverts, forms and reader comments (by element, role or the words
of their class and id) count as blank, as do lines that are mostly links. Over the lines' text lengths a window of
``WINDOW`` lines slides: a region surges where the window first holds text and dives where it holds none; regions
whose fullest window reaches the threshold are kept from surge to dive, and short ones (headings) that follow or precede them
with no dropped line between. Where a page marks its article or main
element, only lines inside are text, and all its regions stay. An article in a dropped section that is closed after it
(a teaser card) marks the page only when no other article does and it holds more text than all that counts elsewhere.

Defined cases: null and empty pages give an empty text; text outside any tag is a block; unclosed elements end with
their parent; raw elements (scripts, styles and the like) that are never closed reach to the end, but
``<svg/>`` and ``<math/>`` end at once; very long pages need
no special case, the scan is linear; repeated rows and other columns don't matter.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80  # characters in the fullest window of a region; half of the page's fullest one, if that is less

_RAW = "script|style|noscript|template|textarea|select|svg|math|iframe|object|title|button"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|$)|<(?:svg|math)(?:\s[^>]*)?/>|<({_RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|$)|<[!?][^>]*(?:>|$)"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\s[^<>"']*(?:"[^"]*"[^<>"']*|'[^']*'[^<>"']*)*|[^>]*))>|<(?=[/a-zA-Z])[^>]*$""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)

_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_SECTIONS = set("article main section nav header footer aside form body html".split())
_DROPPED = set("nav footer aside form head dialog menu fieldset".split())
_DROPPED_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
# Words of a class or id that mark what is not the article.
_DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar rail widget footer masthead"
    " comment comments reply replies disqus respond share sharing social follow related recommended newsletter subscribe signup"
    " login search toolbar pagination pager skip copyright disclaimer".split()
)
# Words that only say what kind of box a marked one is: with them a compound class still marks a block of an article.
_BOX_WORDS = set(
    "box block bar area list lists item items link links button buttons icon icons wrapper wrap container section group inner outer"
    " slot unit panel posts stories articles content form top bottom left right main js".split()
)
_COMMENT_WORDS = {"comment", "comments", "reply", "replies", "disqus", "respond"}
_NEGATIONS = {"no", "has", "with", "without", "not"}


@dataclass
class _Element:
    first: int  # the line it begins with
    name: str
    dropped: bool
    comments: bool
    article: bool


def _words(value: str) -> list[str]:
    return re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())


def _marks(value: str, inside: bool) -> set[str]:
    """Words of a class or id that mark a dropped section.

    Inside an article a name counts as a whole: ``share-price``, ``ad-hoc`` or ``search-results`` name a part of the text,
    ``share``, ``share-buttons`` or ``related-posts`` don't.
    """
    found: set[str] = set()
    for name in value.split():
        words = _words(name)
        marks = {w for w, before in zip(words, ["", *words], strict=False) if w in _DROPPED_WORDS and before not in _NEGATIONS}
        if not inside or all(w in _DROPPED_WORDS or w in _BOX_WORDS for w in words):
            found |= marks
    return found


def _mark(first: int, name: str, attributes: str, above: _Element | None) -> _Element:
    """What an element is, from its name, its attributes and the element around it."""
    inside = bool(above and above.article)
    dropped, comments = name in _DROPPED or (name == "header" and not inside), False
    if attributes and name not in ("html", "body"):
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id"):
                marks = _marks(value, inside or name in ("article", "main"))
                dropped |= bool(marks)
                comments |= bool(marks & _COMMENT_WORDS)
            elif key == "role":
                dropped |= value.lower() in _DROPPED_ROLES
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                dropped = True
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                dropped = True
    if above is None:
        return _Element(first, name, dropped, comments, name in ("article", "main"))
    comments |= above.comments
    article = above.article or name in ("article", "main")
    if name in ("article", "main") and not dropped and not comments:
        return _Element(first, name, False, False, True)  # a stray open menu or advert doesn't hold the article
    return _Element(first, name, dropped or above.dropped, comments, article)


_OUTSIDE, _INSIDE, _CARD = 0, 1, 2  # of an article; in an article of a dropped section


def lines_of(page: str) -> list[tuple[str, int, int]]:
    """(text, characters that count, whether inside an article) of every line; blank lines between sections."""
    lines: list[tuple[str, int, int]] = []
    articles: list[int] = []  # lines inside articles, of no dropped section so far
    stack: list[_Element] = []
    text: list[str] = []
    linked = 0  # characters of link text in the open line
    in_link = False
    at = 0

    def blank(n: int) -> None:
        lines.extend([("", 0, _OUTSIDE)] * n)

    def close_line() -> None:
        nonlocal linked
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if line:
                top = stack[-1] if stack else None
                inside = bool(top and top.article)
                counts = not (top and top.dropped) and (inside or 2 * linked <= len(line))
                if inside:
                    articles.append(len(lines))
                lines.append((line, len(line) if counts else 0, _INSIDE if inside else _OUTSIDE))
        linked = 0

    def end(element: _Element) -> None:
        """Articles of a dropped section are known as such when it ends."""
        while element.dropped and articles and articles[-1] >= element.first:
            at = articles.pop()
            lines[at] = (*lines[at][:2], _CARD)

    def pop(name: str) -> None:
        if any(e.name == name for e in stack):
            while (element := stack.pop()).name != name:
                pass
            end(element)

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            run = page[at : m.start()]
            text.append(run)
            linked += len(run) if in_link else 0
        at = m.end()
        name = (m[3] or "").lower()
        if not name:  # comments, declarations, raw elements
            continue
        if name == "a":
            in_link = not m[2]
        if name in _INLINE:
            if name == "br":
                text.append(" ")
            elif m[2]:
                if stack and stack[-1].name == name:
                    close_line()
                    end(stack.pop())
            elif m[4] and name not in _VOID and not m[4].endswith("/"):
                mark = _mark(len(lines), name, m[4], stack[-1] if stack else None)
                if mark.dropped and not (stack and stack[-1].dropped):
                    close_line()
                    mark.first = len(lines)
                    stack.append(mark)
            continue
        close_line()
        if m[2]:
            pop(name)
        elif name not in _VOID:
            if stack and stack[-1].name == "p":
                stack.pop()  # a block ends an open paragraph
            if name == "li" and stack and stack[-1].name == "li":
                stack.pop()
            stack.append(_mark(len(lines), name, m[4], stack[-1] if stack else None))
        if name in _SECTIONS and not (stack and stack[-1].article and name not in ("article", "main")):
            blank(WINDOW)
        elif name == "div" and not (stack and stack[-1].article):
            blank(1)
    if at < len(page):
        text.append(page[at:])
    close_line()
    return lines


def main_lines(lines: list[tuple[str, int, int]]) -> list[str]:
    """Lines that count, of the regions between surge and dive."""
    total = [sum(size for _, size, inside in lines if inside == k) for k in (_OUTSIDE, _INSIDE, _CARD)]
    text_in = _INSIDE if total[_INSIDE] else _CARD if total[_CARD] > total[_OUTSIDE] else _OUTSIDE
    marked = text_in != _OUTSIDE
    lines = [(text, size if inside == text_in else 0, inside) for text, size, inside in lines]
    sizes = [size for _, size, _ in lines]
    blocks = [sum(sizes[max(0, i - WINDOW + 1) : i + 1]) for i in range(len(sizes))]  # the window that ends at a line
    threshold = 1 if marked else min(SURGE, max(blocks, default=0) / 2)
    regions: list[tuple[int, int, bool]] = []
    i = 0
    while i < len(lines):
        if not blocks[i]:
            i += 1
            continue
        surge = i
        while i < len(lines) and blocks[i]:
            i += 1
        regions.append((surge, i, max(blocks[surge:i]) >= threshold))
    kept = {k for k, (_, _, full) in enumerate(regions) if full}
    # short regions (a title in its own section) stay with a kept one when no dropped line stands between
    for order, back in ((range(1, len(regions)), -1), (range(len(regions) - 2, -1, -1), 1)):
        for k in order:
            (_, end, _), (start, _, _) = sorted((regions[k], regions[k + back]))
            if k + back in kept and not any(text and not size for text, size, _ in lines[end - WINDOW : start]):
                kept.add(k)
    return [text for k in sorted(kept) for text, size, _ in lines[regions[k][0] : regions[k][1]] if size]


def main_text(page: str | None) -> str:
    return "\n".join(main_lines(lines_of(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every page (``html``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return source.mapInArrow(run, "page_id long, url string, text string")
