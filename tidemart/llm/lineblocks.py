"""Main text of web pages by the distribution of line blocks.

Markup is stripped into lines, one per block element: elements that run inside a line add nothing, a line break is a
blank. Lines inside elements that by tag, role, class or id are menus, headers, footers, sidebars, notices, adverts,
forms or reader comments are taken out, and so are scripts, styles and comments of the markup (a frame around a marked
article or main part is no menu, whatever its class). Over the lengths of the lines left (a line that is mostly
links counts as empty) sums of `window` successive lines are taken. Text surges at
a line whose window reaches `surge` characters (or the page's highest sum, if that is less) and dives where
a window is empty; the lines between are kept, short ones and those of links too, and headings right above a surge. Where a page
marks an article or main part, the mark is a weight: a character inside counts `MAIN_WEIGHT` times, the part's own highest
sum is enough there, and windows end at its edges, so that text outside has to surge by itself. Character references are decoded, white
space inside a line becomes one blank, and lines are joined by an empty line.

Null pages are empty and give an empty text. Unclosed elements end with the element around them; an unclosed comment,
script or style runs to the end of the page. Each page is judged alone, in time linear in its length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.rows import quoted, with_results

WINDOW, SURGE = 3, 80
LINK_SHARE = 0.5
MAIN_WEIGHT = 4

#: Fixed values of the markup language.
RAW = frozenset("script style textarea title noscript template svg math iframe object canvas select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output q rb rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
#: Elements that never hold the article, and words of roles, classes and ids that say the same.
ASIDE_TAGS = frozenset("nav header footer aside form menu dialog button head fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar side aside widget footer header masthead topbar toolbar cookie cookies consent gdpr notice alert popup "
    "modal overlay newsletter subscribe subscription signup login search share sharing social related recommended recommendations comment "
    "comments commentlist reply replies disqus respond pagination pager copyright legal skip".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Of these words, the ones that frames around a whole page carry as well ("with-sidebar"): an article inside takes it back.
FRAME_WORDS = frozenset("nav navbar navigation menu sidebar side widget footer header masthead topbar banner cookie cookies consent notice alert modal overlay".split())
MAIN_TAGS = frozenset(("article", "main"))

_open = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*))")
_rest = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_attribute = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_word = re.compile(r"[a-z]+")


@dataclass
class Element:
    tag: str
    aside: bool
    main: bool
    frame: bool = False  # an aside by a word that frames carry


@dataclass
class Line:
    text: str
    linked: int  # characters inside links
    main: bool
    heading: bool = False


def aside_of(tag: str, attributes: str, in_main: bool) -> tuple[bool, bool]:
    """Whether an element holds no part of the article, and whether only a word says so that frames carry too.
    An article may have a header of its own, and a comment may be marked as an article."""
    if tag in ASIDE_TAGS and not (tag == "header" and in_main):
        return True, False
    if "=" not in attributes or tag in ("html", "body", "main"):
        return False, False
    frame = False
    for name, *values in _attribute.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value in ASIDE_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True, False
        if name in ("class", "id"):
            words = ASIDE_WORDS.intersection(_word.findall(value))
            if words - FRAME_WORDS:
                return True, False
            frame = frame or tag != "article" and bool(words - {"header"} if in_main else words)
    return frame, frame


def page_lines(page: str) -> list[Line]:
    """Lines of text outside the elements that hold no article, in page order."""
    lines: list[Line] = []
    stack: list[Element] = []
    parts: list[str] = []
    linked = 0
    asides = mains = links = 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece and not asides:
            decoded = html.unescape(piece) if "&" in piece else piece
            parts.append(decoded)
            if links:
                linked += len(decoded)

    def end_line() -> None:
        nonlocal linked
        line = " ".join("".join(parts).split())
        if line:
            lines.append(Line(line, linked, mains > 0, any(element.tag in HEADINGS for element in stack)))
        parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal asides, mains
        gone = stack.pop()
        asides -= gone.aside
        mains -= gone.main

    at, size = 0, len(page)
    while at < size:
        found = _open.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        comment, mark, closing, tag = found.groups()
        if comment:
            end = page.find("-->", found.end())
            at = size if end < 0 else end + 3
            continue
        rest = _rest.match(page, found.end())
        end = rest.end() if rest else page.find(">", found.end()) + 1
        if not end:  # no end of the tag: nothing more is text
            break
        attributes, at = page[found.end() : end - 1], end
        if mark:
            continue
        tag = tag.lower()
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE:
                continue
            end_line()
            if any(element.tag == tag for element in stack):
                while stack[-1].tag != tag:
                    pop()
                pop()
        elif tag == "br":
            text(" ")
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
        elif tag in INLINE:
            links += tag == "a"
        else:
            end_line()
            links = 0
            if stack and stack[-1].tag == "p" or stack and stack[-1].tag == tag and tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
                pop()
            if tag == "body":
                while stack and stack[-1].tag == "head":
                    pop()
            if tag not in VOID and not attributes.endswith("/"):
                aside, frame = aside_of(tag, attributes, mains > 0)
                if tag in MAIN_TAGS and not aside and not mains:
                    for outer in stack:
                        if outer.frame and outer.aside:
                            outer.aside = False
                            asides -= 1
                element = Element(tag, aside, tag in MAIN_TAGS, frame)
                stack.append(element)
                asides += element.aside
                mains += element.main
    end_line()
    return lines


def window_sums(lengths: list[int], window: int) -> list[int]:
    """Sums of each line and the `window` - 1 after it."""
    n = len(lengths)
    total = 0
    sums = [0] * n
    for i in range(n - 1, -1, -1):
        total += lengths[i] - (lengths[i + window] if i + window < n else 0)
        sums[i] = total
    return sums


def between_surges_and_dives(lengths: list[int], window: int = WINDOW, surge: int = SURGE) -> list[bool]:
    """Whether each line lies between a surge and the dive after it."""
    n = len(lengths)
    sums = window_sums(lengths, window)
    level = min(surge, max(sums, default=0))
    kept, inside = [False] * n, False
    for i in range(n):
        if inside and not sums[i]:
            inside = False
        elif not inside and level and sums[i] >= level and lengths[i]:
            inside = True
        kept[i] = inside and (lengths[i] > 0 or bool(sums[i]))
    return kept


def main_text(page: str, window: int = WINDOW, surge: int = SURGE) -> str:
    lines = page_lines(page)
    lengths = [0 if line.linked > LINK_SHARE * len(line.text) else len(line.text) * (MAIN_WEIGHT if line.main else 1) for line in lines]
    edges = [i for i in range(1, len(lines)) if lines[i].main != lines[i - 1].main]
    parts = [slice(*ends) for ends in zip([0, *edges], [*edges, len(lines)], strict=True)]
    highest = [max(window_sums(lengths[part], window), default=0) for part in parts]
    kept: list[bool] = []
    for part, high in zip(parts, highest, strict=True):
        own = lengths[part]
        surges = high >= min(surge, max(highest)) or lines and lines[part.start].main
        kept += between_surges_and_dives(own, window, surge) if surges else [False] * len(own)
    for i in range(len(lines) - 2, -1, -1):  # headings right above a surge
        kept[i] = kept[i] or kept[i + 1] and lines[i].heading and lengths[i] > 0
    return "\n\n".join(line.text for line, keep in zip(lines, kept, strict=True) if keep)


def extracted(page: Column, window: int = WINDOW, surge: int = SURGE) -> Column:
    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(page, window, surge) for page in pages], dtype=object)

    return texts(F.coalesce(page.cast("string"), F.lit("")))


def extract_pages(pages: DataFrame, html_column: str = "html", window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """`pages` with `text` and `n_chars` (its code points) instead of the markup; input columns of these names give way."""
    spare = "extracted" + "_" * max(map(len, pages.columns))
    found = pages.withColumn(spare, extracted(F.col(quoted(html_column)), window, surge)).drop(html_column)
    return with_results(found, {"text": F.col(spare), "n_chars": F.length(spare).cast("long")}).drop(spare)
