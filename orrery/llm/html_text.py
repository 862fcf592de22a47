"""Main text of HTML pages by line-block distribution.

Markup is stripped to one line per block element. Every line has a text length; the
length of a line block is the sum over a sliding window of lines. Where this sum surges
from nothing above a threshold the main text begins, where it dives back to nothing it
ends, and the lines between are kept, so that short lines inside the text stay. Short and
linked lines between the first surge and the last dive stay as well, and so does a heading
that only furniture divides from the first surge.

Lines of page furniture (navigation, notices, adverts, forms, reader comments and the
like, told by element, role, class, id or a hiding style) and link text count as empty
lines: they end a run of text. A class or id tells furniture where the head word of a name
does (``page-footer``, not ``post-header`` or ``has-sidebar``) or all its words do
(``cookie-message``). Menus, which are lists of ``MENU`` or more items that are all links and
lines of as many links, are never kept. Where a page marks its article, only lines inside
take part, and any text there is a surge: short and linked ones stay as well.

Null or empty pages give an empty text; a page without any text line does too.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math object".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split())
FURNITURE = frozenset(
    "head nav header footer aside form button select option menu dialog label input fieldset datalist".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar header masthead footer cookie cookies consent gdpr notice notices alert "
    "popup modal overlay comment comments discussion disqus respond reply replies related recommended recommendations "
    "share sharing social subscribe subscription newsletter signup login pagination pager skip copyright rail".split())
#: Words that leave a name of furniture what it is.
FILLER_NAMES = frozenset(
    "area bar block body bottom box btn button buttons container desktop global group icon icons inner item items large left "
    "link links list main message mobile outer page panel policy posts right section site slot small stories text thread "
    "title top unit user widget wrap wrapper".split())
#: Words before a name of furniture that say something else of the element.
OTHER_NAMES = frozenset("has hide hides no non not show shows with without".split())
#: Parts of an article: their headers belong to it.
PART_NAMES = frozenset("article blog card chapter content entry post recipe story".split())
HEADER_NAMES = frozenset("header banner masthead".split())
#: Items, all links, that make a list a menu, and links, without other text, that make a line one.
MENU = 3
#: Furniture whose own articles are not the page's.
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor promo promoted promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar rail footer comment comments discussion disqus respond reply replies related recommended "
    "recommendations".split())
REMARK_NAMES = frozenset("comment comments discussion disqus respond reply replies".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME = re.compile(r"[A-Za-z]+")
_HIDING = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes); kinds: text, open, close. Comments and raw elements are left out."""
    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        if page.startswith("<!--", lt):
            stop = page.find("-->", lt + 4)
            at = end if stop < 0 else stop + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            stop = page.find(">", lt)
            at = end if stop < 0 else stop + 1
            continue
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not m:
            if page[lt + 1:lt + 2].isalpha() or page[lt + 1:lt + 2] == "/":
                return  # a tag that the end of the page cuts
            yield "text", "<", ""
            at = lt + 1
            continue
        at, name = m.end(), m[2].lower()
        if m[1]:
            yield "close", name, ""
        elif name in RAW and not m[3].rstrip().endswith("/"):
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            if not stop:
                return
            at = page.find(">", stop.end() - 1) + 1 or end
        else:
            yield "open", name, m[3]


def _furniture_words(value: str) -> set[str]:
    """The words of furniture in those names of a class or id that tell furniture."""
    out: set[str] = set()
    for name in value.split():
        own = [x.lower() for x in _NAME.findall(_CAMEL.sub(" ", name))]
        told = [x for x in own if x not in FILLER_NAMES]
        if not told or OTHER_NAMES.intersection(own) or told[-1] in HEADER_NAMES and PART_NAMES.intersection(own):
            continue
        if told[-1] in FURNITURE_NAMES or FURNITURE_NAMES.issuperset(told):
            out |= FURNITURE_NAMES.intersection(told)
    return out


def _furniture(name: str, attrs: str, in_article: bool) -> int:
    """0: no furniture; 1: furniture whole; 2: furniture by a class or id, but for an article in it."""
    if name in FURNITURE and not (name == "header" and in_article):
        return 1
    if "=" not in attrs:
        return int(bool(attrs) and re.search(r"(?:^|\s)hidden(?:\s|/|$)", attrs) is not None)
    found = 0
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), a or b or c
        if key == "role" and value.lower() in FURNITURE_ROLES or key == "aria-hidden" and value.lower() == "true":
            return 1
        if key == "style" and _HIDING.search(value):
            return 1
        if key in ("class", "id") and name not in ("html", "body", "main") and name not in HEADINGS:
            own = _furniture_words(value)
            if name == "article":
                own &= REMARK_NAMES
            if own:
                found = 1 if found == 1 or own & ASIDE_NAMES else 2
    return found


def text_lines(page: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, bool]:
    """One line per block, its length without link text (0: furniture, menu, or outside the article; 1 at least
    inside it), whether it is a heading, whether it may be kept, and whether an article is marked."""
    lines: list[str] = []
    sizes: list[int] = []
    inside: list[bool] = []
    titles: list[bool] = []
    anchors: list[int] = []  # of lines that are all link text, otherwise 0
    of_list: list[int] = []
    parts: list[str] = []
    linked = here = n_lists = 0
    lists = [0]
    stack: list[tuple[str, int, bool]] = []  # name, furniture, article
    hidden = article = links = headings = 0

    def flush() -> None:
        nonlocal linked, here
        if parts:
            line = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if line:
                lines.append(line)
                sizes.append(max(len(line.replace(" ", "")) - linked, 0))
                inside.append(article > 0)
                titles.append(headings > 0)
                anchors.append(0 if sizes[-1] else max(here, 1))
                of_list.append(lists[-1])
            linked = here = 0

    def gap() -> None:
        if lines and lines[-1] != "":
            lines.append("")
            sizes.append(0)
            inside.append(article > 0)
            titles.append(False)
            anchors.append(0)
            of_list.append(0)

    def pop(to: int) -> None:
        nonlocal hidden, article, links, headings
        while len(stack) > to:
            name, furniture, main = stack.pop()
            hidden -= furniture > 0
            article -= main
            links -= name == "a"
            headings -= name in HEADINGS
            if name in ("ul", "ol"):
                lists.pop()

    for kind, name, attrs in _tokens(page):
        if kind == "text":
            if not hidden:
                parts.append(name)
                if links:
                    linked += len("".join(html.unescape(name).split()))
            continue
        if name in BLOCK:
            flush()
        if kind == "open":
            if name in BLOCK and name != "br":
                ends = _CLOSES.get(name, set())
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p" or stack[i][0] in ends:
                        pop(i)
                        break
                    if stack[i][0] in BLOCK:
                        break
            if name in VOID:
                continue
            furniture = _furniture(name, attrs, article > 0)
            if name == "article" and not furniture and hidden and all(f != 1 for _, f, _ in stack):
                flush()
                gap()
                stack[:] = [(n, 0, m) for n, _, m in stack]  # what holds the article is no furniture
                hidden = 0
            main = name in ("article", "main") and not furniture and not hidden
            if furniture:
                flush()
                gap()
            if attrs.rstrip().endswith("/") and name not in BLOCK:
                continue
            stack.append((name, furniture, main))
            hidden += furniture > 0
            article += main
            links += name == "a"
            here += name == "a"
            headings += name in HEADINGS
            if name in ("ul", "ol"):
                n_lists += 1
                lists.append(n_lists)
        else:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop(i)
                    break
    flush()
    marked = any(inside)
    size, links_only, owner = np.array(sizes, np.int64), np.array(anchors, np.int64), np.array(of_list, np.int64)
    items, linked_items = np.bincount(owner, minlength=1), np.bincount(owner, links_only > 0, minlength=1)
    menu = (links_only >= MENU) | (owner > 0) & (items >= MENU)[owner] & (items == linked_items)[owner]
    may = ~menu & np.array([x != "" for x in lines], bool)
    if marked:
        may &= np.array(inside, bool)
        size = np.maximum(size, 1)
    return lines, np.where(may, size, 0), np.array(titles, bool), may, marked


def main_lines(size: np.ndarray, width: int = 3, surge: int = 80) -> np.ndarray:
    """Which lines lie between a surge and the dive after it.

    A run is a stretch of lines without an empty one. The line block at i sums lines
    i .. i + width - 1; a run is text if one of its blocks surges to ``surge``
    characters, or to a third of the page's largest block where that is less.
    """
    keep = np.zeros(len(size), bool)
    if not len(size) or not size.max():
        return keep
    total = np.concatenate([[0], np.cumsum(size)])
    block = total[np.minimum(np.arange(len(size)) + width, len(size))] - total[:-1]
    threshold = min(surge, -(-int(block.max()) // 3))
    ink = np.concatenate([[False], size > 0, [False]])
    for start, dive in zip(np.flatnonzero(~ink[:-1] & ink[1:]), np.flatnonzero(ink[:-1] & ~ink[1:])):
        if block[start:dive].max() >= threshold:
            keep[start:dive] = True
    return keep


def main_text(page: str | None, width: int = 3, surge: int = 80) -> str:
    if not page:
        return ""
    lines, size, titles, may, marked = text_lines(page)
    keep = main_lines(size, width, 1 if marked else surge)
    if keep.any():
        first, last = np.flatnonzero(keep)[[0, -1]]
        while first and (titles[first - 1] or not may[first - 1]):
            first -= 1
        keep[first:last + 1] = True
    return " ".join(x for x, k in zip(lines, keep & may) if k)


def extract_main_text(pages: DataFrame, html_column: str = "html", into: str = "text", width: int = 3, surge: int = 80) -> DataFrame:
    """``pages`` with the main text of each page in a column ``into`` (replaced if there); other columns and all rows stay."""

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_ in batches:
            yield pd.Series([main_text(x, width, surge) for x in pages_], dtype=object)

    return pages.withColumn(into, text_of(F.col(f"`{html_column}`").cast("string")))
