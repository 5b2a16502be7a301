"""Main text of web pages by the distribution of line blocks.

1. Strip markup: one linear scan over the html gives a line per block element. Markup of scripts,
   styles, forms and the like, and of elements that by their name, role, class or id are menus,
   headers, footers, sidebars, notices, adverts or comments, gives no text (and parts none: text
   before and after an inline advert is one). Where a sectioning element (article, main, body)
   begins or ends, ``WINDOW`` empty lines are set.
2. Line blocks: the weights of each ``WINDOW`` consecutive lines are summed. A line weighs its
   characters outside links, and nothing if most of it is links (a linked heading: one).
3. Surge and dive: a stretch runs from the line where the sums leave zero to the one after which
   they are zero again, that is, over ``WINDOW - 1`` lines of links at most, and surges if a sum in
   it reaches ``SURGE``. A heading right before the links that end a stretch goes with them.
4. Kept is every surging stretch, or the longest if none surges, with its short lines. Tags only change
   weights: on a page with an article or main element (of several the longest that surges) each line of
   it weighs ``SURGE`` and the lines outside nothing. An article inside a marked element counts only
   against text outside of articles, and not at all inside comments or another article. A short line that
   claims copyright weighs nothing.

Defined results: null or empty html, and a page without text, give an empty text; unclosed and stray
tags are tolerated as in browsers; very long pages are scanned once; repeated rows each get their
row; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import ship_code, table

WINDOW, SURGE = 3, 80
#: Longer tags are taken for stray characters, so that the scan stays linear.
_LONGEST_TAG = 1 << 20

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"""(class|id|role|style|hidden|aria-hidden|aria-label|aria-modal|itemprop)(?![\w-])\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPLIT = re.compile(r"[^A-Za-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_NUMBER = re.compile(r"\d+(?:x\d+)?$")
_SPACE = re.compile(r"\s+")

_RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROP = frozenset("head nav footer header aside form button select option datalist dialog menu svg math canvas object audio video map applet fieldset".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul caption".split()
)
_SECTION = frozenset("article main body".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Of ``_DROP``, what pages also wrap their article in.
_WRAPS = frozenset("header form fieldset".split())
#: Elements whose start ends an open element of the same set.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form status tablist toolbar".split())
#: Words of a class or id that mark an element as something else than the article, if its other
#: words, split at punctuation and capitals, are marks or ``_PLACES`` too.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox adunit banner banners sponsor sponsored sponsors "
    "promo promos promoted promotion nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc sidebar sidebars aside "
    "widget widgets related recommended recommendations footer footnav masthead topbar toolbar header cookie cookies consent gdpr notice "
    "notices popup modal overlay alert newsletter subscribe subscription signup login share sharing social comment comments commentlist "
    "respond disqus replies reply reviews hidden skip skiplink copyright".split()
)
_PLACES = frozenset(
    "site main global top bottom left right primary secondary upper lower mobile desktop sticky fixed wrapper wrap container outer inner "
    "box block area bar panel unit slot zone list item items link links button buttons icon icons form policy thread".split()
)
#: Marks of what readers or other pages add: they also mark compounds with ``_PARTS``, mark an article, and hide
#: the articles inside.
_ADDED = frozenset(
    "comment comments commentlist respond disqus replies reply related recommended recommendations newsletter sponsored".split()
)
_PARTS = frozenset(
    "section sections body content contents text post posts article articles story stories reader readers user users entry entries "
    "author meta count thread feed stream tree root holder region module row col column grid group inline page header footer title".split()
)
_NOTICE = re.compile(r"^\W*(?:©|\(c\)|copyright\b)|all rights reserved", re.I)
_NOTICE_CHARS = 300
#: Marks that do not drop an article, a main element, the body itself, a heading, or code.
_KEPT = frozenset("article main body html pre code".split()) | _HEADING


def _words(token: str) -> Iterator[str]:
    for part in filter(None, _SPLIT.split(token)):
        whole = _NUMBER.sub("", part).lower()
        if not whole or whole in _MARKS or whole in _PLACES or whole in _PARTS:
            yield whole
        else:
            yield from (_NUMBER.sub("", w).lower() for w in _CAMEL.split(part))


def _is_mark(token: str) -> int:
    """0: a class or id that marks nothing; 1: a mark, or a compound of marks and places; 2: one of what
    is added to the article."""
    words = [w for w in _words(token) if w]
    marks = [w for w in words if w in _MARKS]
    rest = [w for w in words if w not in _MARKS and w not in _PLACES]
    if not _ADDED.isdisjoint(marks) and all(w in _PARTS for w in rest):
        return 2
    return int(bool(marks) and not rest)


def _marked(name: str, attrs: str) -> int:
    """0: not marked; 1: by its role, class or id; 2: hidden, or added to the article."""
    if not attrs.strip():
        return 0
    mark = 0
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key == "hidden":
            if m.start() == 0 or attrs[m.start() - 1].isspace():
                return 2
        elif key == "aria-hidden":
            if value.lower() == "true":
                return 2
        elif key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return 2
        elif key == "role":
            if value.lower() in _ROLES:
                mark = max(mark, 1)
        elif key in ("class", "id") and (name not in _KEPT or name == "article"):
            found = max(map(_is_mark, value.split()), default=0)
            mark = max(mark, found if name != "article" or found == 2 else 0)
    return mark


def lines(html: str) -> tuple[list[str], list[int], list[int], list[bool]]:
    """(texts, plain, owner, heads): a line per block; ``plain``: characters outside links; ``owner``:
    number of the article or main element that holds the line, 0 for none, negative for an article in
    an element that is else dropped; ``heads``: whether it is a heading. Empty lines separate."""
    texts: list[str] = []
    plain: list[int] = []
    owner: list[int] = []
    heads: list[bool] = []
    buf: list[str] = []
    linked = 0
    stack: list[str] = []
    dropped = -1  # depth at which a dropped element stands
    wraps, back = False, None  # whether it may hold the article; that article's depth, and its own
    links, headings, sections, articles = 0, 0, [0], 0

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", "".join(buf)).strip() if buf else ""
        if text:
            texts.append(text)
            plain.append(max(0, len(text) - linked))
            owner.append(sections[-1])
            heads.append(headings > 0)
        buf.clear()
        linked = 0

    def gap() -> None:
        flush()
        if texts and texts[-1]:
            texts.extend([""] * WINDOW)
            plain.extend([0] * WINDOW)
            owner.extend([sections[-1]] * WINDOW)
            heads.extend([False] * WINDOW)

    def pop(depth: int) -> None:
        """Close the open elements from ``depth`` on."""
        nonlocal dropped, links, headings, back
        while len(stack) > depth:
            name = stack.pop()
            if 0 <= dropped:
                if len(stack) <= dropped:
                    dropped = -1
                continue
            if name == "a":
                links = max(0, links - 1)
            if name in _BLOCK:
                flush()
            if name in _HEADING:
                headings -= 1
            if name in _SECTION:
                gap()
                if name != "body" and len(sections) > 1:
                    sections.pop()
            if back and len(stack) == back[0]:
                dropped, back = back[1], None

    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at and dropped < 0:
            text = unescape(html[at:lt]) if "&" in html[at:lt] else html[at:lt]
            buf.append(text)
            if links:
                linked += len(text.strip())
        if lt == n:
            break
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), lt):
            end = html.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(html, lt, lt + _LONGEST_TAG) or _LOOSE_TAG.match(html, lt, lt + _LONGEST_TAG)
        if m is None:
            if html.startswith("</", lt) or lt + 1 < n and html[lt + 1].isalpha():
                end = html.find(">", lt)
                at = n if end < 0 else end + 1  # a tag that never ends, or no name
            else:
                if dropped < 0:
                    buf.append("<")
                at = lt + 1
            continue
        at, close, name, attrs = m.end(), m[1], m[2].lower(), m[3]
        if close:
            if name in _RAW:
                continue
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth] == name:
                    pop(depth)
                    break
            else:
                if name in _BLOCK and dropped < 0:
                    flush()
            continue
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
            if end is None:
                at = n
            else:
                gt = html.find(">", end.start())
                at = n if gt < 0 else gt + 1
            continue
        if name in _BLOCK and "p" in stack[-8:]:
            depth = len(stack) - 1 - stack[::-1].index("p")
            if not any(x in _BLOCK for x in stack[depth + 1 :]):
                pop(depth)
        if name in _CLOSES:
            for depth in range(len(stack) - 1, max(-1, len(stack) - 9), -1):
                if stack[depth] in _CLOSES[name]:
                    pop(depth)
                    break
                if stack[depth] in ("ul", "ol", "dl", "table", "select"):
                    break
        if dropped < 0:
            if name in _BLOCK:
                flush()
            elif name in ("br", "td", "th", "img"):
                buf.append(" ")
        if name in _VOID or attrs.rstrip().endswith("/") and name not in _BLOCK:
            continue
        if 0 <= dropped and wraps and not sections[-1] and name in ("article", "main") and not _marked(name, attrs):
            dropped, back = -1, (len(stack), dropped)
        if dropped < 0:
            mark = _marked(name, attrs)
            if mark and name == "span" and ("pre" in stack[-8:] or "code" in stack[-8:]):
                mark = 0
            if name in _DROP or mark:
                dropped = len(stack)
                wraps = mark < 2 and not back and (name not in _DROP or name in _WRAPS)
            elif name in _SECTION:
                gap()
                if name != "body":
                    articles += 1
                    sections.append(sections[-1] or (-articles if back and name == "article" else articles))
            elif name == "a":
                links += 1
            elif name in _HEADING:
                headings += 1
        stack.append(name)
    flush()
    return texts, plain, owner, heads


def _weights(texts: list[str], plain: list[int], heads: list[bool]) -> list[int]:
    """Characters outside links; of lines that are mostly links nothing (a heading: one)."""
    return [
        0 if len(t) <= _NOTICE_CHARS and _NOTICE.search(t) else p if 2 * p >= len(t) else int(h) for t, p, h in zip(texts, plain, heads, strict=True)
    ]


def _surges(weights: list[int]) -> bool:
    return bool(np.convolve(weights, np.ones(WINDOW, int)).max() >= SURGE)


def stretches(texts: list[str], weights: list[int], heads: list[bool]) -> list[tuple[int, int]]:
    """(first line, end) of each stretch over which the line-block sums stay above zero."""
    heavy = np.flatnonzero(weights)
    out = []
    for part in np.split(heavy, np.flatnonzero(np.diff(heavy) > WINDOW) + 1):
        if len(part):
            i, j = int(part[0]), int(part[-1]) + 1
            if j - i > 1 and heads[j - 1] and j < len(texts) and texts[j]:
                j -= 1
            out.append((i, j))
    return out


def tagged(texts: list[str], plain: list[int], owner: list[int], heads: list[bool]) -> list[int]:
    """The weights of the lines as tags change them."""
    weights = _weights(texts, plain, heads)
    worth = lambda at: (_surges([weights[i] for i in at]), sum(plain[i] for i in at))
    per: dict[int, list[int]] = {}
    for i, k in enumerate(owner):
        if texts[i]:
            per.setdefault(k, []).append(i)
    best = max((at for k, at in per.items() if k > 0), key=worth, default=[])
    if not best or not worth(best)[0]:
        free = [w if not k else 0 for w, k in zip(weights, owner, strict=True)]
        outside = [i for x in chosen(texts, plain, free, heads) for i in x]
        best = max((at for at in (best, outside, *(at for k, at in per.items() if k < 0)) if at), key=worth, default=[])
        if best is outside:
            return free
    inside = set(best)
    return [SURGE if i in inside else 0 for i in range(len(texts))]


def chosen(texts: list[str], plain: list[int], weights: list[int], heads: list[bool]) -> list[range]:
    """The stretches that surge, or the longest."""
    found = [range(*x) for x in stretches(texts, weights, heads)]
    return [x for x in found if _surges([weights[i] for i in x])] or sorted(found, key=lambda x: sum(plain[i] for i in x))[-1:]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    texts, plain, owner, heads = lines(html)
    kept = chosen(texts, plain, tagged(texts, plain, owner, heads), heads)
    kept = [i for x in kept for i in x] or [i for i, k in enumerate(owner) if not k]  # a page of nothing but links
    return "\n".join(texts[i] for i in kept if texts[i])


def extract(pages: DataFrame, *, html: str = "html") -> DataFrame:
    """page_id, url, text (empty if none), n_chars of each page."""
    ship_code(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col(html).cast("string"))
    out = rows.mapInArrow(run, "page_id bigint, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op2_linedist(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
